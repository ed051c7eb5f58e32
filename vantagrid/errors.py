"""Refusals: the engine declining to produce something it could not stand behind."""


class Refusal(ValueError):
    """Base of all refusals; the command line prints one as a single line and exits with 2."""


class ConfigRefused(Refusal):
    """A config file is missing, malformed or out of range."""


class ManifestRefused(Refusal):
    """A run or dataset manifest is missing, malformed or of another version."""


class PairingRefused(Refusal):
    """The two passes of a capture do not match frame by frame."""


class FrameRefused(Refusal):
    """A frame pair cannot be annotated."""


class IngestRefused(Refusal):
    """A capture cannot become a run."""


class ConvertRefused(Refusal):
    """A run cannot be converted."""


class SplitRefused(Refusal):
    """A split names runs that are not there."""


class BuildRefused(Refusal):
    """A dataset version cannot be assembled."""


class StoreRefused(Refusal):
    """A store operation is impossible."""


class KeyMissing(StoreRefused):
    """Nothing is stored under the key."""


class KeyExists(StoreRefused):
    """Something is stored under a key that must be new."""


class NotPermitted(StoreRefused):
    """The store does not let this identity look or delete."""
