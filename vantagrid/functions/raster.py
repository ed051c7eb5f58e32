"""Raster kernels over numpy arrays: thresholds, components, instances, contrast.

Arrays are (height, width) or (height, width, channels) of bytes; only the first
three channels count. The kernels run inside Arrow stages and hold one frame.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Contrast is comparable only between runs measured with the same three.
CORE_ALPHA = 200
RING_PX = 15
MIN_CORE_PX = 8


@dataclass(frozen=True)
class Box:
    """Bounds of lit pixels, how many there are, and in how many pieces."""

    x: int
    y: int
    w: int
    h: int
    mask_area: int
    components: int = 1

    @property
    def box_area(self) -> int:
        return self.w * self.h

    @property
    def fill_ratio(self) -> float:
        return self.mask_area / self.box_area


def metric_settings() -> dict[str, int]:
    return {"core_alpha": CORE_ALPHA, "ring_px": RING_PX, "min_core_px": MIN_CORE_PX}


def coverage(mask: np.ndarray) -> np.ndarray:
    """Strongest of the colour channels at each pixel."""
    if mask.ndim == 2:
        return mask
    out = mask[:, :, 0]
    for k in range(1, min(mask.shape[2], 3)):
        out = np.maximum(out, mask[:, :, k])
    return out


def binarise(mask: np.ndarray, threshold: int) -> np.ndarray:
    """Pixels of which some colour channel exceeds the threshold."""
    return coverage(mask) > threshold


def grey(image: np.ndarray) -> np.ndarray:
    """Plain mean of the colour channels, in single precision."""
    return image.astype(np.float32) if image.ndim == 2 else image[:, :, :3].astype(np.float32).mean(axis=2)


def _runs(lit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end (exclusive) of every horizontal run of lit pixels, in row order."""
    padded = np.zeros((lit.shape[0], lit.shape[1] + 2), np.int8)
    padded[:, 1:-1] = lit
    step = np.diff(padded, axis=1)
    row, begin = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    return row, begin, end


def components(lit: np.ndarray) -> list[Box]:
    """Eight-connected components, the largest first; equals in the order their first pixel is met.

    Runs of neighbouring rows are linked where they touch, sides or corners, and the
    links are closed by passing the least label along until nothing changes.
    """
    row, begin, end = _runs(lit)
    n = len(row)
    if not n:
        return []
    # run b touches run a of the row above if it begins at or before a's end and ends at or behind a's begin
    span = lit.shape[1] + 2
    first = np.searchsorted(row * span + end, (row - 1) * span + begin, side="left")
    last = np.searchsorted(row * span + begin, (row - 1) * span + end, side="right")
    count = np.maximum(last - first, 0)
    below = np.repeat(np.arange(n), count)
    above = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, below, label[above])
        np.minimum.at(least, above, label[below])
        least = least[least]
        if (least == label).all():
            break
        label = least
    roots, own = np.unique(label, return_inverse=True)
    x0, y0 = np.full(len(roots), lit.shape[1]), np.full(len(roots), lit.shape[0])
    x1, y1, area = np.zeros(len(roots), int), np.zeros(len(roots), int), np.zeros(len(roots), int)
    np.minimum.at(x0, own, begin)
    np.maximum.at(x1, own, end)
    np.minimum.at(y0, own, row)
    np.maximum.at(y1, own, row + 1)
    np.add.at(area, own, end - begin)
    boxes = [Box(int(a), int(b), int(c - a), int(d - b), int(e)) for a, b, c, d, e in zip(x0, y0, x1, y1, area, strict=True)]
    return sorted(boxes, key=lambda box: -box.mask_area)


def united(boxes: list[Box]) -> Box | None:
    """One box around all; areas and pieces add up."""
    if not boxes:
        return None
    x, y = min(b.x for b in boxes), min(b.y for b in boxes)
    right, low = max(b.x + b.w for b in boxes), max(b.y + b.h for b in boxes)
    return Box(x, y, right - x, low - y, sum(b.mask_area for b in boxes), sum(b.components for b in boxes))


def instances(lit: np.ndarray, min_box_area: int) -> list[Box]:
    """The object of a frame: all pieces together, if its box is large enough."""
    whole = united(components(lit))
    return [whole] if whole is not None and whole.box_area >= min_box_area else []


def grown(lit: np.ndarray, reach: int) -> np.ndarray:
    """Pixels within ``reach`` of a lit one, along either axis; counts over a sliding square."""
    total = np.zeros((lit.shape[0] + 1, lit.shape[1] + 1), np.int64)
    total[1:, 1:] = lit.cumsum(axis=0, dtype=np.int64).cumsum(axis=1)
    y, x = np.arange(lit.shape[0]), np.arange(lit.shape[1])
    top, low = np.maximum(y - reach, 0), np.minimum(y + reach + 1, lit.shape[0])
    left, right = np.maximum(x - reach, 0), np.minimum(x + reach + 1, lit.shape[1])
    return total[low][:, right] - total[low][:, left] - total[top][:, right] + total[top][:, left] > 0


def sampled(alpha: np.ndarray, lit: np.ndarray, box: Box, core_alpha: int = CORE_ALPHA, ring_px: int = RING_PX, min_core_px: int = MIN_CORE_PX) -> tuple[np.ndarray, np.ndarray] | None:
    """Core and ring of a box's object, as maps; None if either is empty.

    The core is what is covered to ``core_alpha``; with too few such pixels, all that
    are covered as much as the ``min_core_px``-th most covered one. The ring is what
    lies within half the ring's width and is not lit.
    """
    own = np.zeros_like(lit)
    own[box.y : box.y + box.h, box.x : box.x + box.w] = lit[box.y : box.y + box.h, box.x : box.x + box.w]
    if not own.any():
        return None
    ring = grown(own, ring_px // 2) & ~lit
    core = own & (alpha >= core_alpha)
    if core.sum() < min_core_px:
        covered = np.sort(alpha[own])[::-1]
        core = own & (alpha >= covered[min(min_core_px, len(covered)) - 1])
    return (core, ring) if ring.any() else None


def contrast(image: np.ndarray, mask: np.ndarray, lit: np.ndarray, box: Box) -> float | None:
    """Mean of the core less mean of the ring, signed; None where it cannot be measured.

    Only the box and the ring's reach around it are looked at, so the cost follows the
    object's size and not the frame's.
    """
    reach = RING_PX // 2
    top, left = max(box.y - reach, 0), max(box.x - reach, 0)
    near = (slice(top, box.y + box.h + reach), slice(left, box.x + box.w + reach))
    own = Box(box.x - left, box.y - top, box.w, box.h, box.mask_area, box.components)
    maps = sampled(coverage(mask[near]), lit[near], own)
    if maps is None:
        return None
    plane = grey(image[near])
    return float(plane[maps[0]].mean() - plane[maps[1]].mean())


def sky_tint(image: np.ndarray, rows: int = 300) -> float:
    """Mean of blue less red over the top rows of a blue-green-red image."""
    top = image[:rows].astype(np.float64)
    return float((top[:, :, 0] - top[:, :, 2]).mean())
