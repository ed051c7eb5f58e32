"""Secret scans by one combined deterministic automaton over bytes.

All rules are compiled together (``dfa``) so that one pass over a batch's bytes marks
every place where a rule ends. The pass runs many lanes side by side in numpy: texts
are joined by a byte that leads every state back to the start, lanes are entered on
speculation and mended where that was wrong. Texts in which a rule ended are read by the
rule's own automaton from their ends, which marks every place where a match begins; its
anchored automaton then delimits leftmost, longest, non-overlapping matches from these
places only, and matches that fail the rule's condition are dropped without retry. A
begin that leads to no match is never tried, so time is in proportion to the text.

Null and empty texts have no spans; repeated rows repeat their result; whole texts of
any length are scanned; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vantagrid.llm.common import bounded_batches, utf8
from vantagrid.llm.dfa import Automaton, compile_rules


@dataclass(frozen=True)
class Rule:
    """``locate`` is what the combined automaton looks for: every kept match begins with one or is one.

    Counted repeats of several rules multiply the states of a product, so a rule that
    begins with a telling prefix is located by that. ``pattern`` delimits matches and
    ``keep`` accepts one.
    """

    name: str
    pattern: str
    locate: str
    fold: bool = False
    keep: Callable[[bytes], bool] = lambda match: True


_HEAD = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?", re.IGNORECASE)


def _assigned(match: bytes) -> bytes:
    """The assigned value: what stands behind the keyword, the sign and an opening quote."""
    return match[_HEAD.match(match).end() :]


_ASSIGN = "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+"

#: The base kinds, in their order, then the kinds this scanner adds.
RULES = (
    Rule("assign", _ASSIGN, _ASSIGN, True, lambda m: len(_assigned(m)) >= 6),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]", keep=lambda m: len(m) >= 20),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{24,}", keep=lambda m: len(m) >= 24),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("git", "gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_[A-Za-z0-9]"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", "xox[abprs]-"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", "eyJ[A-Za-z0-9_-]"),
)
#: The first so many rules are the base.
BASE = 3
#: Bytes scanned together, and lanes they are cut into.
BLOCK, LANES = 8 << 20, 4096


class Scanner:
    """The compiled rules; small enough to travel with each task."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.all = compile_rules([(r.locate, r.fold) for r in rules], anywhere=True)
        self.each = [compile_rules([(r.pattern, r.fold)], anywhere=False) for r in rules]
        self.back = [compile_rules([(r.pattern, r.fold)], anywhere=True, backwards=True) for r in rules]
        if 0 not in self.all.resets or any(0 not in a.resets for a in self.back):
            raise ValueError("rules must not match over a zero byte")

    def ends(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One pass: where rules end in ``data``, and the mask of rules there."""
        states = self.all.states(data, min(LANES, len(data) // 64 + 1))
        at = np.flatnonzero(states >= self.all.accepting * 256)
        return at, self.all.masks[states[at] >> 8]

    def begins(self, k: int, data: np.ndarray) -> np.ndarray:
        """Places of ``data`` from which on rule ``k`` has a match."""
        states = self.back[k].states(data[::-1], min(LANES, len(data) // 64 + 1))
        return len(data) - 1 - np.flatnonzero(states >= self.back[k].accepting * 256)[::-1]

    def matches(self, k: int, data: bytes, begins: np.ndarray) -> list[tuple[int, int]]:
        """Leftmost, longest, non-overlapping matches of rule ``k``, given where any begins; failing ones dropped."""
        one: Automaton = self.each[k]
        table, bar, dead, out, at = one.table.tolist(), one.accepting, one.dead, [], 0
        for s in begins.tolist():
            if s < at:
                continue
            state, end = one.start, -1
            for i in range(s, len(data)):
                state = table[state][data[i]]
                if state == dead:
                    break
                if state >= bar:
                    end = i + 1
            if self.rules[k].keep(data[s:end]):
                out.append((s, end))
            at = end
        return out

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, kind, end) in code points, sorted."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not texts:
            return found
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        at, masks = self.ends(data)
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        owner = np.searchsorted(begins, at, side="right") - 1
        points: dict[int, np.ndarray] = {}
        for k in range(len(self.rules)):
            hit = np.unique(owner[(masks >> k) & 1 == 1]).tolist()
            own = b"\0".join([texts[t] for t in hit]) + b"\0"
            starts = np.cumsum([0, *(len(texts[t]) + 1 for t in hit)])
            spans = self.matches(k, own, self.begins(k, np.frombuffer(own, np.uint8))) if hit else []
            for (s, e), nth in zip(spans, np.searchsorted(starts, [s for s, _ in spans], side="right") - 1, strict=True):
                t, base = hit[nth], int(starts[nth])
                if t not in points:
                    points[t] = np.concatenate([[0], np.cumsum((np.frombuffer(texts[t], np.uint8) & 0xC0) != 0x80)])
                found[t].append((int(points[t][s - base]), k, int(points[t][e - base])))
        for t in points:
            found[t].sort()
        return found


SPAN_SCHEMA = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, spans): one row for each input row, spans in code points, end exclusive, by start and then rule."""
    src = df.select(df[id_col].alias("id"), utf8(text_col).alias("text"))
    scanner = Scanner(rules)
    kind = src.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        texts = [t for b in held for t in b.column(1).cast(pa.binary()).to_pylist()]
        rows = [[{"kind": scanner.rules[k].name, "start": s, "end": e} for s, k, e in x] for x in scanner.scan(texts)]
        ids = pa.concat_arrays([b.column(0) for b in held])
        return pa.RecordBatch.from_arrays([ids, pa.array(rows, span)], ["id", "spans"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.column(1).nbytes
            if size >= BLOCK:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    bounded_batches(df.sparkSession)
    return src.mapInArrow(run, f"id {kind}, spans {SPAN_SCHEMA}").withColumnRenamed("id", id_col)
