"""Suffix-array dedup: bytes covered by a window of 100 bytes that also begins earlier.

Equal windows are found by a depth-limited radix sort: suffixes are put in order by
most-significant digits of eight bytes, only through the window's length, and only
groups that still have several members go on; groups left at the end are exactly the
repeated windows.

So that not every suffix of the corpus has to be sorted, two content-defined steps
come first, neither of which loses a repeat:

1. Every window has an anchor, the least (leftmost) hash among its runs of ANCHOR
   bytes. Equal windows have equal anchors in equal places. The windows that share an
   anchor follow each other; together they are a stretch of text. A stretch that
   occurs earlier as a whole (64 bits of a digest of all its bytes, and a hash of its
   anchor's) is covered whole, and its first occurrence stands for it. Stretches are
   dealt by their anchors, but those of the anchors that would fill a good part of a
   task, as a sample tells, by their content: other tasks, the same result.
2. Of the stretches that are left, only those whose anchor another different stretch
   also has can share part of their windows. Their suffixes are sorted byte for byte,
   anchor by anchor. The stretches of an anchor that more than HOT of them share are
   first cut into PARTS short ones, by where in a window the anchor is, and dealt by the
   bytes that all windows of such a part have in common: other tasks, the same sort.

Copies of a stretch are merged where they are read, so a stretch that very many
texts share reaches a task about once for each partition read.

Null and empty texts and texts under 100 bytes lose nothing and keep their own bytes.
Rows are in order by (doc_id, text hash); exact repeats of a row are one text, are judged
once and cleaned alike. Texts of any length are read whole, in blocks that overlap. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantagrid.llm.common import Scratch, bounded_batches, small
from vantagrid.llm.hashing import Powers, U, mix, prefix_sums, slice_digests, window_hashes

#: Bytes of a repeat, and of the runs that anchor windows.
WINDOW, ANCHOR = 100, 32
#: Windows of a text that are looked at together.
BLOCK = 1 << 19
#: Stretches that a reading task holds before it merges their copies; windows that a task sorts at a time.
HELD, SORTED = 1 << 21, 1 << 19
#: Stretches of an anchor from which on they are cut up, into how many parts, and parts held to merge their copies.
HOT, PARTS, HELD_PARTS = 256, 8, 1 << 17
#: Bytes of text for each partition of stretches, at most.
DEALT = 48 << 20
#: Ids that may travel to the scan.
PICKED = 500_000
#: Share of the texts, and bytes of them at most, that tell which anchors are dealt by content; what share of a task one must fill.
SAMPLED, SAMPLED_BYTES, FILLED = 1 / 16, 64 << 30, 1 / 4


def anchors(data: np.ndarray, powers: Powers, window: int = WINDOW, size: int = ANCHOR) -> np.ndarray:
    """For each window of one text: where its anchor is."""
    n, span = len(data) - window + 1, window - size + 1
    sums = prefix_sums(data, powers)
    at = np.arange(len(data) - size + 1)
    least = (window_hashes(sums, powers, at, at + size) >> U(20) << U(20)) | at.astype(U)
    have = 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (least[:n] & U((1 << 20) - 1)).astype(np.int64)


#: Columns of numpy arrays of one length.
Table = dict[str, np.ndarray]


def stretches(text: bytes, powers: Powers, window: int = WINDOW) -> Table:
    """Runs of windows with one anchor: anchor and content hashes, first window, number of windows, anchor's place in the first."""
    parts = []
    for low in range(0, max(len(text) - window + 1, 0), BLOCK):
        data = np.frombuffer(text, np.uint8)[low : low + BLOCK + window - 1]
        where = anchors(data, powers, window)
        begin = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        end = np.append(begin[1:], len(where))
        spot = where[begin]
        parts.append(
            {
                "anchor": window_hashes(prefix_sums(data, powers), powers, spot, spot + ANCHOR).view(np.int64),
                "content": slice_digests(text, (begin + low).tolist(), (end + (low + window - 1)).tolist()),
                "start": begin + low,
                "windows": end - begin,
                "lead": spot - begin,
            }
        )
    return stacked(parts, ("anchor", "content", "start", "windows", "lead"))


def stacked(parts: list[Table], names: tuple[str, ...]) -> Table:
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in names}


def rows(t: Table, pick: np.ndarray) -> Table:
    return {k: v[pick] for k, v in t.items()}


PLACE = ("id", "mark", "start")
STRETCH = ("anchor", "content", *PLACE, "windows", "lead")
SPAN = (*PLACE, "end")


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before, the first row included."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def merged(t: Table) -> tuple[Table, Table]:
    """Stretches in order, each at its first occurrence, and the later occurrences. A row read twice counts once."""
    t = rows(t, np.lexsort((t["start"], t["mark"], t["id"], t["content"], t["anchor"])))
    first = changes(t["anchor"], t["content"])
    again = ~first & ~changes(t["id"], t["mark"], t["start"])
    return rows(t, first), rows(t, ~first & ~again)


def spans_of(t: Table, window: int = WINDOW) -> Table:
    """The bytes that stretches cover, joined where they touch in one text."""
    t = rows(t, np.lexsort((t["start"], t["mark"], t["id"])))
    end = t["start"] + t["windows"] - 1 + window
    fresh = changes(t["id"], t["mark"])
    # a text's starts rise; ends are raised to the furthest so far, counted from each text's own level
    level = np.cumsum(fresh) * (1 << 40)
    furthest = np.maximum.accumulate(end + level) - level
    fresh[1:] |= t["start"][1:] > furthest[:-1]
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(end))[: len(at)] - 1
    return {k: t[k][at] for k in PLACE} | {"end": furthest[last]}


def radix_groups(digits: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``digits`` that equal another of their group, and their groups refined to equal rows; sorted by group.

    One digit after the other, most significant first; groups of one member are let go.
    """
    order = np.argsort(group, kind="stable")
    group = group[order]
    for k in range(digits.shape[1]):
        place = np.lexsort((digits[order, k], group))
        order, group = order[place], group[place]
        group = np.cumsum(changes(group, digits[order, k]))
        several = np.bincount(group)[group] > 1
        order, group = order[several], group[several]
    return order, group


def shared_windows(t: Table, window: int = WINDOW) -> Table:
    """Of stretches with their bytes in ``text``: the windows that an earlier stretch of the anchor has too, as stretches of one."""
    n = t["windows"]
    own = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    data = np.frombuffer(b"".join(t["text"].tolist()) + bytes(8), np.uint8)
    begin = np.repeat(np.cumsum(n + window - 1) - (n + window - 1), n) + step
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    tail = -window % 8
    digits = np.empty((len(own), (window + 7) // 8), U)
    for k in range(digits.shape[1]):
        digits[:, k] = np.ascontiguousarray(words[begin + 8 * k]).view(">u8").ravel()
    digits[:, -1] >>= U(8 * tail)
    group = mix(t["anchor"].view(U)[own] + (t["lead"][own] - step).astype(U)).view(np.int64)
    order, group = radix_groups(digits, group)
    found = {k: t[k][own[order]] for k in ("id", "mark")} | {"start": t["start"][own[order]] + step[order]}
    place = np.lexsort((found["start"], found["mark"], found["id"], group))
    first = changes(group[place])
    late = rows(found, place[~first])
    return late | {"windows": np.ones(len(late["start"]), np.int64)}


def cut_up(t: Table, window: int = WINDOW) -> Table:
    """Stretches with their bytes, each cut where the anchor's place in the window enters another of PARTS classes.

    ``anchor`` becomes a hash of the class and of the bytes that all its windows have in
    common; equal windows have equal ones.
    """
    wide = -(-(window - ANCHOR + 1) // PARTS)
    high, low = t["lead"], t["lead"] - t["windows"] + 1
    n = high // wide - low // wide + 1
    own = np.repeat(np.arange(len(n)), n)
    part = low[own] // wide + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    top, bottom = np.minimum(high[own], part * wide + wide - 1), np.maximum(low[own], part * wide)
    skip = high[own] - top
    windows = top - bottom + 1
    texts = t["text"][own].tolist()
    out = {k: t[k][own] for k in ("id", "mark")} | {"start": t["start"][own] + skip, "windows": windows, "lead": top}
    data = b"".join(t["text"].tolist())
    size = t["windows"] + window - 1
    # the anchor is ``lead`` behind the stretch's begin; a part's common bytes begin part * wide before it
    core = (np.cumsum(size) - size)[own] + high[own] - part * wide
    out["anchor"] = slice_digests(data, core.tolist(), (core + window - wide + 1).tolist()) + part
    cuts = zip(texts, skip.tolist(), (skip + windows - 1 + window).tolist(), strict=True)
    out["text"] = np.array([x[a:z] for x, a, z in cuts] + [None], object)[:-1]
    return out


class _Parts:
    """Holds parts of stretches as they are cut and lets go of those whose bytes an earlier one has."""

    def __init__(self):
        self.held: list[Table] = []
        self.count = 0

    def add(self, t: Table) -> Iterator[pa.RecordBatch]:
        self.held.append(t)
        self.count += len(t["start"])
        if self.count >= HELD_PARTS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            t = stacked(self.held, ("anchor", "lead", "text", "windows", *PLACE))
            t = rows(t, np.lexsort((t["start"], t["mark"], t["id"])))
            seen: set[tuple] = set()
            first = np.zeros(len(t["start"]), bool)
            for k, key in enumerate(zip(t["anchor"].tolist(), t["lead"].tolist(), t["text"].tolist(), strict=True)):
                if key not in seen:
                    seen.add(key)
                    first[k] = True
            yield from _sent(1, spans_of(rows(t, ~first)))
            yield from _sent(3, rows(t, first))
        self.held, self.count = [], 0


# Rows between tasks: kind 0 a stretch, 1 a span that goes, 2 a stretch that others share in part, 3 that with its bytes,
# 4 a stretch that is dealt by its content, 5 as 2, of a hot anchor.
_FIELDS = {"kind": "int", "anchor": "long", "content": "long", "id": "long", "mark": "long", "start": "int", "windows": "int", "lead": "int", "text": "binary"}
SCHEMA = ", ".join(f"{k} {v}" for k, v in _FIELDS.items())
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _sent(kind: int, t: Table) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow; a span's end travels as ``windows``, its key is spread by place."""
    n = len(t["start"])
    if kind == 1:
        t = t | {"windows": t["end"], "anchor": mix(t["id"].view(U) + t["start"].view(U)).view(np.int64)}
    for at in range(0, n, 1 << 16):
        part = slice(at, at + (1 << 16))
        size = min(n - at, 1 << 16)
        cols = []
        for k, v in _FIELDS.items():
            if k == "kind":
                cols.append(pa.array(np.full(size, kind, np.int32)))
            elif k in t:
                cols.append(pa.array(t[k][part].tolist() if k == "text" else t[k][part], _TYPES[v]))
            else:
                cols.append(pa.nulls(size, _TYPES[v]) if k == "text" else pa.array(np.zeros(size, np.int64), _TYPES[v]))
        yield pa.RecordBatch.from_arrays(cols, list(_FIELDS))


def _received(batches: Iterator[pa.RecordBatch], kinds: tuple[int, ...]) -> dict[int, Table]:
    """All rows of a partition, by kind."""
    parts: dict[int, list[Table]] = {k: [] for k in kinds}
    for b in batches:
        kind = b.column(0).to_numpy()
        t = {k: b.column(i).to_numpy().astype(np.int64) for i, k in enumerate(_FIELDS) if 0 < i < 8}
        for k in kinds:
            if (hit := kind == k).any():
                own = rows(t, hit)
                if k == 3:
                    own["text"] = np.array(b.column(8).filter(pa.array(hit)).to_pylist(), object)
                parts[k].append(own)
    names = tuple(_FIELDS)[1:8]
    return {k: stacked(p, (*names, "text") if k == 3 else names) for k, p in parts.items()}


class _Merger:
    """Holds stretches as they are read and lets go of copies; what goes and what stays comes out as rows."""

    def __init__(self, by_content: np.ndarray):
        self.by_content = by_content
        self.held: list[Table] = []
        self.count = 0

    def add(self, t: Table) -> Iterator[pa.RecordBatch]:
        self.held.append(t)
        self.count += len(t["start"])
        if self.count >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            first, late = merged(stacked(self.held, STRETCH))
            yield from _sent(1, spans_of(late))
            apart = np.isin(first["anchor"], self.by_content)
            yield from _sent(0, rows(first, ~apart))
            yield from _sent(4, rows(first, apart))
        self.held, self.count = [], 0


def _placed(t: Table, id_: int, mark: int) -> Table:
    n = len(t["start"])
    return t | {"id": np.full(n, id_), "mark": np.full(n, mark)}


def _read(powers: Powers, by_content: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _Merger(by_content)
        for b in batches:
            for id_, mark, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), strict=True):
                if len(text) >= WINDOW:
                    yield from merger.add(_placed(stretches(text, powers), id_, mark))
        yield from merger.flush()

    return run


def _settle(hot: int) -> Callable:
    """First step: later copies of stretches go; firsts whose anchor has other stretches are handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _received(batches, (0, 1, 4))
        first, late = merged(got[0])
        yield from _sent(1, spans_of(late))
        nth = np.cumsum(changes(first["anchor"]))
        n = np.bincount(nth)[nth] if len(nth) else nth
        yield from _sent(2, rows(first, (n > 1) & (n <= hot)))
        yield from _sent(5, rows(first, (n > 1) & (n > hot)))
        first, late = merged(got[4])
        yield from _sent(1, spans_of(late))
        yield from _sent(5, first)
        yield from _passed(got[1])

    return run


def _passed(t: Table) -> Iterator[pa.RecordBatch]:
    yield from _sent(1, {k: t[k] for k in PLACE} | {"end": t["windows"]})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their open stretches to the bytes of each, in parts where the anchor is hot."""
    parts = _Parts()
    for b in batches:
        for id_, mark, text, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), b.column(3).to_pylist(), strict=True):
            t = {k: np.array([x[k] for x in found], np.int64) for k in ("anchor", "start", "windows", "lead", "hot")}
            t["text"] = np.array([text[s : s + n - 1 + WINDOW] for s, n in zip(t["start"].tolist(), t["windows"].tolist(), strict=True)] + [None], object)[:-1]
            t = _placed(t, id_, mark)
            hot = t.pop("hot") == 1
            yield from _sent(3, rows(t, ~hot))
            if hot.any():
                yield from parts.add(cut_up(rows(t, hot)))
    yield from parts.flush()


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second step: shared windows of open stretches."""
    got = _received(batches, (1, 3))
    yield from _passed(got[1])
    t = got[3]
    t = rows(t, np.argsort(t["anchor"], kind="stable"))
    begins = np.flatnonzero(changes(t["anchor"]))
    before = (np.cumsum(t["windows"]) - t["windows"])[begins]
    low = 0
    while low < len(begins):
        base = before[low]
        high = max(low + 1, int(np.searchsorted(before, base + SORTED, side="right")) - 1)
        end = begins[high] if high < len(begins) else len(t["start"])
        yield from _sent(1, spans_of(shared_windows(rows(t, slice(begins[low], end)))))
        low = high


def _marked(docs: DataFrame, work: Scratch) -> tuple[DataFrame, DataFrame]:
    """``docs`` (id, text) with ``mark``, which tells rows of one id apart and is 0 where an id has one row; and each distinct row once."""
    several = work.keep(docs.groupBy("id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("id"))
    alone = docs.withColumn("mark", F.lit(0).cast("long"))
    if several.isEmpty():
        return alone, alone
    several = F.broadcast(several) if small(several, PICKED) else several
    among = docs.join(several, "id", "left_semi").withColumn("mark", F.xxhash64("text"))
    alone = alone.join(several, "id", "left_anti")
    once = among.groupBy("id", "mark").agg(F.first("text").alias("text")).select("id", "text", "mark")
    return alone.unionByName(among), alone.unionByName(once)


def _counted(powers: Powers) -> Callable:
    """(anchor, n): how many different stretches a task meets of each anchor that has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, [("anchor", np.int64), ("content", np.int64)])]
        for b in batches:
            for text in b.column(0).cast(pa.binary()).to_pylist():
                t = stretches(text, powers)
                one = np.empty(len(t["start"]), held[0].dtype)
                one["anchor"], one["content"] = t["anchor"], t["content"]
                held.append(one)
            if sum(map(len, held)) >= HELD:
                held = [np.unique(np.concatenate(held))]
        anchor, n = np.unique(np.unique(np.concatenate(held))["anchor"], return_counts=True)
        several = n > 1
        yield pa.RecordBatch.from_arrays([pa.array(anchor[several]), pa.array(n[several])], ["anchor", "n"])

    return run


def _dealt_by_content(docs: DataFrame, size: int, parts: int, powers: Powers) -> np.ndarray:
    """Anchors whose different stretches would fill a good part of a task, by a sample of the texts: at most 1 / FILLED for each task.

    Only where rows are dealt depends on them.
    """
    share = min(SAMPLED, SAMPLED_BYTES / max(size, 1))
    # a stretch has about as many windows as bytes before the next anchor
    enough = size / ((WINDOW - ANCHOR) / 2) / parts * FILLED * share
    counts = docs.select("text").sample(share, 11).mapInArrow(_counted(powers), "anchor long, n long")
    found = counts.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= max(enough, 8)).select("anchor").collect()
    return np.array([r.anchor for r in found], np.int64)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, mark, text, spans): the rows of ``docs`` (id, text) with the byte spans [start, end) that repeat earlier ones."""
    spark = docs.sparkSession
    work = Scratch(spark, "suffixes")
    bounded_batches(spark)
    powers = Powers()
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // DEALT))
    every, once = (x.select("id", "mark", "text") for x in _marked(docs, work))
    by_content = _dealt_by_content(once, size, parts, powers)
    key = F.when(F.col("kind") == 4, F.col("content")).otherwise(F.col("anchor"))
    settled = work.keep(once.mapInArrow(_read(powers, by_content), SCHEMA).repartition(parts, key).mapInArrow(_settle(HOT), SCHEMA))
    stretch = F.struct("anchor", "start", "windows", "lead", (F.col("kind") == 5).cast("int").alias("hot"))
    by_text = settled.where("kind IN (2, 5)").groupBy("id", "mark").agg(F.collect_list(stretch).alias("found"))
    texts = once.join(by_text, ["id", "mark"]).select("id", "mark", "text", "found")
    sorted_ = texts.mapInArrow(_cut, SCHEMA).repartition(parts, "anchor").mapInArrow(_sort, SCHEMA)
    spans = settled.where("kind = 1").unionByName(sorted_.where("kind = 1"))
    spans = work.keep(spans.groupBy("id", "mark").agg(F.collect_list(F.struct("start", F.col("windows").alias("end"))).alias("spans")))
    return every.join(spans, ["id", "mark"], "left")


def joined_spans(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kept, n_bytes, spans): UTF-8 bytes left of each text, its length, and the byte spans removed; a row for each input row.

    A null id counts as the least.
    """
    lowest = -(1 << 63)
    docs = df.select(F.coalesce(df[id_col].cast("long"), F.lit(lowest)).alias("id"), F.coalesce(df[text_col], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, size, gone = [], [], []
            for text, spans in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
                spans = joined_spans(spans or [])
                edges = [0, *(x for s in spans for x in s), len(text)]
                kept.append(b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
                size.append(len(text))
                gone.append([{"start": s, "end": e} for s, e in spans])
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(gone, span)], ["id", "kept", "n_bytes", "spans"])

    out = repeated_spans(docs).select("id", "text", "spans").mapInArrow(run, "id long, kept binary, n_bytes long, spans array<struct<start:int,end:int>>")
    return out.select(F.when(F.col("id") != lowest, F.col("id")).alias(id_col), "kept", "n_bytes", "spans")
