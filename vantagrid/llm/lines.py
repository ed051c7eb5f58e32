"""Line dedup by content-defined chunks of lines.

A hash that rolls over neighbouring lines chooses where a text is cut: between two lines
if the hash of either asks for it, so that equal runs of lines are cut alike wherever
they stand and a run's own first and last line can part it from what is around it. Looked
for are chunks, and pairs of chunks that follow each other, of at least two lines that
are not blank. Chunks that, alone or in such a pair, occur more than once in the corpus
are removed everywhere but at the first occurrence, by (doc_id, text hash, place). Keys
only nominate: the texts of a key are compared byte for byte by grouping on the text
itself, and keys with several different texts are resolved text by text.

The first occurrence of a chunk's own text is never removed, so nothing is lost from the
corpus. A repeated run loses all but the lines at its ends that are in one chunk with
lines around it.

DataFrame functions only. A null text stays null, an empty one empty. Rows of equal
doc_id and text are one occurrence and are cleaned alike. Texts of any length are
cut; an empty table gives an empty result; other columns pass unchanged, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantagrid.llm.columns import let
from vantagrid.llm.common import Scratch, small, unused

#: A line asks for a cut behind it, and in front of it, where these digits of its hash are divisible by this.
MODULUS, BEHIND, FRONT = 2, 1, 8
#: Keys of repeated chunks that may travel to the scan; beyond that chunks are shuffled to the keys.
PICKED = 500_000


def line_hashes(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long"))


def chunk_ends(hashes: Column) -> Column:
    """Places (from 1) of the lines that end a chunk; the last line always does."""
    n = F.size(hashes)

    def asks(line: Column, digit: int) -> Column:
        return F.floor(line / digit) % MODULUS == 0

    def ends(at: Column) -> Column:
        behind = F.element_at(hashes, F.least(at + 1, n))
        return (at == n) | asks(F.element_at(hashes, at), BEHIND) | asks(behind, FRONT)

    return F.filter(F.sequence(F.lit(1), n), ends)


def chunks(text: Column) -> Column:
    """The text's chunks, in order; joined by newlines they give the text."""

    def cut(lines: Column) -> Column:
        def pieces(ends: Column) -> Column:
            def piece(k: Column) -> Column:
                begin = F.when(k > 1, F.element_at(ends, F.greatest(k - 1, F.lit(1)))).otherwise(0)
                return F.array_join(F.slice(lines, begin + 1, F.element_at(ends, k) - begin), "\n")

            return F.transform(F.sequence(F.lit(1), F.size(ends)), piece)

        return let(line_hashes(lines), lambda hashes: let(chunk_ends(hashes), pieces))

    return let(F.split(text, "\n", -1), cut)


def several_lines(chunk: Column) -> Column:
    """Whether at least two lines are not blank."""
    return chunk.rlike(r"(?s)\A\s*\S[^\n]*\n\s*\S")


def _units(own: Column) -> Column:
    """array<struct<at, wide, chunk>>: each chunk, and each with the one behind it."""

    def two(chunk: Column, at: Column) -> Column:
        pair = F.concat_ws("\n", chunk, F.get(own, at + 1))
        wide = F.when(F.get(own, at + 1).isNotNull(), 2).otherwise(0)
        return F.array(F.struct(at.alias("at"), F.lit(1).alias("wide"), chunk.alias("chunk")), F.struct(at.alias("at"), wide.alias("wide"), pair.alias("chunk")))

    return F.filter(F.flatten(F.transform(own, two)), lambda u: (u["wide"] > 0) & several_lines(u["chunk"]))


def _occurrences(docs: DataFrame, key_bits: int) -> DataFrame:
    """(doc_id, mark, at, wide, key, chunk) of every chunk and pair of chunks of several lines."""
    rows = docs.where(F.col("text").contains("\n")).select("doc_id", F.xxhash64("text").alias("mark"), F.explode(let(chunks(F.col("text")), _units)).alias("u"))
    return rows.select("doc_id", "mark", "u.at", "u.wide", F.shiftrightunsigned(F.xxhash64("u.chunk"), 64 - key_bits).alias("key"), "u.chunk")


def removals(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """(doc_id, mark, drop): places of the chunks to remove from each text that loses any."""
    work = Scratch(docs.sparkSession, "lines")
    docs = docs.select("doc_id", "text")
    place = F.struct("doc_id", "mark", "at")
    seen = work.keep(_occurrences(docs, key_bits).drop("chunk"))
    firsts = seen.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = work.keep(firsts.where("first < last").select("key", "first"))
    keys = F.broadcast(firsts.select("key")) if small(firsts, PICKED) else firsts.select("key").hint("merge")
    repeated = _occurrences(docs, key_bits).join(keys, "key", "left_semi")
    texts = repeated.select("key", "chunk").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_texts"))
    unlike = work.keep(texts.where("n_texts > 1").select("key"))
    sure = seen.join(firsts.join(unlike, "key", "left_anti"), "key").where(place != F.col("first")).select("doc_id", "mark", "at", "wide")
    # different texts of one key: first occurrences text by text
    shared = _occurrences(docs, key_bits).join(unlike, "key", "left_semi")
    own = shared.groupBy("key", "chunk").agg(F.min(place).alias("first"))
    told = shared.join(own, ["key", "chunk"]).where(place != F.col("first")).select("doc_id", "mark", "at", "wide")
    if not unlike.isEmpty():
        sure = sure.unionByName(told)
    gone = sure.select("doc_id", "mark", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("wide") - 1)).alias("at"))
    return work.keep(gone.groupBy("doc_id", "mark").agg(F.collect_set("at").alias("drop")))


def deduplicated(docs: DataFrame, key_bits: int = 64, into: str = "__vg") -> DataFrame:
    """``docs`` with repeated chunks gone from ``text``, and a struct column ``into``: chunks and lines removed."""
    own, mark, drop, told = (unused(docs, n) for n in ("id", "mark", "drop", "told"))
    lost = removals(docs, key_bits).toDF(own, mark, drop)
    same = docs["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(docs["text"]) == F.col(mark))
    # always by shuffle: the list of removals grows with the corpus
    out = docs.join(lost.hint("merge"), same, "left")

    def rebuilt(all_chunks: Column) -> Column:
        kept = F.filter(all_chunks, lambda x, at: ~F.array_contains(F.col(drop), at))
        gone = F.filter(all_chunks, lambda x, at: F.array_contains(F.col(drop), at))
        n_lines = F.aggregate(gone, F.lit(0), lambda n, x: n + F.size(F.split(x, "\n", -1)))
        return F.struct(F.array_join(kept, "\n").alias("text"), F.size(gone).alias("chunks"), n_lines.alias("lines"))

    out = out.withColumn(told, F.when(F.col(drop).isNotNull(), let(chunks(docs["text"]), rebuilt)))
    text = F.when(F.col(told).isNotNull(), F.col(f"{told}.text")).otherwise(docs["text"])
    counts = F.struct(F.coalesce(f"{told}.chunks", F.lit(0)).alias("chunks"), F.coalesce(f"{told}.lines", F.lit(0)).alias("lines"))
    return out.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns], counts.alias(into))
