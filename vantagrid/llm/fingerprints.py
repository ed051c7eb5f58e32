"""Document fingerprints by threshold-scaled sketches.

A sketch keeps every hash of a document's word shingles that lies below a fixed
fraction of the hash range. As the threshold is the same everywhere, sketches can be
merged to the sketch of the union, and containment of a short document in a long one is
estimated as well as likeness of equals. Where no hash is below the threshold the least
one stands in, so that short texts can still be told apart; merged with a sketch that
has some below, it goes. Hashes are compared as unsigned numbers.

DataFrame functions only. Null text counts as empty; an empty text has the empty
sketch and is like nothing, not even another empty text (likeness 0). Texts with
fewer than five words have one shingle, all their words. Repeated rows give repeated
results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vantagrid.llm.columns import let
from vantagrid.llm.common import SPACES, small, utf8

#: Words in a shingle.
SHINGLE = 5
#: Hashes whose first so many bits are zero are kept: a fraction of 1/8.
ZERO_BITS = 3
#: Consecutive ids that are put in order together, and rows that one task may order.
SPAN, ONE_TASK = 1024, 8192


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACES}]+"), "")


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """A hash of each run of ``size`` words, of all words where there are fewer; each word's hash is the next one's seed."""

    def one(at: Column) -> Column:
        # beyond the last word there is null, which leaves the hash as it is
        return F.xxhash64(*[F.get(words, at - 1 + k) for k in range(size)])

    last = F.greatest(F.size(words) - size + 1, F.lit(1))
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(1), last), one)).otherwise(F.array().cast("array<bigint>"))


def kept(hashes: Column, zero_bits: int = ZERO_BITS) -> Column:
    """The sketch of a set of hashes, in order: those below the threshold, or the least."""
    flip = F.lit(-(1 << 63))

    def of(hashes: Column) -> Column:
        low = F.filter(hashes, lambda h: F.shiftrightunsigned(h, 64 - zero_bits) == 0)
        least = F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(flip))).bitwiseXOR(flip)
        return let(low, lambda x: F.when(F.size(x) > 0, F.array_sort(F.array_distinct(x))).when(F.size(hashes) > 0, F.array(least)).otherwise(x))

    return let(hashes, of)


def sketch(text: Column, size: int = SHINGLE, zero_bits: int = ZERO_BITS) -> Column:
    """The sketch of a text's shingles."""
    return let(words_of(text), lambda words: kept(shingle_hashes(words, size), zero_bits))


def merge(a: Column, b: Column, zero_bits: int = ZERO_BITS) -> Column:
    """The sketch of the shingles of two texts together."""
    return kept(F.array_union(a, b), zero_bits)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both, 0 to 1."""
    common = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - common
    return F.when(total > 0, common / total).otherwise(F.lit(0.0)).cast("double")


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(0.0)).cast("double")


def as_text(kept: Column) -> Column:
    return F.array_join(F.transform(kept, lambda h: F.lower(F.hex(h))), ",")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sketch), one row for each input row."""
    return df.select(df[id_col].alias(id_col), sketch(utf8(text_col)).alias("sketch"))


def _next_firsts(firsts: DataFrame, key: str = "part") -> DataFrame:
    """(part, first) to (part, next_first): the first of the next part that has rows, null for the last.

    Ordered in one task only while there are few parts; beyond that in parts of parts.
    """
    if small(firsts, ONE_TASK):
        return firsts.select(key, F.lead("first").over(Window.orderBy(key)).alias("next_first"))
    above = firsts.withColumn("above", F.floor(F.col(key) / SPAN))
    heads = above.groupBy("above").agg(F.min("first").alias("first"))
    tails = _next_firsts(heads.withColumnRenamed("above", "part")).select(F.col("part").alias("above"), F.col("next_first").alias("beyond"))
    inner = F.lead("first").over(Window.partitionBy("above").orderBy(key))
    return above.withColumn("inner", inner).join(tails, "above").select(key, F.coalesce("inner", "beyond").alias("next_first"))


def with_next(rows: DataFrame, carry: Callable[[Column], Column]) -> DataFrame:
    """``rows`` (doc_id, text) as (doc_id, own, next): ``carry`` of the own text and of the next row's by (doc_id, text hash); the first's after the last.

    Rows are ordered within spans of ids. Each span also gets a copy of the first row
    of the next span that has rows, so no order over the whole table is needed. Null
    ids come first.
    """
    lowest = -(1 << 62)
    keyed = rows.select("doc_id", "text", F.coalesce("doc_id", F.lit(lowest)).alias("order"), F.xxhash64("text").alias("mark"))
    keyed = keyed.withColumn("part", F.floor(F.col("order") / SPAN).cast("long"))
    firsts = keyed.groupBy("part").agg(F.min("order").alias("first"))
    following = _next_firsts(firsts)
    start = firsts.agg(F.min("first").alias("start"))
    following = following.crossJoin(F.broadcast(start)).select(F.col("part").alias("into"), F.coalesce("next_first", "start").alias("first"))
    if small(following, ONE_TASK):
        following = F.broadcast(following)
    guests = keyed.join(following, keyed["order"] == F.col("first")).groupBy("into").agg(F.min_by("text", "mark").alias("text"))
    null = F.lit(None).cast("long")
    guests = guests.select(null.alias("doc_id"), "text", null.alias("order"), null.alias("mark"), F.col("into").alias("part"), F.lit(True).alias("guest"))
    both = keyed.withColumn("guest", F.lit(False)).unionByName(guests)
    # from here on the text travels within what is carried, once
    carried = both.select("doc_id", "order", "mark", "part", "guest", carry(F.col("text")).alias("own"))
    order = Window.partitionBy("part").orderBy("guest", "order", "mark")
    return carried.withColumn("next", F.lead("own").over(order)).where(~F.col("guest")).select("doc_id", "own", "next")


def edited_texts(df: DataFrame) -> DataFrame:
    """(doc_id, text, sketch, edited, next_sketch): the last quarter of each text replaced by the next text's begin."""
    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), utf8().alias("text"))
    linked = with_next(rows, lambda text: F.struct(text.alias("text"), sketch(text).alias("sketch")))
    text = F.col("own.text")
    n = F.length(text)
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr(text, F.lit(1), n - cut), F.substr(F.col("next.text"), F.lit(1), cut))
    return linked.select("doc_id", text.alias("text"), F.col("own.sketch").alias("sketch"), edited.alias("edited"), F.col("next.sketch").alias("next_sketch"))
