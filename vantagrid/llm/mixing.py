"""Mixing sources to target weights by Pareto order sampling.

Each source has a target of words, found by sharing a budget in proportion to the
weights under a ceiling for each source. A document first gets the whole copies its
source's rate makes certain. What the source still needs goes to some documents as one
copy more, with inclusion probabilities in proportion to their sizes, so that the words
expected are those needed; documents whose probability would be 1 or more are certain
of theirs. The others follow in the order of their Pareto ranks, random odds divided by
inclusion odds, until the source's words are reached: a sample of fixed size in words.

The cut in each source is found by a radix search over the ranks: words are summed
for each (source, rank prefix), the prefix in which the target falls is kept, and
the next digits are looked at within it. No source is ever sorted in one task; the
probabilities' scale is found over a source's distinct sizes.

Null text or a text without words: size 0, never taken. A null source is a source of
its own, last in order. Repeated rows are separate candidates of equal rank; where the
cut falls among them, as many of them are taken as come nearest to the target (beyond
TIES of them, nearly so many). An empty table gives an empty result. Extra columns are
carried unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vantagrid.llm.common import WORD, Scratch, small, unused, utf8

#: Weights by the order of the sources, repeated.
WEIGHTS = (3, 1, 2)
#: Budget as a share of all words, and the most a source may give, in copies.
SHARE, CEILING = Fraction(3, 2), 2
#: Ranks are integers of so many bits, searched so many bits at a time.
RANK_BITS, DIGIT_BITS = 48, 12
#: Rows of one rank that are numbered in one task; sources whose plan may be broadcast.
TIES, PICKED = 1 << 16, 100_000


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def water_fill(sizes: Sequence[int], weights: Sequence[int], share: Fraction = SHARE, ceiling: int = CEILING) -> list[Fraction]:
    """Targets: the budget shared by weight; what exceeds a source's ceiling is shared again among the others."""
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    target = [Fraction(0)] * len(sizes)
    while open_:
        unit = Fraction(left, sum(weights[i] for i in open_))
        over = {i for i in open_ if unit * weights[i] >= ceiling * sizes[i]}
        if not over:
            for i in open_:
                target[i] = unit * weights[i]
            break
        for i in over:
            target[i] = Fraction(ceiling * sizes[i])
            left -= target[i]
        open_ -= over
    return target


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(source, source_size, target, whole, rest): one row a source; ``whole`` copies are certain, ``rest`` is words to draw.

    The driver holds one number for each source, never a document.
    """
    spark = sizes.sparkSession
    rows = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("n")).collect()
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    ns = [r.n for r in rows]
    targets = water_fill(ns, [weights[i % len(weights)] for i in range(len(rows))])
    out = []
    for r, n, t in zip(rows, ns, targets, strict=True):
        whole = int(t // n) if n else 0
        out.append((r.source, n, float(t), whole, float(t - whole * n)))
    return spark.createDataFrame(out, "source string, source_size long, target double, whole int, rest double")


def inclusion_scales(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(scaled_source, most, scale): documents over ``most`` words are certain of a copy, the others have size * scale as probability.

    From the largest size on: what is over a size is certain if the scale that the rest
    then has would still make the size's probability 1.
    """
    target = targets.select(F.col("source").alias("s"), "rest")
    rows = sizes.where("size > 0").join(target, sizes["source"].eqNullSafe(F.col("s"))).where("rest > 0").drop("s")
    exact = F.col("size").cast("decimal(19,0)")
    words, squares = (F.col("n") * exact).cast("decimal(38,0)"), (F.col("n") * exact * exact).cast("decimal(38,0)")
    larger = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("decimal(38,0)")
    rows = rows.select("source", "size", "rest", F.coalesce(F.sum(words).over(larger), none).alias("above"), (F.sum(squares).over(Window.partitionBy("source")) - F.coalesce(F.sum(squares).over(larger), none)).alias("squares"))
    scale = (F.col("rest") - F.col("above").cast("double")) / F.col("squares").cast("double")
    fits = rows.withColumn("scale", scale).where(F.col("scale") * F.col("size") < 1)
    best = fits.groupBy("source").agg(F.max(F.struct("size", "scale")).alias("b"))
    return best.select(F.col("source").alias("scaled_source"), F.col("b.size").alias("most"), F.col("b.scale").alias("scale"))


def pareto_rank(uniform: Column, rate: Column) -> Column:
    """Random odds over inclusion odds, mapped by x / (1 + x) to an integer that keeps their order."""
    odds = (uniform / (1 - uniform)) / (rate / (1 - rate))
    return F.when((rate > 0) & (rate < 1), F.floor(odds / (1 + odds) * F.lit(float(1 << RANK_BITS))).cast("long"))


def uniform(seed: int, doc_id: Column, text: Column) -> Column:
    """In (0, 1), from the document's id and text alone, so that reruns agree: 48 bits of a digest."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), doc_id.cast("string"), F.md5(text)))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def _rank(drawn: Column, size: Column, plan: str = "") -> Column:
    """0 for documents certain of a copy, a Pareto rank above 0 for those that may get one, else null."""
    may = F.greatest(pareto_rank(drawn, size * F.col(f"{plan}scale")), F.lit(1).cast("long"))
    rank = F.when(size > F.col(f"{plan}most"), F.lit(0).cast("long")).when(size * F.col(f"{plan}scale") > 0, may)
    return F.when((size > 0) & (F.col(f"{plan}rest") > 0), rank)


def _beside(plan: DataFrame) -> DataFrame:
    """One row a source, which the driver already holds; broadcast while they are few."""
    return F.broadcast(plan) if small(plan, PICKED) else plan


def with_copies(docs: DataFrame, seed: int = 7, weights: Sequence[int] = WEIGHTS, into: str = "__vg") -> DataFrame:
    """``docs`` with a struct column ``into``: size, source_size, target, copies. No text is shuffled, but of rows tied at a cut.

    Sizes and ranks are written once, narrow, to find the cuts; the texts are then
    scanned again beside one row for each source.
    """
    work = Scratch(docs.sparkSession, "mixing")
    own, drawn = size_of(F.coalesce(docs["text"], F.lit(""))), uniform(seed, docs["doc_id"], docs["text"])
    sized = work.keep(docs.select(docs["source"].alias("source"), own.alias("size"), drawn.alias("drawn")))
    sizes = work.keep(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    targets = work.keep(source_targets(sizes, weights).coalesce(1))
    scales = inclusion_scales(sizes, targets)
    targets = work.keep(targets.join(scales, targets["source"].eqNullSafe(F.col("scaled_source")), "left").drop("scaled_source").coalesce(1))
    ranked = sized.join(_beside(targets.withColumnRenamed("source", "s")), sized["source"].eqNullSafe(F.col("s")))
    ranked = work.keep(ranked.select("source", "size", "rest", _rank(F.col("drawn"), F.col("size")).alias("rank")))
    cuts = rank_cuts(ranked, work)
    plan = targets.join(cuts, targets["source"].eqNullSafe(F.col("cut_source")), "left").drop("cut_source").coalesce(1)
    name, size, rank = (unused(docs, n) for n in ("plan", "size", "rank"))
    plan = work.keep(plan.select(F.struct("source", "source_size", "target", "whole", "rest", "most", "scale", "cut", "take", "tied").alias(name)))
    out = docs.withColumns({size: own}).join(_beside(plan), docs["source"].eqNullSafe(F.col(f"{name}.source")))
    out = out.withColumns({rank: _rank(drawn, F.col(size), f"{name}.")})
    of = lambda c: F.col(f"{name}.{c}")

    def shown(rows: DataFrame, extra: Column) -> DataFrame:
        copies = F.when(F.col(size) > 0, of("whole") + F.coalesce(extra.cast("int"), F.lit(0))).otherwise(0)
        info = F.struct(F.col(size).alias("size"), of("source_size").alias("source_size"), of("target").alias("target"), copies.alias("copies"))
        return rows.select(*[docs[c] for c in docs.columns], info.alias(into))

    taken = (F.col(rank) < of("cut")) | (F.col(rank) == of("cut")) & (of("take") >= of("tied"))
    if cuts.where("0 < take AND take < tied").isEmpty():
        return shown(out, taken)
    # the cut is among repeated rows: these are numbered
    among = F.coalesce((F.col(rank) == of("cut")) & (of("take") > 0) & (of("take") < of("tied")), F.lit(False))
    parts, part, nth = F.ceil(of("tied") / TIES), unused(docs, "part"), unused(docs, "nth")
    tied = out.where(among).withColumns({part: F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts)})
    tied = tied.withColumns({nth: F.row_number().over(Window.partitionBy(f"{name}.source", part).orderBy(rank))})
    share = F.floor(of("take") * (F.col(part) + 1) / parts) - F.floor(of("take") * F.col(part) / parts)
    return shown(out.where(~among), taken).unionByName(shown(tied, F.col(nth) <= share))


def rank_cuts(ranked: DataFrame, work: Scratch) -> DataFrame:
    """(cut_source, cut, take, tied): extra copies go to ranks under ``cut`` and to ``take`` of the ``tied`` rows at it; one row a source.

    The number at which the words come nearest to what the source still needs.
    """
    state = None
    for shift in range(RANK_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        digit = F.shiftright("rank", shift)
        rows = ranked.where("rank IS NOT NULL")
        if state is None:
            rows = rows.withColumn("before", F.lit(0).cast("long"))
        else:
            prefix = _beside(state.select(F.col("source").alias("s"), "prefix", "before"))
            rows = rows.join(prefix, rows.source.eqNullSafe(F.col("s")) & (F.shiftright("rank", shift + DIGIT_BITS) == F.col("prefix"))).drop("s", "prefix")
        sums = rows.groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("tied"), F.first("before").alias("before"), F.first("rest").alias("rest"))
        order = Window.partitionBy("source").orderBy("digit")
        sums = sums.withColumn("upto", F.col("before") + F.sum("words").over(order)).withColumn("under", F.col("upto") - F.col("words"))
        last = F.row_number().over(Window.partitionBy("source").orderBy(F.col("digit").desc()))
        # the first digit whose words reach the rest; the last digit if none does
        hit = sums.withColumn("last", last).where("under < rest AND (upto >= rest OR last = 1)")
        state = work.keep(hit.select("source", F.col("digit").alias("prefix"), F.col("under").alias("before"), "words", "tied", "rest").coalesce(1))
    near = F.floor((F.col("rest") - F.col("before")) * F.col("tied") / F.col("words") + 0.5)
    return work.keep(state.select(F.col("source").alias("cut_source"), F.col("prefix").alias("cut"), F.least(near, F.col("tied")).alias("take"), "tied"))


def mix(docs: DataFrame, seed: int = 7, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """The mixed table: each row of ``docs`` as many times as the mix takes it, columns unchanged."""
    into, nth = unused(docs, "mix"), unused(docs, "copy")
    out = with_copies(docs, seed, weights, into).where(F.col(f"{into}.copies") > 0)
    return out.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(f"{into}.copies")))).select(*docs.columns)
