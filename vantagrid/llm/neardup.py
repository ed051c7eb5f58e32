"""MinHash near-dedup with odd sketches.

Every text's set of word shingles gives 512 MinHash samples. Bands of samples
nominate pairs; the samples are also folded into a bitmap of parities, an odd sketch,
and the bits in which two bitmaps differ tell a high similarity precisely enough to
reject most nominated pairs. What passes is confirmed on the full sets, read again
from the texts and compared by the words' bytes.

Texts of equal words in equal order (128 bits of a cryptographic digest) are one class
from the start. Of the classes that share bands, each is first compared with the hub of
each of its buckets, the class with the largest buckets, which settles groups of copies
with one pair a class; a hub's members are dealt to many tasks, each with the hub beside
them. Classes that share a bucket share its hub; so then, hub by hub and in blocks of
bounded members and shingles, all pairs of members that are still in different
components are compared: sketches first, then the texts of those that pass. Pairs within
a component cannot change the result. No pair is skipped otherwise and no bucket is capped.

Two sets of similarity 0.8 share no band with probability (1 - 0.8**8)**64 < 8e-6;
the bitmap's bound rejects such a pair with probability < 1e-5.

Null, empty and blank texts have empty sets and are linked with nothing, not even
with each other. Texts shorter than a shingle are one shingle. Rows of equal doc_id
count as one document, also where their texts differ: whatever one of them is linked
with, the document is. Null ids are no document in common; they count as greater than
all others. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantagrid.llm.common import Scratch, bounded_batches, small, unused
from vantagrid.llm.components import components
from vantagrid.llm.hashing import Digests, U, exact_shingle_sets, mix, sequence_digest, shingle_sets

#: Samples, and how many make a band.
SAMPLES, ROWS = 512, 8
#: Bits of an odd sketch.
BITS = 1024
#: Least similarity of a link, in hundredths.
SIMILAR = 80
#: Standard deviations by which a sketch may miss before a pair is rejected.
MARGIN = 4.5
#: Members of a hub, and about how many shingles, that are compared with as many others in one task.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
#: Rows of ids that may be broadcast to pick texts out of a scan.
PICKED = 500_000
#: Stands for a null id.
NO_ID = (1 << 63) - 1

_rng = np.random.default_rng(511)
_FACTORS = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_BAND_FACTORS = _rng.integers(0, 2**64, (SAMPLES // ROWS, ROWS), dtype=U) | U(1)


def minhash(values: np.ndarray) -> np.ndarray:
    """SAMPLES minima of a set of 64-bit hashes, half of them over each 32-bit part."""
    half = SAMPLES // 2
    parts = (values >> U(32)).astype(np.uint32), (values & U(0xFFFFFFFF)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), 256):
        for k, part in enumerate(parts):
            own = slice(k * half, (k + 1) * half)
            np.minimum(out[own], (part[at : at + 256, None] * _FACTORS[None, own]).min(axis=0), out=out[own])
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """(texts, bands) of 64-bit keys; different bands have different keys."""
    bands = samples.reshape(len(samples), SAMPLES // ROWS, ROWS).astype(U)
    return mix((mix(bands + U(1)) * _BAND_FACTORS[None]).sum(axis=2, dtype=U))


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """(texts, BITS // 64): bit b is the parity of the number of (place, sample) pairs that hash to b."""
    place = mix(samples.astype(U) * U(SAMPLES) + np.arange(SAMPLES, dtype=U)[None]) >> U(64 - int(math.log2(BITS)))
    spot = np.arange(len(samples))[:, None] * BITS + place.astype(np.int64)
    parity = (np.bincount(spot.ravel(), minlength=len(samples) * BITS) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(len(samples), BITS), axis=1).view(U)


def most_bits(similar: float) -> int:
    """Differing bits that two sketches of sets this similar stay under, by MARGIN standard deviations."""
    apart = 2 * SAMPLES * (1 - similar)
    share = (1 - math.exp(-2 * apart / BITS)) / 2
    from_samples = 2 * math.sqrt(SAMPLES * similar * (1 - similar)) * math.exp(-2 * apart / BITS)
    spread = math.sqrt(BITS * share * (1 - share) + from_samples**2)
    return math.ceil(BITS * share + MARGIN * spread)


_WORDS = [f"s{k}" for k in range(BITS // 64)]


def _rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, mark, text): rows of equal did and mark are one."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("did"), F.xxhash64(text).alias("mark"), text.alias("text"))


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(did, mark, n, h1, h2, bands, s0..): of every row; bands and sketch are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = Digests()
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            sets = shingle_sets(texts, shingle, digests)
            full = np.array([len(s) > 0 for s in sets], bool)
            samples = np.array([minhash(s) for s in sets if len(s)], np.uint32).reshape(-1, SAMPLES)
            halves = np.frombuffer(b"".join([sequence_digest(t) for t in texts]), np.int64).reshape(-1, 2)
            place = np.cumsum(full) - 1
            keys = band_keys(samples).view(np.int64)
            width = np.where(full, keys.shape[1] if len(keys) else 0, 0)
            offsets = pa.array(np.concatenate([[0], np.cumsum(width)]).astype(np.int32))
            bands = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
            odd = odd_sketches(samples).view(np.int64) if len(samples) else np.zeros((1, len(_WORDS)), np.int64)
            columns = [pa.array(odd[np.maximum(place, 0), k], mask=~full) for k in range(len(_WORDS))]
            n = pa.array([len(s) for s in sets], pa.int64())
            own = [batch.column(0), batch.column(1), n, pa.array(halves[:, 0]), pa.array(halves[:, 1]), bands]
            yield pa.RecordBatch.from_arrays([*own, *columns], ["did", "mark", "n", "h1", "h2", "bands", *_WORDS])

    bounded_batches(docs.sparkSession)
    return _rows(docs).mapInArrow(run, "did long, mark long, n long, h1 long, h2 long, bands array<long>, " + ", ".join(f"{w} long" for w in _WORDS))


def _apart(a: str, b: str) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in _WORDS])


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame, work: Scratch) -> DataFrame:
    """(cid, text) of the wanted classes, one row each; their keys travel to the scan while they are few."""
    keys = work.keep(classes.join(wanted, "cid", "left_semi").select("cid", "did", "mark"))
    picked = F.broadcast(keys) if small(keys, PICKED) else keys
    return _rows(docs).join(picked, ["did", "mark"]).groupBy("cid").agg(F.first("text").alias("text"))


def _blocks() -> Column:
    """Into how many blocks a hub's members (n of them, with so many shingles) are dealt."""
    return F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")


def _dealt(cid: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(cid), F.col(blocks)).cast("int")


def _near(x: np.ndarray, y: np.ndarray, similar: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= similar * (len(x) + len(y) - common) > 0


_LINKS = "u long, v long"


def _linked(u: list, v: list) -> pa.Table:
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _with_hubs(rows: DataFrame, shingle: int, similar: int) -> DataFrame:
    """Links of the members in each (hub, salt) with their hub, which is among them."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        ids = t.column("cid").to_pylist()
        hub = ids.index(key[0].as_py())
        sets = exact_shingle_sets(t.column("text").cast(pa.binary()).to_pylist(), shingle)
        near = [c for k, c in enumerate(ids) if k != hub and _near(sets[k], sets[hub], similar)]
        return _linked(near, [ids[hub]] * len(near))

    return rows.select("hub", "salt", "cid", "text").groupBy("hub", "salt").applyInArrow(run, _LINKS)


def _open_pairs(t: pa.Table, low: int, high: int, bound: int, similar: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of two blocks: each left row with the right rows in other components whose sketches and sizes allow a link."""
    component, own, size = (t.column(c).to_numpy() for c in ("component", "own", "n"))
    if (component == component[0]).all():
        return
    bits = np.column_stack([t.column(w).to_numpy() for w in _WORDS]).view(U)
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    for a in left.tolist():
        near = right if low != high else right[right > a]
        near = near[component[near] != component[a]]
        near = near[100 * np.minimum(size[near], size[a]) >= similar * np.maximum(size[near], size[a])]
        near = near[np.bitwise_count(bits[near] ^ bits[a]).sum(axis=1, dtype=np.int64) <= bound]
        if len(near):
            yield a, near


def _passing(rows: DataFrame, similar: int, bound: int) -> DataFrame:
    """(hub, low, high, cid): the members of each pair of blocks that any open pair is made of, by sketches alone."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        some = {x for a, near in _open_pairs(t, key[1].as_py(), key[2].as_py(), bound, similar) for x in (a, *near.tolist())}
        ids = t.column("cid").to_numpy()[sorted(some)]
        fixed = [pa.array(np.full(len(ids), k.as_py()), k.type) for k in key]
        return pa.table([*fixed, pa.array(ids, pa.int64())], names=["hub", "low", "high", "cid"])

    flat = rows.select("hub", "low", "high", "own", "cid", "component", "n", *_WORDS)
    return flat.groupBy("hub", "low", "high").applyInArrow(run, "hub long, low int, high int, cid long")


def _between(rows: DataFrame, shingle: int, similar: int, bound: int) -> DataFrame:
    """Links between components in each pair of blocks; of links that would join the same two one is enough."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ids, component = t.column("cid").to_numpy(), t.column("component").to_pylist()
        sets = exact_shingle_sets(t.column("text").cast(pa.binary()).to_pylist(), shingle)
        u, v, root = [], [], {c: c for c in component}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        for a, near in _open_pairs(t, key[1].as_py(), key[2].as_py(), bound, similar):
            for b in near.tolist():
                x, y = find(component[a]), find(component[b])
                if x != y and _near(sets[a], sets[b], similar):
                    root[max(x, y)] = min(x, y)
                    u.append(ids[a])
                    v.append(ids[b])
        return _linked(u, v)

    flat = rows.select("hub", "low", "high", "own", "cid", "component", "n", "text", *_WORDS)
    return flat.groupBy("hub", "low", "high").applyInArrow(run, _LINKS)


def text_groups(docs: DataFrame, shingle: int, similar: int, work: Scratch) -> DataFrame:
    """(did, mark, n, component): each row with the group of its text; null for empty sets."""
    marks = work.keep(signatures(docs, shingle))
    full = marks.where("n > 0").groupBy("h1", "h2")
    classes = full.agg(F.min(F.struct("did", "mark")).alias("at"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first(F.struct(*_WORDS)).alias("s"))
    # the numbers are those that are written
    classes = work.keep(classes.select(F.monotonically_increasing_id().alias("cid"), "h1", "h2", "at.did", "at.mark", "n", "bands", "s"))
    banded = classes.select("cid", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = work.keep(banded.join(shared, "key"))
    sketches = classes.select("cid", "n", "s")
    bound = most_bits(similar / 100)

    # every class with the hub of each of its buckets
    weight = buckets.groupBy("cid").agg(F.sum("members").alias("weight"))
    hubs = work.keep(buckets.join(weight, "cid").groupBy("key").agg(F.max_by("cid", F.struct("weight", -F.col("cid"))).alias("hub")))
    members = work.keep(buckets.join(hubs, "key").select("hub", "cid").distinct())
    salts = members.join(sketches.select("cid", "n"), "cid")
    salts = salts.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("shingles")).select("hub", _blocks().alias("salts"))
    salts = work.keep(salts)
    centres = salts.join(sketches.withColumnRenamed("cid", "hub"), "hub")
    centres = centres.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("s").alias("hs"))
    spread = members.where("cid <> hub").join(salts, "hub").select("hub", _dealt("cid", "salts").alias("salt"), "cid")
    spread = spread.join(sketches.select("cid", "s"), "cid")
    pairs = work.keep(spread.join(centres, ["hub", "salt"]).where(_apart("s", "hs") <= bound).select("hub", "salt", "cid"))
    star = pairs.unionByName(pairs.select("hub", "salt", F.col("hub").alias("cid")).distinct())
    texts = _texts(docs, classes, star.select("cid").distinct(), work)
    links = work.keep(_with_hubs(star.join(texts, "cid"), shingle, similar))
    groups = components(links, work)

    # every nominated pair that could still join two components: both share the bucket's hub
    placed = members.join(groups.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    placed = work.keep(placed.join(sketches.select("cid", "n"), "cid"))
    spread = placed.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("shingles"), F.min("component").alias("low"), F.max("component").alias("high"))
    spread = spread.where("low < high").select("hub", _blocks().alias("blocks"))
    rest = placed.join(spread, "hub").withColumn("own", _dealt("cid", "blocks"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = work.keep(rest.select("hub", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "cid", "component"))
    rest = rest.join(sketches.select("cid", "n", "s.*"), "cid")
    passing = work.keep(_passing(rest, similar, bound))
    texts = _texts(docs, classes, passing.select("cid").distinct(), work)
    rest = rest.join(passing, ["hub", "low", "high", "cid"], "left_semi").join(texts, "cid")
    links = links.unionByName(work.keep(_between(rest, shingle, similar, bound)))
    groups = components(links, work).withColumnRenamed("id", "cid")

    found = classes.select("cid", "h1", "h2").join(groups, "cid", "left").select("h1", "h2", F.coalesce("component", "cid").alias("component"))
    out = marks.select("did", "mark", "n", "h1", "h2").join(found, ["h1", "h2"], "left")
    return work.keep(out.select("did", "mark", "n", F.when(F.col("n") > 0, F.col("component")).alias("component")))


def near_duplicates(docs: DataFrame, shingle: int = 5, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each input row."""
    work = Scratch(docs.sparkSession, "neardup")
    rows = text_groups(docs.select("doc_id", "text"), shingle, similar, work)
    named = rows.where(F.col("component").isNotNull())
    # documents of several texts join the groups of these
    held = named.where(F.col("did") < NO_ID).groupBy("did").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    held = work.keep(held.select("did", "least"))
    if held.isEmpty():
        wide = named.withColumn("wide", F.col("component"))
    else:
        joined = components(named.join(held, "did").select(F.col("component").alias("u"), F.col("least").alias("v")), work)
        wide = named.join(joined.select(F.col("id").alias("component"), F.col("component").alias("joined")), "component", "left").withColumn("wide", F.coalesce("joined", "component"))
    # written, so that the join below may split a group that holds many rows
    heads = work.keep(wide.groupBy("wide").agg(F.min("did").alias("head")))
    # one row for each group and document; rows without words follow their document's others
    told = work.keep(wide.join(heads, "wide").select("did", "component", "head").distinct())
    by_text = rows.join(told, ["did", "component"], "left")
    lone = work.keep(rows.where("component IS NULL").select("did").distinct().join(told.where(F.col("did") < NO_ID).groupBy("did").agg(F.min("head").alias("other")), "did"))
    if not lone.isEmpty():
        by_text = by_text.join(lone, "did", "left").withColumn("head", F.when(F.col("component").isNull(), F.col("other")).otherwise(F.col("head")))
    shown = lambda c: F.when(c < NO_ID, c)
    return by_text.select(shown(F.col("did")).alias("doc_id"), F.col("n").alias("n_shingles"), shown(F.coalesce("head", "did")).alias("component_id"))


def representatives(docs: DataFrame, shingle: int = 5, similar: int = SIMILAR) -> DataFrame:
    """One row of ``docs`` for each group of texts, that of the least doc_id, and all rows without words; columns unchanged.

    Groups are those of the texts alone: a text stays unless one it is grouped with stays.
    Only the keys of rows that go are matched with the texts.
    """
    work = Scratch(docs.sparkSession, "neardup")
    rows = text_groups(docs, shingle, similar, work).where("n > 0")
    heads = work.keep(rows.groupBy("component").agg(F.min(F.struct("did", "mark")).alias("head")))
    gone = rows.join(heads, "component").where(F.struct("did", "mark") != F.col("head"))
    gone = work.keep(gone.select("did", "mark").distinct())
    twice = rows.groupBy("did", "mark").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("did", "mark")
    twice = work.keep(twice.join(gone, ["did", "mark"], "left_anti"))
    kept = _matched(docs, gone, "left_anti")
    if twice.isEmpty():
        return kept
    # a row repeated with its doc_id stays once
    did, mark = _keys(docs)
    names = unused(docs, "did"), unused(docs, "mark")
    again = _matched(docs, twice, "left_semi").withColumns(dict(zip(names, (did, mark), strict=True)))
    again = again.dropDuplicates(names).select(*docs.columns)
    return _matched(kept, twice, "left_anti").unionByName(again)


def _keys(docs: DataFrame) -> tuple[Column, Column]:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def _matched(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` by (did, mark); the keys are broadcast while they are few."""
    own, other = unused(docs, "did"), unused(docs, "mark")
    keys = keys.toDF(own, other)
    keys = F.broadcast(keys) if small(keys, PICKED) else keys
    did, mark = _keys(docs)
    return docs.join(keys, (did == keys[own]) & (mark == keys[other]), how)
