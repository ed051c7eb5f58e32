"""Column helpers for operators that stay in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once; inside lambdas a plain expression is computed at each step."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Items that are folded together, and code points of a text that are looked through for one place.
BLOCK, CHUNK = 512, 4096


def folded(items: Column, of: str, step: Callable[[Column, Column, Column], tuple[Column, Column]]) -> Column:
    """Walks along an array with a place, from 0 on: ``step`` of (place, what came out so far, item) gives both anew; array<``of``>.

    What comes out grows in blocks, so that very many items take time in proportion.
    """
    empty = F.array().cast(f"array<{of}>")

    def one(acc: Column, item: Column) -> Column:
        at, out = step(acc["at"], acc["out"], item)
        return F.struct(at.alias("at"), out.alias("out"))

    def block(acc: Column, k: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), empty.alias("out"))
        own = F.aggregate(F.slice(items, k * BLOCK + 1, F.lit(BLOCK)), start, one)
        return let(own, lambda own: F.struct(own["at"].alias("at"), F.concat(acc["out"], F.array(own["out"])).alias("out")))

    blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / BLOCK).cast("int"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{of}>>").alias("out"))
    return F.aggregate(blocks, start, block, lambda acc: F.flatten(acc["out"]))


def located(text: Column, pattern: str, keep: Callable[[Column], Column]) -> Column:
    """Matches of ``pattern`` that ``keep`` accepts, as array<struct<start,end,value>> in code points.

    What lies between matches gives their places: match i starts behind the first
    i + 1 pieces and the first i matches.
    """
    of = "struct<start:int,end:int,value:string>"

    def step(at: Column, out: Column, piece: Column) -> tuple[Column, Column]:
        value = F.coalesce(piece["found"], F.lit(""))
        start = at + F.length(piece["pieces"])
        end = start + F.length(value)
        one = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
        return end, F.when((value != "") & keep(value), F.concat(out, F.array(one))).otherwise(out)

    def walk(found: Column) -> Column:
        zipped = F.arrays_zip(F.split(text, pattern, -1).alias("pieces"), found.alias("found"))
        return F.when(F.exists(found, keep), let(zipped, lambda z: folded(z, of, step))).otherwise(F.array().cast(f"array<{of}>"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), walk)


def chunked(text: Column) -> Column:
    """A text in chunks of CHUNK code points, for ``between``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def between(chunks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end``; the rest of the text is not looked through."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor(end / CHUNK).cast("int")
    at = lambda k: F.coalesce(F.get(chunks, k), F.lit(""))
    head = F.substr(at(first), start - first * CHUNK + 1, F.lit(CHUNK))
    inside = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    parts = F.concat(head, inside, F.substr(at(last), F.lit(1), end - last * CHUNK))
    return F.when(first == last, F.substr(at(first), start - first * CHUNK + 1, end - start)).otherwise(parts)
