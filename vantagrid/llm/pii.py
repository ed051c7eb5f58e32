"""Personal data: patterns, and terms that give protected entities away.

Emails, addresses of hosts, card and phone numbers are found by pattern. Each distinct
value is a protected entity. How much a nearby term tells of an entity is estimated
over the whole corpus: pointwise mutual information of term and entity over
documents, as a share of the entity's own information content,

    log(N * n(t, e) / (n(t) * n(e))) / log(N / n(e)),

where n counts documents, and n(t, e) those in which the term is one of the WINDOW words
outside of spans on either side of the entity, on its line. One meeting is no evidence:
term and entity must meet in SUPPORT documents, or on LINES lines of different text, of
one document or of several, so that an entity of a single document can have such terms.
Terms that tell at least ``GENERALISE`` of an entity are generalised, from ``REMOVE`` on
removed, wherever they stand in any text.

DataFrame functions only. Null and empty texts have no spans; a repeated row is a
document of its own in the counts and repeats its result; texts of any length, with any
number of matches, are read whole; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vantagrid.llm.columns import between, chunked, folded, let, located
from vantagrid.llm.common import Scratch, small

#: Base kinds in their order; the method's kinds follow them.
KINDS = ("email", "ip", "card", "phone", "remove", "general")
BASE = 4
#: Words on each side of an entity that may tell of it.
WINDOW = 6
#: Documents in which term and entity must meet, or else different lines; shares of an entity's information that a term may tell.
SUPPORT, LINES, GENERALISE, REMOVE = 3, 2, 0.75, 0.95
#: Terms and texts' keys that may be broadcast.
PICKED = 500_000

# Possessive quantifiers and the guards in front keep matching linear and change no match:
# a try from inside a run fails or succeeds as the try from the run's begin does.
_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
_TERM = r"\p{L}{3,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right counts double, less nine above nine."""

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - at, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(at % 2 == 1, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _accept(kind: str):
    def card(value: Column) -> Column:
        return let(_digits(value), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False))

    return {
        "email": lambda value: F.lit(True),
        "ip": lambda value: value.rlike(_OCTETS),
        "card": card,
        "phone": lambda value: F.length(_digits(value)).between(10, 15),
    }[kind]


#: A text without this has no match of the kind.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def base_spans(text: Column) -> Column:
    """array<struct<start, rank, kind, end, value>> of the base kinds, by start and then kind."""
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,value:string>>")
    found = []
    for rank, kind in enumerate(KINDS[:BASE]):
        spans = F.transform(located(text, _PATTERNS[kind], _accept(kind)), _labelled(rank, kind))
        needs = text.contains(_NEEDS[kind]) if _NEEDS[kind] else text.rlike("[0-9][ -]?[0-9]")
        found.append(F.when(needs, spans).otherwise(empty))
    return F.array_sort(F.concat(*found))


def _labelled(rank: int, kind: str):
    return lambda s: F.struct(s["start"], F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"], s["value"])


def entity(span: Column) -> Column:
    """The protected value a span stands for, however it is written."""
    plain = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), plain)


def _apart(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of ``rows`` (keys, words, spans): (keys, start, end, value, entity, nth): the words outside of spans, numbered by place, and the spans, each with the number of the word before; by sorting, within one text or line."""
    null = F.lit(None).cast("string")
    word = lambda w: F.struct(w["start"].alias("start"), F.lit(1).alias("word"), w["end"].alias("end"), w["value"].alias("value"), null.alias("entity"))
    span = lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("word"), s["end"].alias("end"), s["value"].alias("value"), entity(s).alias("entity"))
    both = rows.select(*keys, F.explode(F.concat(F.transform("spans", span), F.transform("words", word))).alias("x")).select(*keys, "x.*")
    so_far = Window.unboundedPreceding
    order = Window.partitionBy(*keys).orderBy("start", "word")
    # from behind, as a frame up to the end would be gone through anew for each row
    back = Window.partitionBy(*keys).orderBy(F.col("start").desc(), F.col("word").desc())
    follows = F.min(F.when(F.col("word") == 0, F.col("start"))).over(back.rowsBetween(so_far, -1))
    reached = F.max(F.when(F.col("word") == 0, F.col("end"))).over(order.rowsBetween(so_far, -1))
    both = both.withColumn("follows", follows).withColumn("reached", reached)
    free = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("follows") >= F.col("end"), F.lit(True))
    both = both.withColumn("free", free).where("word = 0 OR free")
    return both.select(*keys, "start", "end", "value", "entity", F.sum("word").over(order.rowsBetween(so_far, 0)).alias("nth"))


def _nearby(found: DataFrame) -> DataFrame:
    """(row, context, entity, term): words within WINDOW words of a base span, on its line; ``context`` is a hash of the line."""
    # no base span crosses a line
    lines = found.where(F.size("spans") > 0).select("row", F.explode(located(F.col("text"), "[^\\n]+", lambda value: F.lit(True))).alias("line"))
    lines = lines.select("row", F.col("line.start").alias("line"), F.col("line.value").alias("value"))
    lines = lines.withColumn("spans", base_spans(F.col("value"))).where(F.size("spans") > 0)
    lines = lines.select("row", "line", F.xxhash64("value").alias("context"), "spans", located(F.col("value"), _TERM, lambda value: F.lit(True)).alias("words"))
    rows = _apart(lines, ["row", "line", "context"])
    wanted = F.sequence(F.col("nth") - (WINDOW - 1), F.col("nth") + WINDOW)
    spans = rows.where(F.col("entity").isNotNull()).select("row", "line", "entity", F.explode(wanted).alias("nth"))
    words = rows.where(F.col("entity").isNull()).select("row", "line", "context", F.lower("value").alias("term"), "nth")
    return spans.join(words, ["row", "line", "nth"]).select("row", "context", "entity", "term")


def _picked(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if small(keys, PICKED) else keys


def disclosing_terms(docs: DataFrame, found: DataFrame, work: Scratch) -> tuple[DataFrame, DataFrame]:
    """(term, share): terms that tell at least GENERALISE of any entity, and the most they tell; and (id, mark, term) of where they are among others."""
    near = work.keep(_nearby(found))
    joint = near.groupBy("entity", "term").agg(F.count_distinct("row").alias("n_joint"), F.count_distinct("context").alias("lines"))
    joint = work.keep(joint.where((F.col("n_joint") >= SUPPORT) | (F.col("lines") >= LINES)).drop("lines"))
    values = F.array_distinct(F.transform("spans", entity))
    entities = found.where(F.size("spans") > 0).select(F.explode(values).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    held = work.keep(_words_of(docs, _picked(work.keep(joint.select("term").distinct()))))
    terms = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    n = F.lit(float(max(found.count(), 2)))
    told = F.log(n * F.col("n_joint") / (F.col("n_term") * F.col("n_entity")))
    share = told / F.log(n / F.col("n_entity"))
    both = joint.join(entities, "entity").join(terms, "term").where(F.col("n_entity") < n).withColumn("share", share)
    told = both.where(F.col("share") >= GENERALISE).groupBy("term").agg(F.max("share").alias("share"))
    return work.keep(told), held


def _words_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(id, mark, term) of every document and each of the ``terms`` (term) that it holds."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    return docs.select("id", "mark", F.explode(words).alias("term")).join(terms, "term", "left_semi")


def _everywhere(docs: DataFrame, told: DataFrame, held: DataFrame, work: Scratch) -> DataFrame:
    """(id, mark, text, extra): spans of every place of a told term outside base spans, of the texts that have any."""
    keys = work.keep(held.join(_picked(told.select("term")), "term", "left_semi").select("id", "mark").distinct())
    keys = _picked(keys.toDF("held", "held_mark"))
    same = docs["id"].eqNullSafe(keys["held"]) & (docs["mark"] == keys["held_mark"])
    texts = work.keep(docs.join(keys, same, "left_semi").dropDuplicates(["id", "mark"]).withColumn("spans", base_spans(F.col("text"))))
    # words are placed on the lines that have a told one
    lines = texts.select("id", "mark", F.explode(located(F.col("text"), "[^\\n]+", lambda value: F.lit(True))).alias("line"))
    lines = lines.select("id", "mark", F.col("line.start").alias("at"), F.col("line.value").alias("text"))
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    lines = work.keep(lines.withColumn("term", F.explode(words)).join(_picked(told.select("term")), "term", "left_semi").dropDuplicates(["id", "mark", "at"]))
    word = F.explode(located(F.col("text"), _TERM, lambda value: F.lit(True)))
    places = lines.select("id", "mark", "at", word.alias("w")).select("id", "mark", (F.col("at") + F.col("w.start")).alias("start"), (F.col("at") + F.col("w.end")).alias("end"), F.col("w.value").alias("value"))
    places = places.withColumn("term", F.lower("value")).join(_picked(told), "term").drop("term", "share")
    places = places.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "end", "value")).alias("words")).toDF("found", "found_mark", "words")
    same = texts["id"].eqNullSafe(places["found"]) & (texts["mark"] == places["found_mark"])
    rows = _apart(texts.join(places, same).select("id", "mark", "spans", "words"), ["id", "mark"])
    rows = rows.where(F.col("entity").isNull()).withColumn("term", F.lower("value")).join(_picked(told), "term")
    rank = F.when(F.col("share") >= REMOVE, 4).otherwise(5)
    kind = F.when(F.col("share") >= REMOVE, KINDS[4]).otherwise(KINDS[5])
    span = F.struct("start", rank.alias("rank"), kind.alias("kind"), "end", F.col("term").alias("value"))
    extra = rows.groupBy("id", "mark").agg(F.collect_list(span).alias("extra")).toDF("found", "found_mark", "extra")
    same = texts["id"].eqNullSafe(extra["found"]) & (texts["mark"] == extra["found_mark"])
    return work.keep(texts.join(extra, same).select("id", "mark", "text", "extra"))


def personal_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, sha256, spans): spans of array<struct<start, rank, kind, end, value>>, one row for each input row.

    ``text`` is null where there are no spans; ``sha256`` is the whole text's.
    """
    work = Scratch(df.sparkSession, "pii")
    text = F.coalesce(df[text_col], F.lit(""))
    docs = df.select(df[id_col].alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    marked = docs.withColumn("spans", base_spans(F.col("text")))
    text = F.when(F.size("spans") > 0, F.col("text"))
    found = work.keep(marked.select(F.monotonically_increasing_id().alias("row"), "id", "mark", F.sha2("text", 256).alias("sha256"), text.alias("text"), "spans"))
    told, held = disclosing_terms(docs, found, work)
    if told.isEmpty():
        return found.select(F.col("id").alias(id_col), "text", "sha256", "spans")
    extra = _everywhere(docs, told, held, work).toDF("held", "held_mark", "held_text", "extra")
    out = found.join(extra, found["id"].eqNullSafe(extra["held"]) & (found["mark"] == extra["held_mark"]), "left")
    spans = F.array_sort(F.concat("spans", F.coalesce("extra", F.array().cast(found.schema["spans"].dataType))))
    return out.select(F.col("id").alias(id_col), F.coalesce("text", "held_text").alias("text"), "sha256", spans.alias("spans"))


def cleaned(text: Column, spans: Column) -> Column:
    """A text with base spans named by kind, generalised terms by shape, removed terms gone. Of overlapping spans the first counts."""

    def shown(chunks: Column, p: Column) -> Column:
        shape = F.when(between(chunks, p["to"], p["to"] + 1).rlike(r"^\p{Lu}"), F.lit("[Name]")).otherwise(F.lit("[word]"))
        return F.when(p["rank"] < BASE, F.concat(F.lit("["), F.upper(p["kind"]), F.lit("]"))).when(p["rank"] == BASE + 1, shape).otherwise("")

    def first(at: Column, out: Column, s: Column) -> tuple[Column, Column]:
        piece = F.struct(at.alias("from"), s["start"].alias("to"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("on"))
        behind = s["start"] >= at
        return F.when(behind, s["end"]).otherwise(at), F.when(behind, F.concat(out, F.array(piece))).otherwise(out)

    def rebuilt(pieces: Column, chunks: Column) -> Column:
        parts = F.transform(pieces, lambda p: F.concat(between(chunks, p["from"], p["to"]), shown(chunks, p)))
        tail = between(chunks, F.coalesce(F.element_at(pieces, -1)["on"], F.lit(0)), F.length(text))
        return F.concat(F.array_join(parts, ""), tail)

    pieces = folded(spans, "struct<from:int,to:int,rank:int,kind:string,on:int>", first)
    return let(chunked(text), lambda chunks: let(pieces, lambda own: rebuilt(own, chunks)))


def sanitised(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, clean): ``cleaned`` texts, null where nothing changes. A disclosing term goes wherever it stands, also in texts without the entity."""
    found = personal_spans(df, id_col, text_col)
    return found.select(id_col, F.when(F.size("spans") > 0, cleaned(F.col("text"), F.col("spans"))).alias("clean"))
