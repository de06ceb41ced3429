"""Personal data and what gives it away, in DataFrame functions only.

Base kinds (e-mail, IP address, card, phone) are found by pattern. Every distinct value found is a protected entity. From
all documents the corpus statistics tell how strongly a term of a document reveals an entity in it: with ``n`` documents
holding the term, the entity, or both, the pointwise mutual information of the two is set against the information content of
the entity. A ratio of 1 means that the term occurs nowhere without the entity. Terms at or above ``GENERALISE`` are replaced
by a general label, at or above ``REMOVE`` they are removed, wherever they stand in a document that holds the entity. A term
counts only with an entity that it accompanies in ``SUPPORT`` different texts, as a single text proves no association; copies
of a text are one text.

Null text counts as empty: no spans. Repeated rows get the same spans. Positions are code points, ends exclusive. A document
holds a term where it stands clear of all entities. Whole texts are compared, at any distance. Before terms and entities are
paired those fall away that can't reach ``SUPPORT`` or ``GENERALISE`` by their own counts; this loses no pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.llm.common import require, text_of
from tabaudit.session import written

# The base patterns. Possessive, with a look behind where a run of characters can only match from its
# start: the same matches as the plain patterns, in linear time and without recursion.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9 -]{11}", "phone": r"\+[0-9]"}
TERM = r"\p{L}{3,}+"
OCTET = "(?:0++|0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]?))"

#: Stands for the letters of an entity. It is no letter, and documents' own ones become spaces.
HIDDEN = "\U0010ffff"
RUN = r"[\p{L}\x{10FFFF}]{3,}+"
SUPPORT = 3
#: Matches whose distances are added up at a time.
RUN_LENGTH = 64
GENERALISE, REMOVE = 0.7, 0.9


def record(**fields: Column) -> Column:
    """A struct with these field names, inside of lambdas too."""
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def matches(text: Column, pattern: str, hint: str) -> Column:
    """Matched texts, leftmost and not overlapping. ``hint`` is a cheap pattern that every text with a match has."""
    return F.when(text.rlike(hint), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def gaps(text: Column, pattern: str, values: Column) -> Column:
    """What stands before each match, and after the last."""
    return F.when(F.size(values) > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))


def pieces_of(text: Column, pattern: str, values: Column) -> Column:
    """Each match with the length of the gap before it. A column of its own: :func:`placed` reads it many times."""
    pieces = F.zip_with(values, gaps(text, pattern, values), lambda value, gap: record(value=value, gap=F.length(gap)))
    return F.filter(pieces, lambda x: x["value"].isNotNull())


def placed(pieces: Column, wanted: Callable[[Column], Column] = lambda value: F.lit(True)) -> Column:
    """The wanted matches as an array of ``(at, value)`` with positions in code points: what stands between matches gives the distances.

    Distances are added up in runs of ``RUN_LENGTH`` matches and then over the runs, as an array that grows by one element
    at a time would be copied for each of them.
    """
    start = record(end=F.lit(0), out=F.array().cast("array<struct<at:int,value:string>>"))

    def step(state: Column, x: Column) -> Column:
        at = state["end"] + x["gap"]
        out = F.when(wanted(x["value"]), F.array_append(state["out"], record(at=at, value=x["value"]))).otherwise(state["out"])
        return record(end=at + F.length(x["value"]), out=out)

    starts = F.when(F.size(pieces) > 0, F.sequence(F.lit(1), F.size(pieces), F.lit(RUN_LENGTH))).otherwise(F.array().cast("array<int>"))
    runs = F.transform(starts, lambda first: F.aggregate(F.slice(pieces, first, F.lit(RUN_LENGTH)), start, step))
    based = record(end=F.lit(0), out=F.array().cast("array<struct<base:int,found:array<struct<at:int,value:string>>>>"))
    runs = F.aggregate(
        runs, based, lambda state, run: record(end=state["end"] + run["end"], out=F.array_append(state["out"], record(base=state["end"], found=run["out"]))), lambda state: state["out"]
    )
    return F.flatten(F.transform(runs, lambda run: F.transform(run["found"], lambda x: record(at=run["base"] + x["at"], value=x["value"]))))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text, text_key, n_points``, for each kind an array of ``(at, value)``, and ``clear``: a text with entities hidden, else null."""
    rows = require(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.select("*", *[matches(F.col("text"), p, HINTS[k]).alias(f"all_{k}") for k, p in PATTERNS.items()])

    rows = rows.select("*", *[pieces_of(F.col("text"), p, F.col(f"all_{k}")).alias(f"pieces_{k}") for k, p in PATTERNS.items()])

    def checked(kind: str) -> Column:
        return F.filter(placed(F.col(f"pieces_{kind}")), lambda x: valid(kind, x["value"])).alias(kind)

    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.length("text").alias("n_points"), "all_email", *[checked(k) for k in PATTERNS])
    # Of the base kinds only e-mails have letters, and all their matches count.
    hidden = F.zip_with(
        gaps(F.col("text"), PATTERNS["email"], F.col("all_email")), F.col("all_email"),
        lambda gap, value: F.concat(own_clear(F.coalesce(gap, F.lit(""))), F.regexp_replace(own_clear(F.coalesce(value, F.lit(""))), r"\p{L}", HIDDEN)),
    )
    clear = F.when(F.size("all_email") > 0, F.array_join(hidden, "")).otherwise(own_clear(F.col("text")))
    found = F.lit(False)
    for kind in PATTERNS:
        found = found | (F.size(kind) > 0)
    return rows.withColumn("clear", F.when(found, clear)).drop("all_email")


def own_clear(text: Column) -> Column:
    """A text without the sign that hides entities; positions stay."""
    return F.replace(text, F.lit(HIDDEN), F.lit(" "))


def runs(clear: Column) -> Column:
    return F.regexp_extract_all(clear, F.lit(RUN), F.lit(0))


def terms_of(clear: Column) -> Column:
    """The different terms that stand clear of entities. A run of letters that overlaps an entity is no term."""
    return F.array_distinct(F.transform(F.filter(runs(clear), lambda x: ~F.contains(x, F.lit(HIDDEN))), F.lower))


def ratio_of(total: float, n_both: Column, n_term: Column, n_entity: Column) -> Column:
    content = F.log2(total / n_entity)
    return F.when(content > 0, F.log2(total * n_both / (n_term * n_entity)) / content).otherwise(F.lit(0.0))


def possible(total: float, n_term: Column, n_entity: Column) -> Column:
    """Whether the ratio can reach ``GENERALISE``: the two meet in no more documents than the rarer one has."""
    return ratio_of(total, F.least(n_term, n_entity), n_term, n_entity) >= GENERALISE - 1e-9


TEXT, ENTITY = ["text_key", "n_points"], ["kind", "value"]


def _holders(base: DataFrame) -> DataFrame:
    """``text_key, n_points, copies, kind, value, n_entity``: the entities of each different text that occur in ``SUPPORT`` of them."""
    texts = base.where("clear IS NOT NULL").groupBy(*TEXT).agg(F.count(F.lit(1)).alias("copies"), F.first(F.struct(*PATTERNS)).alias("x"))
    values = [F.transform(f"x.{k}", lambda s: record(kind=F.lit(k), value=s["value"])) for k in PATTERNS]
    entities = texts.select(*TEXT, "copies", F.explode(F.array_distinct(F.concat(*values))).alias("e")).select(*TEXT, "copies", "e.kind", "e.value")
    counts = entities.groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("n_entity"))
    return entities.join(counts.where(F.col("texts") >= SUPPORT).drop("texts"), ENTITY)


def _terms(docs: DataFrame, base: DataFrame, holders: DataFrame, total: float) -> DataFrame:
    """``text_key, n_points, term, n_term``: terms of the texts with such entities, as far as their number allows a ratio."""
    most = holders.where(F.col("n_entity") < total).agg(F.coalesce(F.max("n_entity"), F.lit(0))).first()[0]
    words = base_spans(docs).select(F.explode(terms_of(F.coalesce("clear", own_clear(F.col("text"))))).alias("term"))
    n_term = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).where(F.col("n_term") >= SUPPORT)
    n_term = n_term.where(possible(total, F.col("n_term"), F.lit(most))) if most else n_term.where("false")
    texts = base.where("clear IS NOT NULL").select(*TEXT, "clear").join(holders.select(*TEXT).distinct(), TEXT, "left_semi").dropDuplicates(TEXT)
    return texts.select(*TEXT, F.explode(terms_of(F.col("clear"))).alias("term")).join(n_term, "term")


def disclosures(holders: DataFrame, terms: DataFrame, total: float) -> DataFrame:
    """``kind, value, term, ratio``: terms that reveal an entity, by co-occurrence over the whole corpus."""
    n_term, n_entity = F.col("n_term"), F.col("n_entity")
    met = terms.join(holders, TEXT).where(possible(total, n_term, n_entity)).groupBy(*ENTITY, "term", "n_term", "n_entity")
    met = met.agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("n_both")).where(F.col("texts") >= SUPPORT)
    return met.select(*ENTITY, "term", ratio_of(total, F.col("n_both"), n_term, n_entity).alias("ratio")).where(F.col("ratio") >= GENERALISE)


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key``, the base arrays, and ``terms``: an array of ``(kind, at, end)`` with kind generalise or remove."""
    base = written(base_spans(docs).drop("text"))
    holders, total = written(_holders(base)), float(base.count())
    terms = written(_terms(docs, base, holders, total))
    told = written(disclosures(holders, terms, total))
    marked = terms.join(told, "term").join(holders.select(*TEXT, *ENTITY), [*TEXT, *ENTITY], "left_semi").groupBy(*TEXT, "term").agg(F.max("ratio").alias("ratio"))
    label = F.when(F.col("ratio") >= REMOVE, F.lit("remove")).otherwise(F.lit("generalise"))
    marked = marked.groupBy(*TEXT).agg(F.map_from_entries(F.collect_list(F.struct("term", label.alias("kind")))).alias("told"))
    found = placed(F.col("pieces"), lambda value: F.element_at("told", F.lower(value)).isNotNull())
    found = F.transform(found, lambda t: record(kind=F.element_at("told", F.lower(t["value"])), at=t["at"], end=t["at"] + F.length(t["value"])))
    none = F.array().cast("array<struct<kind:string,at:int,end:int>>")
    rows = base.join(marked, TEXT, "left").withColumn("pieces", F.when(F.col("told").isNotNull(), pieces_of(F.col("clear"), RUN, runs(F.col("clear")))))
    rows = rows.withColumn("terms", F.when(F.col("told").isNotNull(), F.sort_array(found)).otherwise(none))
    return rows.drop("clear", "told", "pieces")


def listed(kind: str) -> Column:
    """``kind:start:end`` of each base span of a kind, in the order of the text."""
    return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["at"], s["at"] + F.length(s["value"])))


def found_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``, one row for each row of ``docs``."""
    base = F.concat(*[listed(k) for k in PATTERNS])
    terms = F.transform("terms", lambda t: F.concat_ws(":", t["kind"], t["at"], t["end"]))
    return spans(docs).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, terms), ",").alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` sanitised: entities by their kind, revealing terms by a general label or nothing.

    Where spans overlap the one that starts first stays, then the longer one.
    """

    def mark(kind: str) -> Column:
        return F.transform(kind, lambda s: record(at=s["at"], back=-s["at"] - F.length(s["value"]), label=F.lit(f"<{kind.upper()}>")))

    label = F.transform("terms", lambda t: record(at=t["at"], back=-t["end"], label=F.when(t["kind"] == "remove", F.lit("")).otherwise(F.lit("<RELATED>"))))
    keys = spans(docs).select("text_key", "n_points", F.array_sort(F.concat(*[mark(k) for k in PATTERNS], label)).alias("_marks")).dropDuplicates(["text_key", "n_points"])
    keys = written(keys.select(F.col("text_key").alias("_key"), F.col("n_points").alias("_points"), "_marks"))
    text = text_of()
    state = record(end=F.lit(0), out=F.lit(""))

    def step(s: Column, m: Column) -> Column:
        piece = F.concat(s["out"], F.substring(text, s["end"] + 1, m["at"] - s["end"]), m["label"])
        skip = m["at"] < s["end"]
        return record(end=F.when(skip, s["end"]).otherwise(-m["back"]), out=F.when(skip, s["out"]).otherwise(piece))

    clean = F.aggregate("_marks", state, step, lambda s: F.concat(s["out"], F.substring(text, s["end"] + 1, F.length(text))))
    joined = docs.join(keys, (F.xxhash64(text) == F.col("_key")) & (F.length(text) == F.col("_points")), "left")
    return joined.select(*[(F.when(F.size("_marks") > 0, clean).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`")) for c in docs.columns])
