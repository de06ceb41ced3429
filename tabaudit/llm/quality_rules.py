"""Quality rules by distribution divergence, in DataFrame functions only.

A document's characters and common words are compared with the reference of its language: two histograms each, and the
Jensen-Shannon distance between them (0 to 1). The references are sums over all documents of the language that pass the
base rules. A document is rejected when a distance is above its limit. Guards on the length keep short texts, whose
histograms say little, from being judged: they are kept unless a base rule fails.

A null or unknown language is a language of its own, with a reference for characters only (no common words are known).
Null text has no words and fails the base rule on length. Rows may repeat; each is judged by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.llm.common import WHITE_SPACE, require, text_of, words_of
from tabaudit.session import written

# Common words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on are this from or at an which have not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}
CODES = "ABCDEFGHIJKLMNOPQRSTUVWXY"
CHARACTERS = ["lower", "upper", "digit", "mark", "symbol", "line", "rest"]

MIN_WORDS, MAX_REPEATED = 50, 50
#: Limits of the two distances, and the least number of words to be judged by them.
CHARACTER_LIMIT, CHARACTER_WORDS = 0.27, 50
WORD_LIMIT, WORD_WORDS = 0.29, 100


def _windows(words: Column, of) -> Column:
    """``of(three words, position)`` for each run of three words."""
    inner = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(inner, lambda w, i: of(w, F.get(words, i + 1), F.get(words, i + 2), i))


def measured(docs: DataFrame) -> DataFrame:
    """Base counts of every document, its character counts and the codes of its common words."""
    rows = require(docs, "doc_id", "text", "lang").select("doc_id", F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    # One pass takes lower-case letters and blanks away; what is left is short, and the other counts come from it.
    rows = rows.withColumn("odd", F.regexp_replace("text", "[\\p{Ll} ]+", ""))
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(WHITE_SPACE)) != "")
    rows = rows.select(
        "doc_id", "lang", "words", "odd", F.length("text").cast("long").alias("n_points"), F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"), lines.alias("lines"),
        F.size(F.array_distinct(_windows(F.col("words"), lambda a, b, c, i: F.xxhash64(a, b, c)))).alias("n_distinct"),
    )
    # Only texts in which two windows have the same hash are looked at again, by the words themselves.
    repeats = F.greatest(F.col("n_words") - 2, F.lit(0)) > F.col("n_distinct")
    ordered = F.array_sort(_windows(F.col("words"), lambda a, b, c, i: F.struct(F.concat_ws(" ", a, b, c).alias("w"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(repeats, ordered))

    def again(x: Column, j: Column) -> Column:
        same = [F.coalesce(F.get("ordered", k)["w"] == x["w"], F.lit(False)) for k in (j - 1, j + 1)]
        return same[0] | same[1]

    at = F.transform(F.filter("ordered", again), lambda x: x["i"])
    covered = F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    def taken(pattern: str) -> Column:
        return F.length("odd") - F.length(F.regexp_replace("odd", pattern, ""))

    codes = F.lit("")
    for lang, common in COMMON_WORDS.items():
        table = F.create_map(*[F.lit(x) for pair in zip(common, CODES) for x in pair])
        found = F.transform(F.filter("words", lambda w: F.lower(w).isin(common)), lambda w: F.element_at(table, F.lower(w)))
        codes = F.when(F.col("lang") == lang, F.array_join(found, "")).otherwise(codes)
    return rows.select(
        "doc_id", "lang", "n_words", "word_chars", taken("[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(repeats, covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        codes.alias("codes"), "n_points", taken("\\p{Lu}+").alias("upper"), taken("\\p{N}+").alias("digit"),
        taken("[.,;:!?'\"()-]+").alias("mark"), taken("[\\n\\r]+").alias("line"), F.length("odd").alias("odd"),
    )


def _histograms(rows: DataFrame) -> DataFrame:
    """Adds ``characters`` and ``common``: counts as arrays, and ``base_failed``."""
    known = F.col("upper") + F.col("digit") + F.col("mark") + F.col("line") + F.col("n_symbols")
    characters = [F.col("n_points") - F.col("odd"), F.col("upper"), F.col("digit"), F.col("mark"), F.col("n_symbols"), F.col("line"), F.greatest(F.col("odd") - known, F.lit(0))]
    common = [F.length("codes") - F.length(F.replace("codes", F.lit(code), F.lit(""))) for code in CODES]
    common.append(F.col("n_words") - F.length("codes"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        F.array(*[c.cast("double") for c in characters]).alias("characters"), F.array(*[c.cast("double") for c in common]).alias("common"),
    )


def references(rows: DataFrame) -> DataFrame:
    """``ref_lang, ref_characters, ref_common``: summed counts of each language."""
    n = {"characters": len(CHARACTERS), "common": len(CODES) + 1}
    sums = [F.sum(F.col(name)[k]).alias(f"{name}_{k}") for name in n for k in range(n[name])]
    summed = rows.where("NOT base_failed").groupBy(F.col("lang").alias("ref_lang")).agg(*sums)
    return summed.select("ref_lang", *[F.array(*[F.col(f"{name}_{k}") for k in range(n[name])]).alias(f"ref_{name}") for name in n])


def distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts: the root of the divergence in bits. 0 if either is empty."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda n, v: n + v)

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    n_a, n_b = total(a), total(b)
    parts = F.zip_with(a, b, lambda x, y: part(x / n_a, y / n_b) + part(y / n_b, x / n_a))
    return F.when((n_a > 0) & (n_b > 0), F.sqrt(F.greatest(total(parts) / 2, F.lit(0.0)))).otherwise(F.lit(0.0))


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` and both distances."""
    rows = written(_histograms(measured(docs)))
    known_langs = written(references(rows))  # a line for each language; its size decides how it is joined
    met = rows.join(known_langs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    met = met.withColumn("character_distance", F.coalesce(distance(F.col("characters"), F.col("ref_characters")), F.lit(0.0)))
    known = F.coalesce(F.col("lang").isin(list(COMMON_WORDS)), F.lit(False))
    met = met.withColumn("word_distance", F.when(known, F.coalesce(distance(F.col("common"), F.col("ref_common")), F.lit(0.0))).otherwise(F.lit(0.0)))
    odd = ((F.col("n_words") >= CHARACTER_WORDS) & (F.col("character_distance") > CHARACTER_LIMIT)) | (
        (F.col("n_words") >= WORD_WORDS) & (F.col("word_distance") > WORD_LIMIT)
    )
    return met.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~odd).alias("kept"), "character_distance", "word_distance",
    )
