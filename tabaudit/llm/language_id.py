"""Language identification of web pages by Bayesian fusion of four kinds of evidence.

* text: a naive Bayes likelihood over hashed character trigrams, counted over all documents with a known language;
* declared markup language: how likely each language declares it, counted softly over all pages;
* address suffix and host: priors smoothed hierarchically, host towards suffix, suffix towards the whole, from the soft
  counts of all pages; a page's own share is taken out of its host's counts before it is used.

Counts are grouped aggregates; a page joins the line of its host, its suffix and its declaration. Only a trigram table
(a fixed number of buckets by ``LANGUAGES_AT_ONCE`` languages) and the language list go to every task. Every language that
occurs is a candidate; where there are more of them than one table takes, the pages are read block by block.

Null or empty pages have no text evidence and are decided by the rest. A page without an address has the null host and
suffix, one without declaration the null declaration; each is a value like others. Repeated pages are judged alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.llm.common import require, row_slices, text_buffers, text_of
from tabaudit.session import written

BUCKETS = 1 << 15
#: Languages whose trigram counts a task holds at the same time. It bounds memory, not the candidates.
LANGUAGES_AT_ONCE = 128
#: Neighbouring trigrams overlap, so their evidence is weighed down.
TEMPER = 1 / 3
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 5.0, 20.0, 1.0


def trigram_buckets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each slice of texts: the text number of every trigram of letters and its bucket."""
    fold = np.arange(256, dtype=np.int64)
    fold[65:91] += 32
    fold[[9, 10, 11, 12, 13]] = 32
    fold[48:58] = 32
    data, at = text_buffers(column)
    for a, b in row_slices(at):
        part, home = fold[data[at[a] : at[b]]], np.repeat(np.arange(b - a), np.diff(at[a : b + 1]))
        if len(part) < 3:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64), b - a
            continue
        value = (part[:-2] << 16) + (part[1:-1] << 8) + part[2:]
        inside = home[:-2] == home[2:]
        yield home[:-2][inside], ((value * 2654435761 >> 13) % BUCKETS)[inside], b - a


def text_model(docs: DataFrame) -> tuple[list[str], DataFrame, np.ndarray]:
    """All languages, a table ``lang, counts`` of their trigram counts by bucket, and the languages' shares."""
    docs = docs.select(F.col("lang").cast("string").alias("lang"), text_of().alias("text")).where("lang IS NOT NULL")
    known = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()  # a line for each language
    most = LANGUAGES_AT_ONCE

    def lines(table: dict[str, np.ndarray]) -> pa.RecordBatch:
        bodies = [zlib.compress(line.tobytes(), 1) for line in table.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), pa.array(bodies, pa.binary())], ["lang", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, np.ndarray] = {}
        for batch in batches:
            owner, row = batch.column("lang").dictionary_encode(), 0
            names, place = owner.dictionary.to_pylist(), owner.indices.to_numpy()
            for home, bucket, n in trigram_buckets(batch.column("text")):
                lang = place[row : row + n][home]
                order = np.argsort(lang, kind="stable")
                present, first = np.unique(lang[order], return_index=True)
                for k, part in zip(present, np.split(bucket[order], first[1:])):
                    if names[k] not in table and len(table) >= most:
                        yield lines(table)
                        table = {}
                    table[names[k]] = table.get(names[k], 0) + np.bincount(part, minlength=BUCKETS)
                row += n
        yield lines(table)

    def added(group: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(BUCKETS, np.int64)
        for body in group["counts"]:
            out += np.frombuffer(zlib.decompress(body), np.int64)
        return pd.DataFrame({"lang": group["lang"].iloc[:1].to_numpy(), "counts": [zlib.compress(out.tobytes(), 1)]})

    parts = docs.mapInArrow(count, "lang string, counts binary")
    lanes = parts.withColumn("lane", F.pmod(F.xxhash64("counts"), F.lit(32))).groupBy("lang", "lane").applyInPandas(lambda g: added(g[["lang", "counts"]]), "lang string, counts binary")
    counts = written(lanes.groupBy("lang").applyInPandas(added, "lang string, counts binary"))
    prior = np.array([row["n"] for row in known], float)
    return [row["lang"] for row in known], counts, prior / max(prior.sum(), 1)


def trigram_logs(counts: DataFrame, langs: list[str]) -> np.ndarray:
    """Log probability of each bucket by language. Languages without any trigram have no line."""
    rows = {row["lang"]: np.frombuffer(zlib.decompress(row["counts"]), np.int64) for row in counts.where(F.col("lang").isin(langs)).collect()}
    table = np.stack([rows.get(lang, np.zeros(BUCKETS, np.int64)) for lang in langs]).astype(float) + 0.5
    return np.log(table / table.sum(axis=1, keepdims=True))


def visible_text(html: Column) -> Column:
    """A page's text without markup, scripts and styles. What is opened and never closed runs to the end of the page."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\z)", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?(?:-->|\z)", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*+(?:>|\z)", " "), r"&[A-Za-z0-9#]{1,10};", " ")


def _read(pages: DataFrame) -> DataFrame:
    rows = require(pages, "page_id", "url", "html")
    declared = F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1))
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return rows.select(
        "page_id", F.when(declared != "", declared).alias("declared"), F.when(host != "", host).alias("host"),
        F.when(host.contains("."), F.substring_index(host, ".", -1)).alias("suffix"), visible_text(F.col("html")).alias("text"),
    )


def _soft(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def identified(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """``page_id, lang, confidence, text_lang, declared, host, suffix``, one row for each row of ``pages``."""
    langs, counts, prior = text_model(require(docs, "text", "lang"))
    n = len(langs)
    if not n:
        none = [F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_lang")]
        return _read(pages).select("page_id", *none, "declared", "host", "suffix")
    names = ["page_id", "declared", "host", "suffix"]

    def likely(model: Broadcast, kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Adds the languages of a model to ``text_log``, which has those of the models before it."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            width = model.value.shape[1]
            for batch in batches:
                parts = [np.zeros((0, width))]
                for home, bucket, rows in trigram_buckets(batch.column("text")):
                    parts.append(np.stack([np.bincount(home, weights=model.value[bucket, k], minlength=rows) for k in range(width)], axis=1))
                new = (np.concatenate(parts) * TEMPER).tolist()
                old = batch.column("text_log").to_pylist() if "text_log" in batch.schema.names else [[]] * len(new)
                lines = pa.array([a + b for a, b in zip(old, new)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lines], [*kept, "text_log"])

        return run

    rows = _read(pages)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    for at in range(0, n, LANGUAGES_AT_ONCE):
        last = at + LANGUAGES_AT_ONCE >= n
        kept = names if last else [*names, "text"]
        model = docs.sparkSession.sparkContext.broadcast(trigram_logs(counts, langs[at : at + LANGUAGES_AT_ONCE]).T.copy())
        rows = rows.mapInArrow(likely(model, kept), ", ".join([*[f"{c} {kinds[c]}" for c in kept], "text_log array<double>"]))
        if not last:  # so that no task holds two models
            rows = written(rows)
            model.unpersist()

    @F.pandas_udf("array<double>")
    def soft(text_log: pd.Series) -> pd.Series:
        return pd.Series(list(_soft(np.stack(text_log.to_numpy()) + np.log(prior))))

    rows = written(rows.withColumn("soft", soft("text_log")))

    def counted(by: str) -> DataFrame:
        sums = rows.groupBy(by).agg(*[F.sum(F.round(F.col("soft")[k] * 1e9).cast("long")).alias(f"s{k}") for k in range(n)])  # whole numbers: any order of addition agrees
        return sums.select(F.col(by).alias(f"{by}_key"), F.array(*[F.col(f"s{k}") / 1e9 for k in range(n)]).alias(f"{by}_counts"))

    met = rows
    for by in ("host", "suffix", "declared"):
        met = met.join(counted(by), F.col(by).eqNullSafe(F.col(f"{by}_key")), "left").drop(f"{by}_key")
    whole = [row / 1e9 for row in rows.agg(*[F.coalesce(F.sum(F.round(F.col("soft")[k] * 1e9).cast("long")), F.lit(0)) for k in range(n)]).first()]

    @F.pandas_udf("array<double>")
    def fused(text_log: pd.Series, own: pd.Series, host: pd.Series, suffix: pd.Series, declared: pd.Series) -> pd.Series:
        text_log, own, host, suffix, declared = (np.stack(x.to_numpy()) for x in (text_log, own, host, suffix, declared))
        everywhere = np.maximum(np.array(whole), 0) + 1.0
        top = everywhere / everywhere.sum()
        suffix, host, declared = (np.maximum(x - own, 0) for x in (suffix, host, declared))
        middle = (suffix + SUFFIX_WEIGHT * top) / (suffix.sum(1, keepdims=True) + SUFFIX_WEIGHT)
        place = (host + HOST_WEIGHT * middle) / (host.sum(1, keepdims=True) + HOST_WEIGHT)
        said = (declared + DECLARED_WEIGHT * declared.sum(1, keepdims=True) / np.sum(whole) + 1e-3) / everywhere
        return pd.Series(list(_soft(text_log + np.log(place) + np.log(said))))

    chances = met.withColumn("chances", fused("text_log", "soft", "host_counts", "suffix_counts", "declared_counts"))
    name = F.array(*[F.lit(lang) for lang in langs])

    def best(column: str) -> Column:
        return F.element_at(name, F.array_position(column, F.array_max(column)).cast("int"))

    return chances.select("page_id", best("chances").alias("lang"), F.array_max("chances").alias("confidence"), best("soft").alias("text_lang"), "declared", "host", "suffix")
