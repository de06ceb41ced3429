"""The pipeline stage by stage against brute force, on a small table and on odd rows."""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

import pytest

import corpus_pipeline
from tabaudit.llm import quality
from tabaudit.session import written

sys.path.insert(0, os.path.dirname(__file__))
from test_llm_operators import ODD, ODD_ROWS, brute_components, frame, words  # noqa: E402

BASE = "/root/testdata/sf0.001"


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.fixture(scope="module")
def outputs(spark):
    docs = [spark.read.parquet(f"{BASE}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], BASE)))
    return docs


def test_stages_and_their_columns(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources", "packing"]
    assert all(df.columns == outputs[0].columns for df in outputs[:-1])


def test_quality_keeps_what_it_accepts(spark, outputs):
    scores = {r.doc_id: r.predicted for r in quality.scored(outputs[0], spark.read.parquet(f"{BASE}/labels.parquet")).collect()}
    assert {r.doc_id for r in outputs[1].collect()} == {i for i, p in scores.items() if p == 1}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BASE}/labels.parquet").collect()}
    kept = {r.doc_id for r in outputs[1].select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) > 0.85 * len(good)  # from 42 positives in the training folds


def test_one_of_each_group_of_copies(outputs):
    best = {}
    for r in outputs[1].collect():
        key = squeezed(r.text)
        best[key] = min(best.get(key, (1, 0)), (-len(r.text), r.doc_id))
    assert {r.doc_id for r in outputs[2].collect()} == {i for _, i in best.values()}


def test_one_of_each_group_of_near_copies(outputs):
    rows = outputs[2].collect()
    want = {c for _, _, c in brute_components([r.text for r in rows], [r.doc_id for r in rows], 5, 80)}
    assert {r.doc_id for r in outputs[3].collect()} == want and len(want) < len(rows)


def test_mix_and_packing_keep_every_word_taken(outputs):
    before, mix = outputs[3].collect(), outputs[4].collect()
    times = Counter(r.doc_id for r in mix)
    assert max(times.values()) <= 2
    sizes = {r.doc_id: len(words(r.text)) for r in before}
    assert sum(n * sizes[i] for i, n in times.items()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.1)
    pieces = outputs[5].collect()
    tokens = Counter()
    for r in pieces:
        tokens[r.doc_id] += r.length
    assert sum(r.start == 0 for r in pieces) == len(mix)
    assert all(tokens[r.doc_id] == times[r.doc_id] * r.doc_tokens for r in pieces)


def test_run_is_the_stages_in_order(spark, outputs):
    ran = corpus_pipeline.run(spark, BASE)
    assert sorted((r.doc_id, r.start, r.length) for r in ran.collect()) == sorted((r.doc_id, r.start, r.length) for r in outputs[5].collect())


def test_odd_rows_pass_through_all_stages(spark):
    docs = frame(spark, ODD, **ODD_ROWS)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, BASE))
        docs.count()
    empty = frame(spark, ODD, **ODD_ROWS).where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = written(stage(spark, empty, BASE))
    assert empty.count() == 0
