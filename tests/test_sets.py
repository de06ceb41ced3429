"""Pairs of similar samples against brute force, with common rows, repeated rows and small slabs."""

import random

import pytest

from tabaudit.functions.similarity import row_set_similarity
from tabaudit.operators import catalog, sets


def samples(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([5, 30, 60, 90]))).strip() or "a" for _ in range(12)]
    out = []
    for group in (1, 2):
        for k in range(25):
            rows = [rng.choice(base) for _ in range(rng.randint(1, 5))]
            rows = [row + rng.choice("xyz") if rng.random() < 0.3 else row for row in rows] + (["teks=same for all of a group"] if k % 2 else [])
            out.append((group, f"{group}-{k}", group * 100 + k, sorted(rows)))
    return out


@pytest.mark.parametrize("threshold, small", [(80, True), (98, False), (100, True)])
def test_class_pairs_equal_brute_force(spark, monkeypatch, threshold, small):
    if small:
        for name, value in {"SETS": 4, "MATCHES": 9, "BOUNDED": 2}.items():
            monkeypatch.setattr(sets, name, value)
    rows = samples(threshold)
    frame = spark.createDataFrame(rows, "group_ord long, dataset_id string, ord long, prints array<string>").repartition(3)
    got = {(r.group_ord, r.a_class, r.b_class): r.similarity for r in catalog.class_pairs(frame, threshold).collect()}
    first = {}
    for group, _, ord_, prints in rows:
        first.setdefault((group, tuple(prints)), ord_)
    want = {}
    for (group, a), a_ord in first.items():
        for (other, b), b_ord in first.items():
            similarity = row_set_similarity(a, b)
            if group == other and a_ord < b_ord and similarity >= threshold:
                want[group, a_ord, b_ord] = similarity
    assert got == pytest.approx(want) and (want or threshold == 100)


def test_rows_of_samples_are_not_spread_by_letter(spark):
    """The join of a sample's rows made a line for each letter of a row."""
    texts = [f"row {k} of a table that has the same long beginning" for k in range(8)]
    rows = [(1, str(k), k, sorted([texts[k], texts[(k + 1) % 8], "another row, number %d" % k, "one", "two %d" % (k // 4)])) for k in range(8)]
    found = catalog.class_pairs(spark.createDataFrame(rows, "group_ord long, dataset_id string, ord long, prints array<string>"), 98)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan
