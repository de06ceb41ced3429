"""The similarity joins against brute force on short, random, edited and long strings."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabaudit.functions.similarity import lcs_length, ratio, row_set_similarity
from tabaudit.operators.fuzzy_join import check_threshold, length_bands, similar_pairs
from tabaudit.functions.subsequence import Strings, common_lengths, scores, scores_from
from tabaudit.operators import leaders as leading
from tabaudit.operators import tiles


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def strings(seed, n=110):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        size = rng.choice([1, 2, 3, 5, 8, 13, 21, 34, 55, 180, 260])
        text = "".join(rng.choice("abc de") for _ in range(size)).strip()
        out.add(text)
        for _ in range(rng.randrange(3)):
            edited = list(text)
            for _ in range(1 + len(edited) // 12):
                if edited and rng.random() < 0.5:
                    edited.pop(rng.randrange(len(edited)))
                else:
                    edited.insert(rng.randrange(len(edited) + 1), rng.choice("abcxyz"))
            out.add("".join(edited).strip())
    return sorted(out - {""})


def test_lcs_matches_plain_table():
    texts = strings(1, 40)
    for a in texts:
        for b in texts[:15]:
            assert lcs_length(a, b) == plain_lcs(a, b)


def test_golden_scores():
    assert ratio("data jateng padi", "2020 data jateng padi") == 86
    assert ratio("kabupaten_kta", "kabupaten_kota") == 96
    assert ratio("", "") == 100 and ratio("", "a") == 0
    assert row_set_similarity([], ["a"]) == 0.0


@pytest.mark.parametrize("threshold", [1, 50, 70, 80, 85, 92, 98, 100])
def test_self_join_finds_every_pair(spark, threshold):
    texts = strings(threshold)
    rows = [(i, 0, i % 2, text) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "sid long, side int, block int, text string")
    got = {(r.a_id, r.b_id, r.score) for r in similar_pairs(frame, threshold).collect()}
    want = {
        (i, j, ratio(a, b))
        for i, a in enumerate(texts)
        for j, b in enumerate(texts)
        if i < j and i % 2 == j % 2 and ratio(a, b) >= threshold
    }
    assert got == want


@pytest.mark.parametrize("threshold", [60, 85, 98])
def test_two_sided_join_finds_every_pair(spark, threshold):
    left, right = strings(7, 60), strings(7, 40) + strings(8, 40)
    right = sorted(set(right))
    rows = [(i, 0, 0, text) for i, text in enumerate(left)] + [(1000 + i, 1, 0, text) for i, text in enumerate(right)]
    frame = spark.createDataFrame(rows, "sid long, side int, block int, text string")
    got = {(r.a_text, r.b_text, r.score) for r in similar_pairs(frame, threshold, two_sided=True).collect()}
    assert got == {(a, b, ratio(a, b)) for a in left for b in right if ratio(a, b) >= threshold}


def test_best_match_is_the_first_best_with_small_tiles(spark, monkeypatch):
    for name, value in {"TILE": 8, "TILE_LENGTH": 30, "LANE": 5, "TRIES": 3, "NODE": 2, "LINES": 7}.items():
        monkeypatch.setattr(tiles, name, value)
    left, right = strings(3, 60) + ["#", ""], strings(4, 90)
    a = spark.createDataFrame([(text,) for text in left + left[:3]], "text string")
    b = spark.createDataFrame([(text, 1000 - i) for i, text in enumerate(right)], "text string, ord long")
    got = {r.text: (r.best_text, r.score) for r in tiles.best_matches(a, b).collect()}
    for text in left:
        best = max(range(len(right)), key=lambda i: (ratio(text, right[i]), i))
        score = ratio(text, right[best])
        assert got.get(text) == ((right[best], score) if score and text else None)
    assert tiles.best_matches(a, b.where("false")).collect() == [] == tiles.best_matches(a.where("false"), b).collect()


@pytest.mark.parametrize("threshold", [40, 85])
def test_pairs_in_small_tiles(spark, monkeypatch, threshold):
    monkeypatch.setattr(tiles, "TILE", 8)
    monkeypatch.setattr(tiles, "TILE_LENGTH", 30)
    monkeypatch.setattr(tiles, "PARCEL_PAIRS", 200)
    texts = strings(threshold, 150) + ["ä€😀 漢字 " * 3, "ä€😀 漢字 " * 3 + "x"]
    frame = spark.createDataFrame([(i, 0, i % 3, text) for i, text in enumerate(texts)], "sid long, side int, block int, text string")
    got = {(r.a_id, r.b_id, r.score) for r in similar_pairs(frame, threshold).collect()}
    assert got == {(i, j, ratio(a, b)) for i, a in enumerate(texts) for j, b in enumerate(texts) if i < j and i % 3 == j % 3 and ratio(a, b) >= threshold}


def test_batched_lengths_equal_single_ones():
    rng = random.Random(9)
    for most, letters in ((1, "ab"), (20, "ab"), (70, "abc ä€😀"), (300, "abcdefghij"), (1300, "abc")):
        left, right = (["".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(40)] for _ in range(2))
        pairs = np.array([(i, j) for i in range(40) for j in range(40) if rng.random() < 0.2])
        got = common_lengths(Strings(left), pairs[:, 0], Strings(right), pairs[:, 1])
        assert got.tolist() == [lcs_length(left[i], right[j]) for i, j in pairs]


def in_sequence(edges):
    led = {}
    for b in sorted({b for _, b in edges}):
        for a in sorted(a for a, x in edges if x == b):
            if a not in led:
                led[b] = a
                break
    return led


@pytest.mark.parametrize("most", [1 << 20, 30, 3])
def test_leaders_equal_the_sequential_answer(spark, monkeypatch, most):
    """All in one task; components in tasks of their own; large components in rounds."""
    monkeypatch.setattr(leading, "TASK_EDGES", most)
    rng = random.Random(most)
    edges = sorted({tuple(sorted((base + rng.randrange(12), base + rng.randrange(12)))) for base in range(0, 300, 12) for _ in range(rng.randrange(1, 9))})
    edges = [(a, b) for a, b in edges if a < b] + [(1000 + k, 1001 + k) for k in range(25)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    assert {r.member: r.leader for r in leading.leaders(frame).collect()} == in_sequence(edges)


def test_leaders_of_a_long_chain(spark):
    chain = spark.range(10_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = leading.leaders(chain)
    assert found.where("member <> leader + 1 OR leader % 2 <> 0").count() == 0 and found.count() == 5_000
    assert leading.leaders(chain.where("false")).collect() == []


def test_threshold_checks_and_bands():
    with pytest.raises(TypeError):
        check_threshold(85.0)
    with pytest.raises(ValueError):
        check_threshold(101)
    for threshold in (1, 50, 85, 98, 100):
        bands = length_bands(threshold)
        assert len(bands) < 100
        for low, high, piece, _ in bands[:20]:
            for size in (low, high):
                assert piece == 1 or size // piece >= size * (201 - 2 * threshold) // 100 + 1


def test_pieces_are_joined_without_a_broadcast(spark):
    strings = spark.createDataFrame([(i, 0, 0, f"a title of some length {i}") for i in range(20)], "sid long, side int, block int, text string")
    plan = similar_pairs(strings, 98)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan


def test_bounds_of_a_cell_do_not_depend_on_the_order_of_its_strings():
    long_, short = Strings(["abcdefghij" * 6, "abcdefgh"]), Strings(["abcdefghij" * 6, "abcdefghi"])
    backward = Strings(long_.texts[::-1]), Strings(short.texts[::-1])
    assert {(long_.texts[i], short.texts[j]) for i, j in zip(*tiles.near_pairs(long_, short, np.ones((2, 2), bool), 85))} == {
        (backward[0].texts[i], backward[1].texts[j]) for i, j in zip(*tiles.near_pairs(*backward, np.ones((2, 2), bool), 85))
    }


@pytest.mark.parametrize("threshold", [60, 75, 85, 95])
def test_heads_of_strings_lose_no_pair(threshold):
    rng = random.Random(threshold)
    base = ["".join(rng.choice("abcde") for _ in range(n)) for n in (1, 5, 62, 63, 64, 126, 127, 300, 520, 700)]
    texts = base + ["".join(c for c in text if rng.random() > 0.12) or "a" for text in base] + [text[len(text) // 4 :] for text in base]
    strings = Strings(texts)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    want = np.array([ratio(texts[i], texts[j]) for i, j in zip(a, b)])
    k, found = scores_from(threshold, strings, a, strings, b)
    assert (scores(strings, a, strings, b) == want).all()
    assert k.tolist() == np.flatnonzero(want >= threshold).tolist() and (found == want[k]).all()
