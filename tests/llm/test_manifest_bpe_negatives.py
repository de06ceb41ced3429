"""Merkle manifest, BPE and hard negatives against brute force, and on odd rows; megabytes of one thing in several operators."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabaudit.llm import bpe, hard_negatives, language_id, merkle, packing, pii

FIELDS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, proof int, node string"
JSON = public_tokenizers.path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- manifest --------------------------------------------------------------------------------------------------------


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def tree(nodes, fanout):
    """The levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + fanout])) for k in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, at, fanout):
    out = []
    for nodes in levels[:-1]:
        run, own = nodes[at // fanout * fanout :][:fanout], at % fanout
        out.append(("".join(run[:own]), "".join(run[own + 1 :])))
        at //= fanout
    return out


def brute_manifest(rows, fanout):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row), row[0]))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])], fanout) for s in names]
    top = tree([t[-1][0] for t in trees], fanout)
    out = []
    for number, (name, levels) in enumerate(zip(names, trees)):
        for at, (_, _, leaf, doc_id) in enumerate(sorted(by_source[name], key=lambda x: x[:3])):
            out.append((doc_id, name, leaf, levels[-1][0], top[-1][0], tuple(path(levels, at, fanout) + path(top, number, fanout))))
    return out


def found_manifest(df):
    return [(r["doc_id"], r["source"], r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["proof"])) for r in df.collect()]


def manifest_rows(counts):
    rows = [(k, source, "en", None, f"text {k} ä\n", "x", 1, "y") for source, n in counts.items() for k in range(n)]
    return rows + [(None, "s0", None, None, None, None, None, None), (3, "s0", "en", 7, "again", None, None, None)] + rows[:1]


@pytest.mark.parametrize("fanout, height", [(2, 1), (3, 1), (2, 3), (16, 3)])
def test_manifest_equals_a_tree_built_in_one_place(spark, fanout, height):
    rows = manifest_rows({"s0": 23, "s1": 1, None: 2, "": 9, "é": 4, "z": 16})
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    got, want = found_manifest(merkle.manifest(docs, fanout, height)), brute_manifest(rows, fanout)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_proofs_tell_tampered_rows(spark):
    docs = spark.createDataFrame(manifest_rows({"a": 40, "b": 3}), FIELDS)
    changed = F.when(F.col("doc_id") == 5, F.sha2(F.lit("other"), 256))
    proven = merkle.proven(merkle.leaves(docs, other=changed), 3, 1)
    proven = proven.select("doc_id", "source", "root", "proof", merkle.folded(F.coalesce("other", "leaf"), F.col("proof")).alias("folded"))
    assert {(r["doc_id"], r["source"]) for r in proven.where("folded <> root").collect()} == {(5, "a")}
    for row in proven.limit(3).collect():
        assert sha("".join(s["left"] + s["right"] for s in row["proof"])) == proven.where((F.col("doc_id") == row["doc_id"]) & (F.col("source") == row["source"])).select(F.sha2(merkle.siblings(F.col("proof")), 256)).first()[0]


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(1, "a", "en", 2, "x" * 3_000_000, None, None, None)], FIELDS)
    (row,) = merkle.manifest(one).collect()
    assert row["root"] == row["leaf"] == leaf_of((1, "a", "en", 2, "x" * 3_000_000)) and row["proof"] == []
    assert merkle.manifest(one.where("false")).collect() == []
    with pytest.raises(ValueError):
        merkle.manifest(one, fanout=1)


# --- BPE -------------------------------------------------------------------------------------------------------------

TEXTS = [
    None, "", " ", "\n\n", "Hello world's  end\t<|endoftext|><|endoftext|> it's <|endof", "ä ß € 😀 é́ 漢字 ՘ ꟎ \U0001d6a6 ՙ", "a b c　d", "\x00\x01\x7f\u0080",
    "1234 5678 ١٢٣ ½ ²", "x" * 300_000, " " * 300_000, "\n" * 300_000, "ab" * 100_000, "the the " * 50_000, "don't DON'T 'tis '' 's",
]


def test_ids_and_texts_equal_the_tokenizers_library(spark):
    library = Tokenizer.from_file(JSON)
    docs = spark.createDataFrame([(k if k else None, t, "x", [1]) for k, t in enumerate(TEXTS)] + [(2, " ", "x", [1])], "doc_id long, text string, ids string, merges array<int>")
    got = bpe.decoded(bpe.encoded(docs)).collect()
    assert len(got) == len(TEXTS) + 1
    for row in got:
        text = TEXTS[row["doc_id"] or 0] or ""
        assert row["ids"] == library.encode(text, add_special_tokens=False).ids
        assert row["text"] == library.decode(row["ids"], skip_special_tokens=False) == text
    assert bpe.decoded(bpe.encoded(docs.where("false"))).collect() == []


def test_any_ids_decode_as_the_library_does(spark):
    library, random = Tokenizer.from_file(JSON), np.random.default_rng(3)
    lists = [[int(i) for i in random.integers(0, 50257, n)] for n in (0, 1, 5, 200)] + [[50256, 50256], [188, 220, 188]]
    tokens = spark.createDataFrame([(k, ids) for k, ids in enumerate(lists)] + [(-1, None)], "doc_id long, ids array<int>")
    for row in bpe.decoded(tokens).collect():
        assert row["text"] == ("" if row["doc_id"] < 0 else library.decode(lists[row["doc_id"]], skip_special_tokens=False))


def test_settled_characters_split_as_in_the_library():
    vocabulary, splitter = bpe.Vocabulary(JSON), Tokenizer.from_file(JSON).pre_tokenizer
    for first, last in bpe.SETTLED:
        text = "".join(f"x{chr(c)}1{chr(c)}. " for c in range(first, last + 1))
        assert vocabulary.words.findall(text) == [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)]


def test_megabytes_of_one_character():
    vocabulary, library = bpe.Vocabulary(JSON), Tokenizer.from_file(JSON)
    for text in (" " * 2_000_000, "a" * 2_000_000):
        assert vocabulary.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


# --- hard negatives --------------------------------------------------------------------------------------------------


def brute_negatives(rows, positives, negatives, low, high):
    """``rows`` of (vec_id, label, vector, anchor); an order among equal rows doesn't change the result."""
    width = max([len(r[2]) for r in rows], default=0)
    table = np.array([list(r[2]) + [0] * (width - len(r[2])) for r in rows], np.int64).reshape(len(rows), width)
    out = []
    for a, (anchor, label, _, is_anchor) in enumerate(rows):
        if not is_anchor:
            continue
        scores = [int(s) for s in table @ table[a]]
        order = sorted((k for k in range(len(rows)) if k != a), key=lambda k: (-scores[k], rows[k][0] is None, rows[k][0] or 0))
        for p in [k for k in order if rows[k][1] == label][:positives]:
            fits = [k for k in order if rows[k][1] != label and low * scores[p] <= 100 * scores[k] <= high * scores[p]]
            out += [(anchor, rows[p][0], rank, rows[k][0], scores[p], scores[k]) for rank, k in enumerate(fits[:negatives], 1)]
    return out


def found_negatives(df):
    return sorted([tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()], key=repr)


SCHEMA = "vec_id long, label int, vector array<long>, anchor boolean, score int, numbers string"


def vectors(seed, n, size, most):
    random = np.random.default_rng(seed)
    middles = random.normal(size=(6, size))
    return [(k, int(random.integers(0, 4)), [int(x) for x in np.floor(most * (middles[random.integers(0, 6)] + random.normal(size=size)))], k % 10 == 0, 1, "x") for k in range(n)]


@pytest.mark.parametrize("size, most", [(64, 40), (10, 3), (3, 1)])
def test_negatives_equal_brute_force(spark, monkeypatch, size, most):
    for name, value in {"FIRST_ROWS": 40, "TILE_ANCHORS": 7, "TILE_ROWS": 33, "HELD_PAIRS": 50}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(size, 400, size, most)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = found_negatives(hard_negatives.mined(df, F.col("anchor"), positives=3, negatives=4, block=17))
    want = sorted([x for x in brute_negatives([r[:4] for r in rows], 3, 4, 30, 90)], key=repr)
    assert got == want and want


def test_negatives_of_odd_rows(spark):
    rows = [(0, 1, [5, 1], True), (1, 1, [5, 1, 0, 7], False), (1, 1, [5, 1, 0, 7], False), (None, 1, [4], False), (2, 2, [3], False), (2, 2, [3], False), (None, 2, [3, 0], False), (3, 2, [], True), (4, 3, [-5, 2], True), (-7, 3, [-4], False), (5, 4, [0, 0, 0], False)]
    odd = [(6, None, [1], True), (7, 1, None, True)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], SCHEMA)
    assert found_negatives(hard_negatives.mined(df, F.col("anchor"))) == sorted(brute_negatives(rows, 5, 10, 30, 90), key=repr)
    assert hard_negatives.mined(df.where("false"), F.col("anchor")).collect() == []


def test_finite_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [math.nan]), (4, [math.inf]), (5, [-math.inf]), (6, [])]
    df = spark.createDataFrame(rows, "k int, v array<float>")
    assert [r["k"] for r in df.where(hard_negatives.finite("v")).orderBy("k").collect()] == [0, 6]


def test_bounds_hold():
    random = np.random.default_rng(5)
    numbers = np.floor(random.normal(size=(300, 64)) * 50).astype(np.int32)
    parts = np.split(hard_negatives.summaries(numbers), np.cumsum(hard_negatives.LEVELS * 2)[:-1], axis=1)
    exact, half = numbers.astype(np.int64) @ numbers.T.astype(np.int64), len(hard_negatives.LEVELS)
    widths = []
    for mean, deviation in zip(parts[:half], parts[half:]):
        middle, spread = mean @ mean.T, deviation @ deviation.T
        assert (np.abs(exact - middle) <= spread + 1e-6).all()
        widths.append(spread.mean())
    assert widths == sorted(widths, reverse=True)


# --- megabytes of one thing ------------------------------------------------------------------------------------------


def test_packing_takes_megabytes_of_white_space():
    encoder, library = packing.Encoder(JSON, public_tokenizers.path("byte_bpe_50k.tiktoken")), Tokenizer.from_file(JSON)
    for text in (" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000):
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_personal_data_in_megabytes_of_addresses(spark):
    text = " ".join(f"n{k}.x@host{k % 97}.org Ä{k} {k % 256}.1.2.{k % 200}" for k in range(40_000))
    (row,) = pii.base_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(row["email"]) == len(row["ip"]) == 40_000
    for kind, at in (("email", 39_999), ("ip", 1_234)):
        span = row[kind][at]
        assert text[span["at"] : span["at"] + len(span["value"])] == span["value"]
    assert row["clear"].count(" ") == text.count(" ") and len(row["clear"]) == len(text) and "@" in row["clear"] and "host" not in row["clear"]


def test_visible_text_of_pages_that_close_nothing(spark):
    pages = ["a <b>b</b> <script>x<y</script> c <!-- d --> e", "a <!-- b" + "<!-- c" * 200_000, "a " + "<script>b" * 200_000, "a " + "<" * 1_000_000, "a <style>b</style> c<style>d"]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, html string")
    got = {r["k"]: r["t"].split() for r in df.select("k", language_id.visible_text(F.col("html")).alias("t")).collect()}
    assert got == {0: ["a", "b", "c", "e"], 1: ["a"], 2: ["a"], 3: ["a"], 4: ["a", "c"]}
