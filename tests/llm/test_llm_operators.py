"""The operators against brute force, and on nulls, empty texts, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabaudit.llm import exact_dedup, language_id, mixing, ngram_join, packing, pii, quality, quality_rules, sharding, token_counts
from tabaudit.llm.components import components
from tabaudit.llm.signature_tree import Groups, dual_links, dual_pairs

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
        StructField("source", StringType()), StructField("n_chars", LongType()),
        StructField("size", LongType()), StructField("kept", StringType()), StructField("digest", StringType()), StructField("shard", StringType()),
    ]
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def rows_of(texts, **more):
    out = []
    for k, text in enumerate(texts):
        row = {"doc_id": k, "text": text, "lang": "en", "source": f"s{k % 3}", "n_chars": len(text or ""), "size": -1, "kept": "x", "digest": "y", "shard": "z"}
        row |= {name: values[k] for name, values in more.items()}
        out.append(tuple(row[f.name] for f in DOCUMENTS.fields))
    return out


def frame(spark, texts, **more):
    return spark.createDataFrame(rows_of(texts, **more), DOCUMENTS).repartition(3)


def prose(seed, n, vocabulary=400):
    random = np.random.default_rng(seed)
    return [f"w{k}" for k in random.integers(0, vocabulary, n)]


ODD = [None, "", " \t\n", "one", "one", "two words", "ONE", "x" * 50_000, "a b c d e", "a b c d e", "ä ß € 😀 é", "1.1.1.1 " * 3000]
ODD_ROWS = dict(doc_id=[None, 1, 2, 3, 3, None, 6, 7, 8, 9, 10, 11], source=[None, "b", None, "", "", "b", "a", "a", "a", "c", "c", "d"], lang=[None, "en", "xx", "de", "de", "fr", "es", "en", "en", "en", None, "en"])


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD, **ODD_ROWS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


# --- exact dedup -----------------------------------------------------------------------------------------------------


def test_filter_has_no_false_negatives_and_few_false_positives():
    random = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 1000, 20_000):
        keys = np.unique(random.integers(0, 1 << 63, n).astype(np.uint64))
        body = exact_dedup.build_filter(keys)
        assert exact_dedup.probe_filter(body, keys).all()
        other = random.integers(0, 1 << 63, 20_000).astype(np.uint64)
        assert exact_dedup.probe_filter(body, other[~np.isin(other, keys)]).mean() < 0.01


def brute_copies(texts, ids):
    groups = {}
    for k, text in enumerate(texts):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), ids[k] is None, ids[k] or 0, ids[k]))
    return {body: (min(v)[3], len(v)) for body, v in groups.items()}


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda norm: F.unhex(F.substring(F.sha2(norm, 256), 1, 1))])
def test_exact_groups(spark, digest):
    texts = [" ".join(prose(k % 40, 5)) + " " * (k % 4) for k in range(120)] + ODD
    ids = list(range(120)) + ODD_ROWS["doc_id"]
    docs = frame(spark, texts, doc_id=ids, source=[None] * len(texts), lang=[None] * len(texts))
    found = exact_dedup.exact_groups(docs, F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0, digest).collect()
    want = brute_copies(texts, ids)
    expected = Counter((i, *want[re.sub(r"[\x20\x09-\x0D]", "", t or "")]) for i, t in zip(ids, texts))
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == expected
    assert sum(r.kept for r in found) == len(want)


def test_copies_leave_one_row_each(spark, odd, nothing):
    left = exact_dedup.without_copies(odd, F.col("doc_id") % 2 == 0)
    assert left.columns == odd.columns
    assert Counter(re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in left.collect()) == Counter({re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in ODD})
    assert exact_dedup.without_copies(nothing, F.lit(True)).count() == 0


# --- n-gram join -----------------------------------------------------------------------------------------------------


def shingle_set(text, width):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_components(texts, ids, width, percent):
    sets, up = [shingle_set(t, width) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[find(i)] = find(j)
    known = {}
    for k in range(len(texts)):
        if ids[k] is not None and sets[k]:
            known[find(k)] = min(known.get(find(k), ids[k]), ids[k])
    return [(ids[k], len(sets[k]), known.get(find(k)) if sets[k] else ids[k]) for k in range(len(texts))]


def near_copies(seed, n_groups, per_group, length, edits):
    random, out = np.random.default_rng(seed), []
    for g in range(n_groups):
        base = prose(1000 + g, length, 5000)
        for _ in range(per_group):
            copy = list(base)
            for at in random.integers(0, length, int(random.integers(0, edits + 1))):
                copy[at] = f"new{random.integers(0, 10**6)}"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, monkeypatch, width, percent):
    passage = prose(77, 60)
    texts = near_copies(3, 12, 9, 120, 5) + [" ".join(passage + prose(500 + k, 40, 9000)) for k in range(60)] + [" ".join(prose(600 + k, 5, 4)) for k in range(40)] + ODD
    ids = list(range(500, 500 + len(texts) - len(ODD))) + ODD_ROWS["doc_id"]
    more = dict(doc_id=ids, source=[None] * len(texts), lang=[None] * len(texts))
    want = Counter(brute_components(texts, ids, width, percent))
    assert len({c for _, _, c in want}) < len(texts) - 40
    docs = frame(spark, texts, **more)
    got = ngram_join.linked_components(docs, width, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 4)  # now cells have many blocks, and links cross them
    got = ngram_join.linked_components(docs, width, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_one_of_each(odd, nothing):
    left = ngram_join.one_of_each(odd)
    assert left.columns == odd.columns
    assert {r.doc_id for r in left.collect()} == {None, 1, 2, 3, 7, 8, 10, 11}
    assert ngram_join.one_of_each(nothing).count() == 0


def test_dual_traversal_finds_every_link():
    random = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = np.unique(random.integers(0, 1 << 62, int(random.integers(1, 300))).astype(np.uint64))
        sets += [base[random.random(len(base)) > 0.06] for _ in range(3)]
    sets = sorted((s for s in sets if len(s)), key=len)
    pairs = dual_pairs(ngram_join._set_tree(sets), None, 80)
    links = dual_links(pairs, sets, sets, Groups(np.arange(len(sets))), 0, 80)
    groups, brute = Groups(np.arange(len(sets))), Groups(np.arange(len(sets)))
    for i, j in links:
        groups.join(i, j)
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                brute.join(i, j)
    assert [groups.find(k) for k in range(len(sets))] == [brute.find(k) for k in range(len(sets))]
    assert len(pairs) < len(sets) ** 2 / 8
    half = len(sets) // 2
    across = dual_pairs(ngram_join._set_tree(sets[:half]), ngram_join._set_tree(sets[half:]), 80)
    assert {(i, j + half) for i, j in across.tolist()} == {(i, j) for i, j in pairs.tolist() if i < half <= j}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101)], "a long, b long")
    found = dict(tuple(r) for r in components(links).collect())
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


# --- mixing ----------------------------------------------------------------------------------------------------------


def test_targets_are_filled_by_weight(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 1000), ("d", 10), (None, 500)]
    sources = spark.createDataFrame(sizes, "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sources, 1.5, 2, mixing.repeating([3, 1, 2])).collect()}
    weight, cap = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1])), {s: 2.0 * n for s, n in sizes}
    level = next(x for x in np.arange(0, 5000, 0.001) if sum(min(weight[s] * x, cap[s]) for s in cap) >= 1.5 * 2610)
    assert got == pytest.approx({s: min(weight[s] * level, cap[s]) for s in cap}, rel=1e-3)
    assert sum(got.values()) == pytest.approx(1.5 * 2610)


def test_pivot_keeps_words_and_chances():
    mass = np.sort(np.random.default_rng(2).integers(1, 200, 300).astype(float))[::-1]
    chance = np.full(300, 0.3)
    taken = np.array([mixing.pivot(mass, chance, np.random.default_rng(k), True) for k in range(300)])
    assert np.isin(taken, (0.0, 1.0)).all()
    assert np.abs(taken @ mass - mass @ chance).max() <= mass.max()
    assert np.abs(taken.mean(axis=0) - 0.3).max() < 0.15
    assert np.isclose(mixing.pivot(mass, chance, np.random.default_rng(1), False) @ mass, mass @ chance)


def test_mix_comes_near_its_targets(spark, monkeypatch):
    texts = [" ".join(prose(k, 3 + k % 50)) for k in range(600)] + [None, ""]
    source = ["hot" if k % 3 else f"s{k % 5}" for k in range(600)] + [None, "hot"]
    docs = frame(spark, texts, source=source, lang=[None] * 602)
    monkeypatch.setattr(mixing, "GROUP", 16)  # a reduction tree of several levels
    got = mixing.copies(docs, 1.5, 2, mixing.repeating([3, 1, 2])).collect()
    assert sorted(r.doc_id for r in got) == list(range(602)) and all(0 <= r.copies <= 2 for r in got)
    for name in set(source):
        own = [r for r in got if r.source == name]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 60
    again = mixing.copies(docs.repartition(7), 1.5, 2, mixing.repeating([3, 1, 2])).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_mixture_of_odd_rows(odd, nothing):
    mix = mixing.mixture(odd, 1.5)
    assert mix.columns == odd.columns
    times = Counter((r.doc_id, r.text) for r in mix.collect())
    taken = Counter()
    for r in mixing.copies(odd, 1.5).collect():
        taken[(r.doc_id, r.size)] += r.copies
    assert all(taken[(i, len(words(t)))] >= n for (i, t), n in times.items())
    assert mixing.mixture(nothing).count() == 0 and mixing.copies(nothing).count() == 0


# --- packing ---------------------------------------------------------------------------------------------------------


def check_sequences(sequences, lengths, capacity):
    seen = [np.zeros(n, int) for n in lengths]
    for sequence in sequences:
        total = sum(size for _, _, size in sequence)
        assert total == capacity or total & (total - 1) == 0
        for row, start, size in sequence:
            seen[row][start : start + size] += 1
    assert all((x == 1).all() for x in seen)


def test_packed_covers_every_token_once_without_padding():
    random = np.random.default_rng(4)
    for n, top, capacity in ((0, 1, 16), (1, 5, 16), (50, 40, 16), (300, 3000, 2048), (40, 9, 1024)):
        lengths = random.integers(1, top + 1, n)
        check_sequences(packing.packed(lengths, capacity), lengths, capacity)


def test_tournament_is_first_fit():
    random = np.random.default_rng(6)
    tree, bins = packing.Tournament(200, 100), []
    for size in random.integers(1, 101, 200).tolist():
        first = next((k for k, room in enumerate(bins) if room >= size), len(bins))
        if first == len(bins):
            bins.append(100)
        bins[first] -= size
        assert tree.place(size) == first


def test_ids_equal_the_tokenizers_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    json_path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, own = packing.Encoder(json_path, public_tokenizers.path("byte_bpe_50k.tiktoken")), Tokenizer.from_file(json_path)
    own.encode_special_tokens = True
    random = np.random.default_rng(8)
    letters = "abE  \t\n\r'sdll.,!9é   ßŁ½²ǅ"
    texts = [t or "" for t in ODD[:7]] + ["<|endoftext|> x", "Привет мир", "日本語 text", "a" * 3000] + ["".join(random.choice(list(letters), 60)) for _ in range(300)]
    for text in texts:
        assert encoder.ids(text).tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_pieces_join_to_the_documents(odd, nothing):
    pieces = packing.pack(odd).collect()
    assert sum(r.start == 0 for r in pieces) == len(ODD)
    assert all(zlib.crc32(np.frombuffer(r.ids, np.uint16).astype("<u4").tobytes()) == r.ids_crc32 and len(r.ids) == 2 * r.length for r in pieces)
    fill = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in fill.values())
    assert packing.pack(nothing).count() == 0


# --- quality classifier ----------------------------------------------------------------------------------------------


def test_classifier_on_held_out_documents(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    found = quality.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    good, bad = [r.score for r in found if r.quality == 1], [r.score for r in found if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.5 for s in good]) > 0.95


def brute_prior(positive, unlabelled):
    """The smallest upper bound of the ratio of shares above any score, score by score."""
    found = []
    for cut in sorted(set(positive)):
        share, whole = np.mean(np.array(positive) >= cut), np.mean(np.array(unlabelled) >= cut)
        noise = sum(math.sqrt(-math.log(quality.PRIOR_FAILS) / 2 / len(part)) for part in (positive, unlabelled))
        found.append((whole + noise) / share)
    return min(max(min(found), 0.01), 0.99)


@pytest.mark.parametrize("share,n", [(0.2, 20000), (0.6, 20000), (0.9, 20000), (0.6, 300)])
def test_prior_needs_no_poor_labels(share, n):
    draw = np.random.default_rng(7)
    good = draw.random(n) < share
    score = np.where(good, draw.integers(30, 100, n), draw.integers(0, 50, n))
    positive = score[good][: n // 10]
    counts = [np.bincount(s, minlength=100) for s in (positive, score)]
    found = quality.prior_from_counts(*counts)
    assert found == pytest.approx(brute_prior(positive, score))
    assert share - 0.02 < found < share + (0.1 if n > 1000 else 0.4)
    assert quality.prior_from_counts(np.zeros(100, int), counts[1]) == 0.5


def test_poor_labels_are_never_read(spark):
    base = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    scores = [{r.doc_id: r.score for r in quality.scored(docs, l).collect()} for l in (labels, labels.where("quality = 1"))]
    assert scores[0] == pytest.approx(scores[1])


def brute_risk(x, positive, w, prior):
    """The risk as it is defined, example by example, without the ridge."""
    loss = [np.log1p(np.exp(-abs(g))) + max(g, 0) for g in x @ w]
    return -prior * np.mean((x @ w)[positive]) + np.mean(loss), np.mean(loss) - prior * np.mean(np.array(loss)[positive])


def test_risk_and_its_gradient(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(200, quality.WIDTH)).astype(np.float32)
    positive = draw.random(200) < 0.3
    rows = [(row.tobytes(), bool(p)) for row, p in zip(x, positive)]
    risk = quality._Risk(spark.createDataFrame(rows, "x binary, positive boolean").repartition(3))
    z, w = (x - risk.mean) / risk.scale, draw.normal(size=quality.WIDTH) / 10
    ridge = risk.strength * np.concatenate(([0.0], w[1:]))
    value, negative, gradient, _ = risk.at(w, 0.4)
    assert (value - 0.5 * w @ ridge, negative) == pytest.approx(brute_risk(z, positive, w, 0.4))
    step = np.zeros(quality.WIDTH)
    for k in (0, 5, 20):
        step[:] = 0
        step[k] = 1e-5
        slope = (brute_risk(z, positive, w + step, 0.4)[0] - brute_risk(z, positive, w - step, 0.4)[0]) / 2e-5
        assert gradient[k] - ridge[k] == pytest.approx(slope, rel=1e-4, abs=1e-6)


def test_classifier_on_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(2, 1), (3, 0), (3, 1), (None, 1), (8, None), (9, 1)], "doc_id long, quality int")
    rows = quality.scored(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert quality.scored(nothing, labels).count() == 0
    assert quality.without_poor(odd, labels.where("false")).columns == odd.columns


# --- sharding --------------------------------------------------------------------------------------------------------


def test_hypergeometric_has_the_right_mean_and_range():
    random = np.random.default_rng(3)
    draws = [sharding.hypergeometric(1000, 300, 50, random) for _ in range(4000)]
    assert abs(np.mean(draws) - 15) < 0.3 and abs(np.var(draws) - 50 * 0.3 * 0.7 * 950 / 999) < 1
    assert sharding.hypergeometric(10, 10, 4, random) == 4 and sharding.hypergeometric(10, 0, 4, random) == 0
    assert abs(sharding.hypergeometric(10**11, 10**11 // 8, 10**6, random) - 125_000) < 5000


def test_matrix_margins():
    matrix = sharding.communication_matrix([5, 0, 17, 3], [9, 8, 8], np.random.default_rng(1))
    assert matrix.sum(axis=1).tolist() == [5, 0, 17, 3] and matrix.sum(axis=0).tolist() == [9, 8, 8]


def test_shards_are_exact_and_keep_every_row(spark, odd, nothing, tmp_path):
    out = sharding.sharded(odd, 5)
    got = out.collect()
    assert set(out.columns) == {*odd.columns, "slot"}
    assert Counter((r.doc_id, r.text) for r in got) == Counter(zip(ODD_ROWS["doc_id"], ODD))
    by = Counter(r.shard for r in got)
    assert set(by) == set(range(5)) and max(by.values()) - min(by.values()) <= 1
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(5) for k in range(by[s])]
    assert sharding.sharded(nothing, 5).count() == 0
    sharding.write_shards(odd, 3, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(ODD)


# --- personal data ---------------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PERSONAL = [
    "a@b.c_d@e.f x@y z@q.r.", "é mail jo.e+1@mail-a.example.org, 10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 00000255.1.1.1", "4111 1111 1111 1111 or 4111-1111-1111-1112 4111111111111111",
    "+49 (30) 123-4567. +1 2 +123456789012345678 +1 415 555 2671", "a@@b.c @x.y a@b..c a@b.c.d- 1.2.3", "x" * 3000 + "@example.com " + "1 " * 4000 + "a." * 2000 + "@b.co",
    "😀 😀 me@x.io 10.9.8.7", "12.34.56.78@host.name 1.1.1.1.@a.b", "378282246310005 3782822463100051",
]


def test_base_spans_equal_the_plain_patterns(spark, odd, nothing):
    random = np.random.default_rng(9)
    texts = PERSONAL + ["".join(random.choice(list("a.@-+1234567890 ()"), 80)) for _ in range(150)] + ODD
    docs = frame(spark, texts, lang=[None] * len(texts), source=[None] * len(texts))
    for r in pii.found_personal_data(docs).collect():
        want = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts[r.doc_id], want, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in ("email", "ip", "card", "phone")]
    assert pii.found_personal_data(odd).count() == len(ODD) and pii.found_personal_data(nothing).count() == 0


def test_revealing_terms_are_marked(spark):
    texts = [f"{' '.join(prose(k, 30))} write to Zebulon at zeb@mail.org about the {prose(k + 50, 1)[0]} soon" for k in range(5)]
    texts += [f"write to somebody at nobody about the thing soon {k}" for k in range(60)] + [texts[0]] * 3 + [f"lone{k} person p{k}@solo.org waits" for k in range(3)]
    docs = frame(spark, texts, lang=[None] * len(texts), source=[None] * len(texts))
    found = {r.doc_id: r.spans for r in pii.found_personal_data(docs).collect()}
    at = texts[0].index("Zebulon")
    assert f"remove:{at}:{at + 7}" in found[0].split(",")
    assert not any("remove" in found[k] or "generalise" in found[k] for k in range(5, 65)) and "remove" not in found[68]
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert "Zebulon" not in clean[0] and "zeb@" not in clean[0] and "<EMAIL>" in clean[0] and clean[5] == texts[5]


def test_revealing_terms_at_any_distance(spark):
    far = lambda k, n=400: " ".join(prose(k, n))
    texts = [f"Zebulon wrote {far(k)} Zebulon {far(k + 20)} zeb@mail.org {far(k + 40)} ZEBULON" for k in range(5)]
    texts += [f"somebody wrote {far(k + 90)}" for k in range(60)] + [f"Orlan and Orlan {far(k + 200)} orl@mail.org" for k in range(2)]
    texts += [f"\U0010ffff Éva near +49 30 1234567 {far(k + 300)} évaxy@mail.org \U0001f600 éva" for k in range(3)]
    docs = frame(spark, texts, lang=[None] * len(texts), source=[None] * len(texts))
    found = {r.doc_id: r.spans for r in pii.found_personal_data(docs).collect()}
    for k in range(5):
        want = [f"remove:{m.start()}:{m.end()}" for m in re.finditer("(?i)zebulon", texts[k])]
        assert [x for x in found[k].split(",") if x.startswith(("remove", "generalise"))] == want and len(want) == 3
    assert not any("remove" in found[k] or "generalise" in found[k] for k in range(5, 67))
    for k in range(67, 70):  # a run of letters that overlaps an entity is no term
        want = {f"remove:{m.start()}:{m.end()}" for m in re.finditer("(?i)(?<!\\w)éva(?!\\w)|near", texts[k])}
        assert {x for x in found[k].split(",") if x.startswith(("remove", "generalise"))} == want and len(want) == 3
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert not any("zebulon" in clean[k].lower() for k in range(5)) and clean[5] == texts[5]


# --- quality rules ---------------------------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    runs = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + d for k in range(len(w) - 2) if runs[tuple(w[k : k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rule_measures(spark, odd, nothing):
    texts = [" ".join(prose(k, 80, 5 + 20 * k)) + "\n\na b\n a b\na b\r\n#*$ |<x>&%" for k in range(20)] + ["a a a a a a", "x y\n" * 60] + ODD
    docs = frame(spark, texts, lang=(["en", "de", "zz"] * 50)[: len(texts)], source=[None] * len(texts))
    for r in quality_rules.judged(docs).collect():
        n, chars, symbols, lines, repeated = want = brute_measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and not (r.base_failed and r.kept)
    assert quality_rules.judged(odd).count() == len(ODD) and quality_rules.judged(nothing).count() == 0


def test_distance_is_jensen_shannon(spark):
    a, b = np.array([1.0, 2, 0, 5]), np.array([3.0, 0, 1, 4])
    got = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<double>, b array<double>").select(quality_rules.distance(F.col("a"), F.col("b"))).first()[0]
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2
    want = np.sqrt(sum(x[k] * np.log2(x[k] / m[k]) for x in (p, q) for k in range(4) if x[k] > 0) / 2)
    assert got == pytest.approx(want)


# --- language --------------------------------------------------------------------------------------------------------


def test_language_of_pages(spark, nothing):
    base = "/root/testdata/sf0.01"
    pages, docs = spark.read.parquet(f"{base}/pages.parquet"), spark.read.parquet(f"{base}/documents.parquet")
    found = language_id.identified(pages, docs).collect()
    assert len(found) == pages.count()
    long = [r for r in found if r.declared in ("en", "de", "fr", "es")]
    assert np.mean([r.lang == r.declared for r in long]) > 0.9
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "http://h.de/", "", "x"), (3, "nonsense", "<html lang=de><p>hi", "x"), (3, "nonsense", "<html lang=de><p>hi", "x")], "page_id long, url string, html string, lang string")
    rows = language_id.identified(odd, docs).collect()
    assert len(rows) == 4 and all(r.lang for r in rows)
    assert language_id.identified(odd.where("false"), docs).count() == 0
    assert language_id.identified(odd, nothing).where("lang IS NULL").count() == 4


def test_rare_languages_are_candidates(spark, monkeypatch):
    english = "the weather of the north was cold and the people stayed at home with their books "
    rare = {"fi": "talvella on kylmää ja ihmiset pysyvät kotona lukemassa kirjoja takan ääressä ", "sw": "watu wengi walikaa nyumbani wakisoma vitabu kwa sababu ya baridi kali sana "}
    texts = [(english, "en")] * 2500 + [(rare["fi"] * 3, "fi"), (rare["sw"] * 3, "sw"), ("", "zz")]
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(3)
    rows = [(k, f"http://h{k}.{lang}/", f"<html lang={lang}><p>{text * 5}") for k, (lang, text) in enumerate([("en", english), *rare.items()])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(language_id.identified(pages, docs).collect())
    assert [(r.lang, r.text_lang) for r in whole] == [("en", "en"), ("fi", "fi"), ("sw", "sw")]
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", 1)  # a block for each language: the same lines
    assert sorted(language_id.identified(pages, docs).collect()) == whole


# --- token counts ----------------------------------------------------------------------------------------------------


def test_counts_equal_a_unigram_tokenizer(odd, nothing, spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    scores = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    pieces = [("<unk>", 0.0), *scores.items(), *[(f"<0x{b:02X}>", -1e6) for b in range(256)]]
    plain = {piece: score for piece, score in scores.items()}
    own = Tokenizer(Unigram(pieces, 0, False))
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    texts = {r.doc_id: r.text for r in sample.collect()}

    def best(pre_token):
        top = [(0.0, 0)]
        for end in range(1, len(pre_token) + 1):
            options = [(top[s][0] + plain[pre_token[s:end]], top[s][1] + 1) for s in range(end) if pre_token[s:end] in plain]
            if pre_token[end - 1] not in plain:
                options.append((top[end - 1][0] + min(plain.values()) - token_counts.UNKNOWN, top[end - 1][1] + len(pre_token[end - 1].encode())))
            top.append(max(options, key=lambda o: o[0]))
        return top[-1][1]

    for r in token_counts.counted(sample).collect():
        assert r.n_pre_tokens == len(words(texts[r.doc_id]))
        assert r.n_tokens == sum(best("▁" + w) for w in words(texts[r.doc_id]))
        covered = [w for w in words(texts[r.doc_id]) if all(c in plain for c in w)]
        assert sum(best("▁" + w) for w in covered) == sum(len(own.encode("▁" + w).ids) for w in covered)
    assert Counter((r.doc_id, r.n_pre_tokens) for r in token_counts.counted(odd).collect()) == Counter((i, len(words(t))) for i, t in zip(ODD_ROWS["doc_id"], ODD))
    assert token_counts.counted(nothing).count() == 0
