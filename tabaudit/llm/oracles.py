"""SQL for the queries that SQL can express."""

from tabaudit.llm.quality_rules import CHARACTER_LIMIT, CHARACTER_WORDS, COMMON_WORDS, WORD_LIMIT, WORD_WORDS

_COMMON = " UNION ALL ".join(f"SELECT '{lang}' AS lang, unnest({words!r}) AS word" for lang, words in COMMON_WORDS.items())


def _distance(counts: str, by: str) -> str:
    """Jensen-Shannon distance of each document's ``counts(doc_id, lang, kind, n)`` to the sums of its language."""
    return f"""SELECT doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS {by}
 FROM (SELECT doc_id, n / sum(n) OVER (PARTITION BY doc_id) AS p, sum(CASE WHEN base_failed THEN 0 ELSE n END) OVER (PARTITION BY lang, kind)
 / sum(CASE WHEN base_failed THEN 0 ELSE n END) OVER (PARTITION BY lang) AS q FROM {counts} JOIN base USING (doc_id)) GROUP BY doc_id"""


#: CRC-32 of the decimal digits of a number: eight shifts for each of them.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(cast({0} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda crc, b:
 list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)))"""


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(cast({c} AS VARCHAR)) || ':' || cast({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, first: str) -> str:
    """All levels of the trees whose leaves are ``first(source, k, node, n)``."""
    return f"""{name} AS (SELECT source, 0 AS level, k, node, n FROM {first} UNION ALL
 SELECT source, any_value(level) + 1, k // 16, sha256(string_agg(node, '' ORDER BY k)), (any_value(n) + 15) // 16 FROM {name} WHERE n > 1 GROUP BY source, k // 16)"""


def _steps(leaves: str, levels: str, above: int) -> str:
    """For each of ``leaves(source, k, name)`` and each level the digests left and right of its node."""
    own = "(x.k >> (4 * level))"
    return f"""SELECT x.name AS name, level + {above} AS level, coalesce(string_agg(u.node, '' ORDER BY u.k) FILTER (WHERE u.k < {own}), '') AS l, coalesce(string_agg(u.node, '' ORDER BY u.k) FILTER (WHERE u.k > {own}), '') AS r
 FROM {leaves} x JOIN {levels} u ON u.source IS NOT DISTINCT FROM x.source AND u.n > 1 AND u.k // 16 = x.k >> (4 * (level + 1)) GROUP BY ALL"""


ORACLES = {
    "op11_merkle_manifest": rf"""
WITH RECURSIVE docs AS (
    SELECT *, CASE WHEN {_CRC32.format("doc_id")} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS text2 FROM documents
), leaves AS (
    SELECT doc_id, source, {_leaf("text")} AS node, {_leaf("text2")} AS tampered, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {_leaf("text")}) - 1 AS k,
        count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS name FROM docs
), {_levels("low", "leaves")}, roots AS (
    SELECT source AS name, NULL AS source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS k, node, count(*) OVER () AS n FROM low WHERE n = 1
), {_levels("high", "roots")}, lower_steps AS ({_steps("leaves", "low", 0)}
), upper_steps AS ({_steps("roots", "high", 1000)}
), steps AS (
    SELECT name, level, l, r FROM lower_steps UNION ALL SELECT x.name, s.level, l, r FROM leaves x JOIN upper_steps s ON s.name IS NOT DISTINCT FROM x.source
), proofs AS (
    SELECT name, sha256(string_agg(l || r, '' ORDER BY level)) AS proof_sha256, list({{'l': l, 'r': r, 'h': ''}} ORDER BY level) AS steps FROM steps GROUP BY name
), folded AS (
    SELECT x.*, coalesce(proof_sha256, sha256('')) AS proof_sha256, list_reduce(list_prepend({{'l': '', 'r': '', 'h': tampered}}, coalesce(steps, [])),
        lambda a, s: {{'l': '', 'r': '', 'h': sha256(s.l || a.h || s.r)}}).h AS folded_root FROM leaves x LEFT JOIN proofs USING (name)
)
SELECT doc_id, f.node AS leaf, roots.node AS subroot, high.node AS root, proof_sha256, folded_root, folded_root = high.node AS verified
FROM folded f JOIN roots ON roots.name IS NOT DISTINCT FROM f.source JOIN high ON high.n = 1""",
    "op13_hard_negatives": """
WITH rows_ AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
    FROM rows_ a JOIN rows_ b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), near AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, cast(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM near JOIN scores USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10""",
    "op8_exact_dedup": r"""
WITH norm AS (
    SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
), ranked AS (
    SELECT doc_id, body, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
    FROM norm WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked""",
    "op5_ngram_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)""",
    "op10_quality_rules": rf"""
WITH texts AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS x FROM texts WHERE len(w) > 2
), repeated AS (
    SELECT doc_id, count(DISTINCT i + d) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS times FROM windows), (SELECT unnest([0, 1, 2]) AS d)
    WHERE times > 1 GROUP BY doc_id
), measured AS (
    SELECT doc_id, lang, t, w, cast(len(w) AS BIGINT) AS n_words, cast(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        cast(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM texts LEFT JOIN repeated USING (doc_id)
), base AS (
    SELECT doc_id, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), odd AS (
    SELECT doc_id, lang, t, n_symbols, regexp_replace(t, '[\p{{Ll}} ]+', '', 'g') AS odd FROM measured
), classes AS (
    SELECT doc_id, lang, n_symbols AS symbol, length(t) - length(odd) AS lower, length(odd) - length(regexp_replace(odd, '\p{{Lu}}', '', 'g')) AS upper,
        length(odd) - length(regexp_replace(odd, '\p{{N}}', '', 'g')) AS digit, length(odd) - length(regexp_replace(odd, '[.,;:!?''"()-]', '', 'g')) AS mark,
        length(odd) - length(regexp_replace(odd, '[\n\r]', '', 'g')) AS line, length(odd) AS odd_chars FROM odd
), characters AS (
    UNPIVOT (SELECT doc_id, lang, lower, upper, digit, mark, symbol, line, greatest(odd_chars - upper - digit - mark - symbol - line, 0) AS rest FROM classes)
    ON lower, upper, digit, mark, symbol, line, rest INTO NAME kind VALUE n
), known AS ({_COMMON}
), hits AS (
    SELECT m.doc_id, k.lang, k.word, count(*) AS n FROM (SELECT doc_id, lang, lower(unnest(w)) AS word FROM measured) m JOIN known k ON k.lang = m.lang AND k.word = m.word GROUP BY ALL
), common AS (
    SELECT m.doc_id, m.lang, k.word AS kind, coalesce(h.n, 0) AS n FROM measured m JOIN known k USING (lang) LEFT JOIN hits h ON h.doc_id = m.doc_id AND h.word = k.word
    UNION ALL SELECT m.doc_id, m.lang, NULL, any_value(n_words) - coalesce(sum(h.n), 0) FROM measured m LEFT JOIN hits h USING (doc_id)
    WHERE m.lang IN (SELECT lang FROM known) GROUP BY m.doc_id, m.lang
), by_character AS ({_distance("characters", "c")}
), by_word AS ({_distance("common", "d")}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (n_words >= {CHARACTER_WORDS} AND coalesce(c, 0) > {CHARACTER_LIMIT} OR n_words >= {WORD_WORDS} AND coalesce(d, 0) > {WORD_LIMIT}) AS kept
FROM measured JOIN base USING (doc_id) LEFT JOIN by_character USING (doc_id) LEFT JOIN by_word USING (doc_id)""",
}
