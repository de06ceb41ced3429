"""Byte-level BPE: encoding by a priority queue of merge ranks over a doubly linked symbol list, decoding by concatenation.

A text is cut at added tokens, then into pre-tokens. The symbols of a pre-token, its bytes at first, form a doubly linked
list. A queue holds every pair of neighbours that has a merge, lowest rank first, then leftmost. The best pair is merged
into its left symbol and the two new neighbour pairs are queued; entries whose symbols have changed since are stale and are
skipped. A pre-token of ``n`` bytes takes ``n log n`` steps, however long it is. Decoding joins the vocabulary strings of the
ids, which are bytes, and reads them as UTF-8.

Null text counts as empty: no ids, and empty text again. Rows that repeat are encoded each. Texts are encoded whole. Further
columns of the documents aren't used; an empty table gives an empty result. What is remembered of pre-tokens is bounded in
bytes per task, and a long pre-token isn't remembered at all.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabaudit.llm.common import require, text_of

#: Bytes of pre-tokens that a task remembers, and the longest one it does.
REMEMBERED_BYTES, REMEMBERED_LENGTH = 1 << 26, 64
#: Bytes of ids or texts in a batch on its way back to Spark.
BATCH_BYTES = 1 << 23
PLACE_BITS, PLACE_MASK = 40, (1 << 40) - 1

# Letters, digits and marks on whose kind all versions of Unicode agree. Texts with other characters are cut
# into pre-tokens by the tokenizer file's own rule, which knows the version that the vocabulary was made with.
SETTLED = [
    (0x0, 0x557), (0x590, 0x5FF), (0x620, 0x64A), (0x660, 0x669), (0x905, 0x939), (0xE01, 0xE2E), (0x2000, 0x206F), (0x20A0, 0x20BF), (0x2100, 0x214F),
    (0x2190, 0x2BFF), (0x3000, 0x30FF), (0x3400, 0x4DB5), (0x4E00, 0x9FCC), (0xAC00, 0xD7A3), (0xFF01, 0xFF9F), (0x1F300, 0x1F64F),
]
UNSETTLED = regex.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SETTLED) + "]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself where it can be seen, else the next one from U+0100."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level tokenizer file: vocabulary strings as bytes, merges by rank, added tokens."""

    def __init__(self, json_path: str):
        with open(json_path, encoding="utf-8") as file:
            content = json.load(file)
        letters, model = byte_letters(), content["model"]
        self.added = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.strings = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items()}
        self.strings |= {i: token.encode() for token, i in self.added.items()}
        self.byte_ids = [model["vocab"][letter] for _, letter in sorted((b, letter) for letter, b in letters.items())]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[model["vocab"][left], model["vocab"][right]] = (rank << PLACE_BITS, model["vocab"][left + right])
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.cuts = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.json_path, self.splitter = json_path, None
        self.known: dict[str, list[int]] = {}
        self.known_bytes = 0

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii() or not UNSETTLED.search(text):
            return self.words.findall(text)
        if self.splitter is None:
            self.splitter = Tokenizer.from_file(self.json_path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def ids(self, text: str) -> np.ndarray:
        out: list[int] = []
        start = 0
        for cut in self.cuts.finditer(text) if self.cuts else ():
            self._extend(out, text[start : cut.start()])
            out.append(self.added[cut.group()])
            start = cut.end()
        self._extend(out, text[start:] if start else text)
        return np.array(out, np.int32)

    def _extend(self, out: list[int], text: str) -> None:
        known = self.known
        for word in self.pre_tokens(text):
            ids = known.get(word)
            if ids is None:
                ids = merged([self.byte_ids[b] for b in word.encode()], self.merges)
                if len(word) <= REMEMBERED_LENGTH:
                    if self.known_bytes > REMEMBERED_BYTES:
                        known.clear()
                        self.known_bytes = 0
                    known[word] = ids
                    self.known_bytes += 200 + 8 * len(ids) + len(word)
            out += ids

    def text(self, ids: np.ndarray) -> str:
        """Unknown ids stand for nothing; bytes that aren't UTF-8 are read as U+FFFD."""
        strings = self.strings
        return b"".join([strings.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")


def merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols after all merges, lowest rank first and leftmost among equals. ``merges`` holds ranks above the bits of a place."""
    n, known = len(symbols), merges.get
    # An entry is the rank and the place of a pair in one number.
    queue = [found[0] | at for at, pair in enumerate(zip(symbols, symbols[1:])) if (found := known(pair)) is not None]
    if not queue:
        return symbols
    heapq.heapify(queue)
    pop, push = heapq.heappop, heapq.heappush
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbols.append(-1)  # stands behind the last one and has no merges
    while queue:
        best = pop(queue)
        at = best & PLACE_MASK
        then = after[at]
        if then > n:
            continue  # stale: this symbol was merged into the one before it
        found = known((symbols[at], symbols[then]))
        if found is None or found[0] | at != best:
            continue  # stale: one of the two was merged meanwhile, and the rank is another pair's
        new = found[1]
        symbols[at], symbols[then] = new, -1
        far = after[at] = after[then]
        after[then] = n + 1
        if far < n:
            before[far] = at
            found = known((new, symbols[far]))
            if found is not None:
                push(queue, found[0] | at)
        near = before[at]
        if near >= 0:
            found = known((symbols[near], new))
            if found is not None:
                push(queue, found[0] | near)
    return [s for s in symbols if s >= 0]


def _parts(sizes: Iterator[int]) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BATCH_BYTES`` each; sizes are asked for one by one, a range is given when it is full."""
    start, total, row = 0, 0, -1
    for row, size in enumerate(sizes):
        total += size
        if total >= BATCH_BYTES:
            yield start, row + 1
            start, total = row + 1, 0
    if start <= row:
        yield start, row + 1


def encoded(docs: DataFrame, json_path: str | None = None) -> DataFrame:
    """``doc_id, ids``: the token ids of every text, added tokens included where their strings occur."""
    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(json_path)
        for batch in batches:
            texts, made = batch.column("text"), []

            def sizes() -> Iterator[int]:
                for row in range(batch.num_rows):
                    made.append(vocabulary.ids(texts[row].as_py()))
                    yield made[-1].nbytes

            for start, stop in _parts(sizes()):
                offsets = np.concatenate(([0], np.cumsum([len(ids) for ids in made]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), ids], ["doc_id", "ids"])
                made.clear()

    rows = require(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, json_path: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` for ``tokens(doc_id, ids)``; null ids count as none."""
    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(json_path)
        for batch in batches:
            column, made = batch.column("ids"), []
            values, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()

            def sizes() -> Iterator[int]:
                for row in range(batch.num_rows):
                    made.append(vocabulary.text(values[at[row] : at[row + 1]]))
                    yield len(made[-1])

            for start, stop in _parts(sizes()):
                yield pa.RecordBatch.from_arrays([*batch.slice(start, stop - start).columns, pa.array(made, pa.string())], ["doc_id", "ids", "text"])
                made.clear()

    rows = tokens.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(decode, "doc_id long, ids array<int>, text string")
