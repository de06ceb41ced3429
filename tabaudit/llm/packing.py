"""Packing documents into sequences: first-fit decreasing in a tournament tree of bin capacities.

Documents are dealt into randomised groups of bounded size, and each group is packed by itself. A document longer than a
sequence gives full sequences of its own; what remains of it, and every shorter document, goes to the first bin that has
room, from the longest to the shortest. The bins are the leaves of a tournament tree whose nodes hold the largest
capacity below, so finding the first bin takes a walk from the root. Then the gaps of the fuller bins are filled with
tokens cut off the emptiest ones, and the single bin that is left is cut into sequences whose lengths are powers of two,
which need no padding.

Null text counts as empty: a document of the end id alone. Rows that repeat are documents of their own.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabaudit.llm.common import require, text_of

LENGTH = 2048
END_ID = 1
#: Documents of a group, on average.
GROUP_DOCUMENTS = 2048

#: One piece of a document: its row in the group, first token, number of tokens.
Piece = tuple[int, int, int]


class Encoder:
    """Token ids of the byte-level vocabulary.

    Texts in Latin letters are encoded from the rank file of the same vocabulary, which is several times faster; all
    other texts by the tokenizer file itself, because the two libraries may disagree on newer letters. So are texts
    with a very long run of white space, which the faster library can't take.
    """

    FAR = re.compile("[^\u0000-\u024f\u2000-\u206f]")
    WIDE = re.compile(r"\s{100000}")

    def __init__(self, json_path: str, ranks_path: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.near = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.far = json_path, None

    def ids(self, text: str) -> np.ndarray:
        if not self.FAR.search(text) and not self.WIDE.search(text):
            return self.near.encode_to_numpy(text, disallowed_special=()).astype(np.uint16)
        if self.far is None:
            self.far = Tokenizer.from_file(self.json_path)
            self.far.encode_special_tokens = True
        return np.array(self.far.encode(text, add_special_tokens=False).ids, np.uint16)


def encoded(docs: DataFrame, groups: int, json_path: str, ranks_path: str) -> DataFrame:
    """``pack_group, doc_id, ids``: the token ids of every document with the end id, two bytes each."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(json_path, ranks_path), np.array([END_ID], np.uint16)
        for batch in batches:
            texts, start, bodies, size = batch.column("text"), 0, [], 0
            for row in range(batch.num_rows):
                bodies.append(np.concatenate((encoder.ids(texts[row].as_py()), end)).tobytes())
                size += len(bodies[-1])
                if size > 1 << 23 or row == batch.num_rows - 1:
                    part = batch.slice(start, row + 1 - start)
                    yield pa.RecordBatch.from_arrays([part.column("pack_group"), part.column("doc_id"), pa.array(bodies, pa.binary())], ["pack_group", "doc_id", "ids"])
                    start, bodies, size = row + 1, [], 0

    dealt = require(docs, "doc_id", "text").select(
        F.pmod(F.xxhash64(F.monotonically_increasing_id(), "doc_id"), F.lit(groups)).alias("pack_group"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    return dealt.mapInArrow(encode, "pack_group long, doc_id long, ids binary")


class Tournament:
    """Bins in the order they were opened; finds the first with room for a size."""

    def __init__(self, most: int, capacity: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [0] * (2 * self.leaves)
        self.capacity, self.opened = capacity, 0

    def place(self, size: int) -> int:
        room, node = self.room, 1
        if room[1] < size:
            chosen, self.opened = self.opened, self.opened + 1
            node = self.leaves + chosen
            room[node] = self.capacity - size
        else:
            while node < self.leaves:
                node *= 2
                if room[node] < size:
                    node += 1
            chosen = node - self.leaves
            room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return chosen


def packed(lengths: np.ndarray, capacity: int = LENGTH) -> list[list[Piece]]:
    """Sequences of pieces for documents of the given lengths. Every token lies in exactly one piece."""
    sequences: list[list[Piece]] = []
    rest: list[Piece] = []
    for row, total in enumerate(lengths.tolist()):
        full = total // capacity
        sequences += [[(row, k * capacity, capacity)] for k in range(full)]
        if total > full * capacity:
            rest.append((row, full * capacity, total - full * capacity))
    rest.sort(key=lambda piece: (-piece[2], piece[0]))
    bins: list[list[Piece]] = []
    tree = Tournament(len(rest), capacity)
    for piece in rest:
        at = tree.place(piece[2])
        if at == len(bins):
            bins.append([])
        bins[at].append(piece)
    fill = [sum(piece[2] for piece in b) for b in bins]
    sequences += [b for b, n in zip(bins, fill) if n == capacity]
    gaps = sorted((n, k) for k, n in enumerate(fill) if n < capacity)
    low, high = 0, len(gaps) - 1  # the emptiest bin gives, the fullest takes
    while low < high:
        give, take = bins[gaps[low][1]], bins[gaps[high][1]]
        row, start, size = give.pop()
        moved = min(size, capacity - fill[gaps[high][1]])
        take.append((row, start + size - moved, moved))
        fill[gaps[high][1]] += moved
        if moved < size:
            give.append((row, start, size - moved))
        if not give:
            low += 1
        if fill[gaps[high][1]] == capacity:
            sequences.append(take)
            high -= 1
    if low == high and bins[gaps[low][1]]:
        sequences += _powers_of_two(bins[gaps[low][1]])
    return sequences


def _powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    left, out = list(reversed(pieces)), []
    total = sum(piece[2] for piece in pieces)
    for bit in reversed(range(total.bit_length())):
        want, sequence = total & (1 << bit), []
        while want:
            row, start, size = left.pop()
            moved = min(size, want)
            sequence.append((row, start, moved))
            want -= moved
            if moved < size:
                left.append((row, start + moved, size - moved))
        if sequence:
            out.append(sequence)
    return out


def pack(docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None, capacity: int = LENGTH) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``: one row for each piece, with its token ids."""
    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    groups = max(1, math.ceil(docs.count() / GROUP_DOCUMENTS))

    def work(group: pd.DataFrame) -> pd.DataFrame:
        ids = [np.frombuffer(body, np.uint16) for body in group["ids"]]
        names, base, rows = group["doc_id"].array, int(group["pack_group"].iloc[0]) << 31, []
        for number, sequence in enumerate(packed(np.array([len(x) for x in ids]), capacity)):
            offset = 0
            for row, start, size in sequence:
                body = ids[row][start : start + size]
                crc = zlib.crc32(body.astype("<u4").tobytes())
                rows.append((names[row], start, size, crc, len(ids[row]), base + number, offset, body.tobytes()))
                offset += size
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
        return out.astype({"doc_id": "Int64"})

    return encoded(docs, groups, json_path, ranks_path).groupBy("pack_group").applyInPandas(
        work, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
