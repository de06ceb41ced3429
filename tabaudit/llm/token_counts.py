"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

A text's pre-tokens are its words, each with the word mark in front. A task takes the distinct pre-tokens of its rows in
sorted order, which walks their trie depth-first: the best scores along the current path stand on a stack, and a
pre-token computes only the nodes that it doesn't share with the one before. Its terminal node stores the number of
pieces of the best segmentation; documents add up the stored counts of their words.

Scores are log probabilities of the vocabulary's ranks by Zipf's law. A character that no piece covers is spelled in its
UTF-8 bytes, one token each. Null and empty texts have 0 tokens. Repeated rows are counted alike.

The distinct pre-tokens of a task are bounded by its input, so nothing is exchanged: a shared table of all pre-tokens
would have to be joined with every word of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabaudit.llm.common import require, text_of

MARK = "▁"
#: Counts that a task keeps from batch to batch before it starts anew.
KEPT_COUNTS = 1 << 20
#: How much less likely than the rarest piece an uncovered character is, as a logarithm.
UNKNOWN = 10.0


def vocabulary(path: str) -> dict[str, float]:
    """Pieces of text and their scores, from the ranks of a vocabulary file; control and byte pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(k) for k in range(model.vocab_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    whole = math.log(sum(1 / (rank + 1) for rank in range(len(pieces))))
    return {piece: -math.log(rank + 1) - whole for rank, piece in enumerate(pieces)}


class Trie:
    """Counts of sorted pre-tokens; the stacks hold the path to the current node."""

    def __init__(self, scores: dict[str, float]):
        self.scores, self.longest = scores, max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN

    def counts(self, pre_tokens: Iterable[str]) -> Iterator[tuple[str, int]]:
        scores, longest, unknown = self.scores, self.longest, self.unknown
        path, best, tokens = "", [0.0], [0]
        for pre_token in pre_tokens:
            shared, most = 0, min(len(path), len(pre_token))
            while shared < most and path[shared] == pre_token[shared]:
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(pre_token) + 1):
                top, n = -math.inf, 0
                for start in range(max(0, end - longest), end):
                    score = scores.get(pre_token[start:end])
                    if score is not None and best[start] + score > top:
                        top, n = best[start] + score, tokens[start] + 1
                if pre_token[end - 1] not in scores and best[end - 1] + unknown > top:
                    top, n = best[end - 1] + unknown, tokens[end - 1] + len(pre_token[end - 1].encode("utf-8", "surrogatepass"))
                best.append(top)
                tokens.append(n)
            path = pre_token
            yield pre_token, tokens[-1]


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_pre_tokens, n_tokens``, one row for each row of ``docs``."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(vocabulary(path)), {}
        for batch in batches:
            texts, start = batch.column("text"), 0
            while start < batch.num_rows:
                split, size = [], 0
                while start < batch.num_rows and size < 1 << 22:
                    body = texts[start].as_py().encode("utf-8", "surrogatepass")
                    split.append(body.split())  # white space of bytes is just the six characters
                    size, start = size + len(body) + 1, start + 1
                if len(known) > KEPT_COUNTS:
                    known = {}
                fresh = sorted({MARK + w.decode("utf-8", "surrogatepass") for w in set().union(*split) if w not in known})
                for pre_token, n in trie.counts(fresh):
                    known[pre_token[1:].encode("utf-8", "surrogatepass")] = n
                n_words = np.array([len(words) for words in split], np.int64)
                n_tokens = np.array([sum(map(known.__getitem__, words)) for words in split], np.int64)
                ids = batch.column("doc_id").slice(start - len(split), len(split))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n_words), pa.array(n_tokens)], ["doc_id", "n_pre_tokens", "n_tokens"])

    rows = require(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_pre_tokens long, n_tokens long")
