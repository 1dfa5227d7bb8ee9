"""Token counts by a unigram model, its dynamic programming shared along a trie of pre-tokens.

Texts are cut into pre-tokens by a pattern.  The distinct pre-tokens of a batch form a trie; at each of
its nodes the forward score, the best sum of log probabilities of pieces that spell the prefix, is
computed once, from the scores of the nodes above it, so pre-tokens that begin alike share the work.
The node at which a pre-token ends stores its number of tokens, and a text's count is the sum over its
pre-tokens.  Counting is local to a batch: nothing is shuffled.

The vocabulary is a file of byte pieces with ranks, given by its path and read once by the driver.  Such
a file has no probabilities; a piece of rank r is given the log probability -log(r + 1) less the
logarithm of the sum, Zipf's law.  Every byte is a piece, so any text can be spelt.  Among spellings
with the same score, the one with fewer tokens counts.

Defined cases: a null or empty text has no tokens; rows that repeat are counted each; other columns are
ignored; very long pre-tokens cost their length times the longest piece.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.common import by_value

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pattern that goes with the vocabulary: contractions, letters, digits, other signs, space.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose counts a task remembers at a time; it affects speed alone.
_REMEMBERED = 1 << 20


def read_pieces(path: str = VOCABULARY) -> dict[bytes, float]:
    """Log probability of each piece."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary must hold every single byte")
    total = math.log(sum(1.0 / (r + 1) for r in ranks.values()))
    return {piece: -math.log(r + 1) - total for piece, r in ranks.items()}


class Trie:
    """Tokens of pre-tokens, walked in sorted order: the path from the root is the pre-token at hand."""

    def __init__(self, pieces: dict[bytes, float]) -> None:
        self.pieces = pieces
        # A piece of three bytes or more that ends with these three has at most so many.
        self.reach: dict[bytes, int] = {}
        for piece in pieces:
            if len(piece) > 2:
                self.reach[piece[-3:]] = max(self.reach.get(piece[-3:], 0), len(piece))

    def terminals(self, pre_tokens: list[bytes]) -> list[int]:
        """The number of tokens of each pre-token, which must be distinct and sorted."""
        pieces, reach = self.pieces, self.reach
        # Along the path: forward score and tokens of each prefix.
        score, tokens = [0.0], [0]
        counts, before = [], b""
        for word in pre_tokens:
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del score[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best = score[end - 1] + pieces[word[end - 1 : end]]
                fewest = tokens[end - 1] + 1
                longest = reach.get(word[end - 3 : end], 2) if end > 2 else 2
                for begin in range(end - 2, max(end - longest, 0) - 1, -1):
                    own = pieces.get(word[begin:end])
                    if own is not None:
                        total = score[begin] + own
                        if total > best or (total == best and tokens[begin] < fewest):
                            best, fewest = total, tokens[begin] + 1
                score.append(best)
                tokens.append(fewest)
            counts.append(tokens[-1])
            before = word
        return counts


class Counting:
    def __init__(self, pieces: dict[bytes, float], pattern: str = PATTERN) -> None:
        self.trie, self.cut, self.known = Trie(pieces), regex.compile(pattern), {}

    def count(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """Pre-tokens and tokens of each text."""
        bags = [Counter(self.cut.findall(t)) if t else {} for t in texts]
        fresh = {w for bag in bags for w in bag if w not in self.known}
        if len(self.known) + len(fresh) > _REMEMBERED:
            self.known = {}
            fresh = {w for bag in bags for w in bag}
        coded = sorted((w.encode("utf-8", "replace"), w) for w in fresh)
        distinct, last = [], None
        for code, _ in coded:
            if code != last:
                distinct.append(code)
                last = code
        by_code = dict(zip(distinct, self.trie.terminals(distinct), strict=True))
        self.known.update((w, by_code[code]) for code, w in coded)
        known = self.known
        return [sum(bag.values()) for bag in bags], [sum(n * known[w] for w, n in bag.items()) for bag in bags]


def count_tokens(docs: DataFrame, pieces: dict[bytes, float] | None = None, pattern: str = PATTERN, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_pre_tokens and n_tokens of every row."""
    pieces = pieces or read_pieces()
    picked = docs.select("doc_id", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint").alias("n_bytes"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # a vocabulary, whose size no input changes
    fields = [picked.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_pre_tokens", "n_tokens")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(shared.value, pattern)
        for batch in batches:
            cut, spelt = counting.count(batch.column(2).to_pylist())
            columns = [batch.column(0), batch.column(1), pa.array(np.array(cut, np.int64)), pa.array(np.array(spelt, np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return picked.mapInArrow(run, T.StructType(fields))


by_value(__name__)
