"""Public tokenizers inside tasks.

A vocabulary is read once, by the driver, from a path that is a parameter, and goes to the tasks as a
broadcast of fixed size.  A worker builds its tokenizer from it once.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
import tokenizers
from pyspark import Broadcast
from pyspark.sql import SparkSession

from folioworks.llm.common import by_value

BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
_SPACE_MARK = "▁"
#: Signs whose classes all Unicode versions in use agree on, and a run of white space that makes patterns slow.
_UNUSUAL = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-₿]")
_LONG_SPACE = re.compile(r"\s{2000}")


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: itself if visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairs:
    """Ids of a byte-level vocabulary, as the tokenizers library gives them without special tokens.

    Usual texts go through a faster encoder with the same merges; texts with rare signs, special
    strings or very long white space through the library itself.  ``plain`` takes special strings in a
    text for text.
    """

    def __init__(self, source: str, plain: bool) -> None:
        self.exact = tokenizers.Tokenizer.from_str(source)
        self.exact.encode_special_tokens = plain
        signs = byte_signs()
        vocabulary = self.exact.get_vocab(with_added_tokens=False)
        added = self.exact.get_added_tokens_decoder()
        self.special = [] if plain else [t.content for t in added.values()]
        bytes_of = {i: bytes(signs[s] for s in piece) for piece, i in vocabulary.items() if i not in added}
        self.fast = tiktoken.Encoding("pairs", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in bytes_of.items()}, special_tokens={})
        self.bytes = [bytes_of.get(i, b"") for i in range(max([*bytes_of, *added]) + 1)]

    def encode(self, text: str) -> np.ndarray:
        if _UNUSUAL.search(text) or any(s in text for s in self.special) or (len(text) >= 2000 and _LONG_SPACE.search(text)):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


class Pieces:
    """Ids of a piece vocabulary; it puts a space before the text."""

    def __init__(self, model: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = [self._bytes(i) for i in range(self.library.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        if self.library.is_control(i) or self.library.is_unknown(i):
            return b""
        piece = self.library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace(_SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


def shared(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary's file and an empty dictionary, in which a worker keeps what it builds from the file."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast((file.read(), {}))


def byte_pairs(vocabulary: Broadcast, plain: bool) -> BytePairs:
    content, built = vocabulary.value
    if plain not in built:
        built[plain] = BytePairs(content.decode(), plain)
    return built[plain]


def pieces(vocabulary: Broadcast) -> Pieces:
    content, built = vocabulary.value
    if "pieces" not in built:
        built["pieces"] = Pieces(content)
    return built["pieces"]


by_value(__name__)
