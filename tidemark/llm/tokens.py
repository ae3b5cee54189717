"""Token ids by the tokenizers library, with a cache of words."""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A byte-level BPE never joins what stands on both sides of a border between a
# visible character and white space, so a text may be encoded in such chunks.
CHUNK = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
# With other white space in the text the borders are less plain: encode it whole.
OTHER_SPACE = re.compile(r"[^\S \n\t\r]")
# Where such stand, white space is more than single spaces and line breaks.
GAPS = ("  ", "\t", "\r", "\n\n", " \n", "\n ")
# Nor does it join a letter or digit with the signs after it.
SIGNS = string.punctuation
PROBE = " \u00e9ab\u00fc\u4e2d\u00ff"


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """The ids of the `size` latest pieces of text, and of those that were used while the ones before them were the latest."""

    def __init__(self, encode: Callable[[str], bytes], size: int):
        super().__init__()
        self.encode, self.size, self.older = encode, size, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Texts to little-endian id arrays; equal to `Tokenizer.encode` for byte-level BPE with its own word pattern.

    Words repeat, so their ids are kept, and a text of words with one space or line break between
    them is cut where these stand.
    """

    def __init__(self, path: str, words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else re.compile(r"(?!)")
        self.letters = byte_letters()
        # Machines that Spark runs on are little-endian, as the ids are.
        self.code = "H" if self.dtype == "<u2" else "I"
        self.merge = self.tokenizer.model.tokenize
        self.space = self.letters[ord(" ")]
        # A word of letters goes to the merges themselves, if that gives the same ids.
        self.direct = self._merged(PROBE) == self._encode(PROBE) and self._merged(PROBE.strip()) == self._encode(PROBE.strip())
        # What stands after a space, or is a line break with what follows it; and pieces as they are.
        self.known = Words(self._piece, words)
        self.raw = Words(self._chunk, max(1, words // 4))

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype).tobytes()

    def _merged(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        elif word[:1] == " ":
            word = self.space + word[1:]
        return array(self.code, [t.id for t in self.merge(word)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        word = chunk.removeprefix(" ")
        if self.direct and word.isalpha():
            return self._merged(chunk)
        core = chunk.rstrip(SIGNS)
        if len(core) < len(chunk) and core[-1:].isalnum() and not self.special.search(chunk):
            before = self.known[core[1:]] if core[:1] == " " and not core[1:2].isspace() else self.raw[core]
            return before + self.raw[chunk[len(core) :]]
        return self._encode(chunk) if chunk else b""

    def _piece(self, piece: str) -> bytes:
        return self._chunk(piece if piece[:1] == "\n" else " " + piece)

    def _text(self, text: str) -> bytes:
        if OTHER_SPACE.search(text) or self.special.search(text):
            return self._encode(text)
        if any(gap in text for gap in GAPS):
            return b"".join(map(self.raw.__getitem__, CHUNK.findall(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.raw[first] + b"".join(map(self.known.__getitem__, rest))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        return [self._text(t) if t else b"" for t in texts]


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """The worker's encoder: what one task has learnt, the next one on the same worker uses."""
    return Encoder(path)


def batches_of(texts: list[str | None], characters: int = 1 << 21) -> Iterator[tuple[int, list[str | None]]]:
    """Slices of `texts` of about that many characters, each with its place."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= characters:
            yield begin, texts[begin : i + 1]
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, texts[begin:]


def tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, ids (binary, little-endian, 2 bytes an id when the vocabulary allows, else 4), width (bytes an id), n (with the end id)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        width = np.dtype(encoder.dtype).itemsize
        last = np.array([end_id], dtype=encoder.dtype).tobytes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, part in batches_of(texts):
                ids = [x + last for x in encoder(part)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, len(part)), pa.array(ids, pa.binary()), pa.array([width] * len(ids), pa.int32()), pa.array([len(x) // width for x in ids], pa.int64())],
                    ["doc_id", "ids", "width", "n"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(encode, "doc_id long, ids binary, width int, n long")
