"""Byte-level BPE over whole columns by forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary can never be merged, so every text may be cut there and the
fragments encoded on their own. The cut must also leave the pre-tokeniser's pieces as they are. For the splitting
pattern below that holds when the byte on the left is no white space and neither byte is an apostrophe: white space is
the only thing the pattern looks ahead for or attaches to the next piece, and apostrophes open contractions. Any other
place either lies on a piece boundary or inside a run of one class, and a run continues as a run after a cut.

A batch of texts is cut with one table lookup per byte, its fragments are dictionary-encoded by Arrow, only distinct
fragments are encoded, and ids are gathered back with numpy.

Null and empty texts have the ids ``[]`` and count 0.
"""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import SparkSession

#: Fixed value: the pattern that belongs to the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BYTE_BPE_50K = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
#: Fragments remembered by a Python worker, and the longest that is remembered.
REMEMBERED, REMEMBERED_BYTES = 150_000, 48


def ship(spark: SparkSession | None, path: str) -> None:
    """Send a vocabulary file with the session's jobs, for executors on machines that don't have it."""
    if spark is not None:
        spark.sparkContext.addFile(path)


def _local(path: str) -> str:
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(_local(path), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def cut_table(tokens) -> np.ndarray:
    """For each pair ``left * 256 + right`` of bytes, whether a text may be cut between the two."""
    inside = np.zeros(65536, bool)
    for token in tokens:
        if len(token) > 1:
            b = np.frombuffer(token, np.uint8).astype(np.int32)
            inside[b[:-1] * 256 + b[1:]] = True
    cut = ~inside.reshape(256, 256)
    for left in (*range(9, 14), *range(28, 33), 0x27):
        cut[left] = False
    cut[:, 0x27] = False
    cut[:, 0x80:0xC0] = False  # inside a character
    return cut.reshape(65536)


def after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position in ``at`` is white space beyond ASCII."""
    p1, p2, p3 = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    two = (p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))
    general = (p3 == 0xE2) & (p2 == 0x80) & ((p1 <= 0x8A) | (p1 == 0xA8) | (p1 == 0xA9) | (p1 == 0xAF))
    other = ((p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)) | ((p3 == 0xE1) & (p2 == 0x9A) & (p1 == 0x80))
    return two | general | other | ((p3 == 0xE3) & (p2 == 0x80) & (p1 == 0x80))


class Fragments:
    """The texts of a batch cut at forced boundaries: distinct fragments, and which of them each text consists of."""

    def __init__(self, texts: pa.Array, cut: np.ndarray):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, last = int(offsets[0]), int(offsets[-1])
        body = texts.buffers()[2]
        self.data = np.frombuffer(body, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
        self.text_offsets = offsets - first
        n = last - first
        starts = np.zeros(n + 1, bool)
        if n > 1:
            pairs = self.data[:-1].astype(np.uint16)
            pairs <<= 8
            pairs |= self.data[1:]
            at = np.flatnonzero(cut[pairs]) + 1
            wide = np.flatnonzero(self.data[at - 1] >= 0x80)
            at = np.delete(at, wide[after_wide_space(self.data, at[wide])])
            starts[at] = True
        starts[self.text_offsets] = True
        self.starts = np.flatnonzero(starts)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.starts) - 1, [None, pa.py_buffer(self.starts.astype(np.int64)), pa.py_buffer(self.data)]
        ) if n else pa.array([], pa.large_binary())
        coded = pieces.dictionary_encode()
        self.distinct: pa.Array = coded.dictionary
        self.index: np.ndarray = coded.indices.to_numpy(zero_copy_only=False)
        self.first_piece = np.searchsorted(self.starts, self.text_offsets)

    def per_text(self, of_distinct: np.ndarray) -> np.ndarray:
        """Sum of a value of the distinct fragments over the fragments of each text."""
        sums = np.zeros(len(self.index) + 1, np.int64)
        np.cumsum(of_distinct[self.index], out=sums[1:])
        return sums[self.first_piece[1:]] - sums[self.first_piece[:-1]]


class ByteBPE:
    def __init__(self, path: str = BYTE_BPE_50K):
        import tiktoken

        ranks = read_ranks(path)
        self.encoding = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cut = cut_table(ranks)
        self.longest = max(map(len, ranks))
        self.sizes = np.zeros(self.encoding.n_vocab, np.int64)  # of each token in bytes
        for token, number in ranks.items():
            self.sizes[number] = len(token)
        self.known: dict[bytes, tuple[int, ...]] = {}

    def _ids(self, fragments: list[bytes]) -> list[tuple[int, ...]]:
        known, encode, found = self.known, self.encoding.encode_ordinary, []
        for fragment in fragments:
            ids = known.get(fragment)
            if ids is None:
                ids = tuple(encode(fragment.decode()))
                if len(fragment) <= REMEMBERED_BYTES and len(known) < REMEMBERED:
                    known[fragment] = ids
            found.append(ids)
        return found

    def encode(self, texts: pa.Array) -> pa.ListArray:
        parts = Fragments(texts, self.cut)
        ids = self._ids(parts.distinct.to_pylist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for one in ids for i in one), np.int32, int(lengths.sum()))
        begins = np.cumsum(lengths) - lengths
        each = lengths[parts.index]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        gathered = flat[np.repeat(begins[parts.index] - (ends - each), each) + np.arange(total)]
        bounds = np.zeros(len(each) + 1, np.int64)
        bounds[1:] = ends
        return pa.ListArray.from_arrays(pa.array(bounds[parts.first_piece].astype(np.int32)), pa.array(gathered, pa.int32()))

    def count(self, texts: pa.Array) -> pa.Array:
        parts = Fragments(texts, self.cut)
        ids = self._ids(parts.distinct.to_pylist())
        return pa.array(parts.per_text(np.fromiter(map(len, ids), np.int64, len(ids))), pa.int64())


@cache
def byte_bpe(path: str = BYTE_BPE_50K) -> ByteBPE:
    """One encoder per process and file."""
    return ByteBPE(path)
