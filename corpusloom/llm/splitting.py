"""Oversized texts cut into pieces at natural boundaries, with a fixed overlap.

A text of more than ``limit`` tokens is first taken apart into atomic segments: sentences, the words of a sentence
that is too long by itself, and runs of tokens of a word that is. Adjacent segments are merged from a heap, weakest
boundary first (within a word, between words, sentences, lines, paragraphs), then the smaller sum, then the earlier
place, while the merged segment and the overlap before it stay within the limit. A pair that does not fit never will.

Cuts lie where a non-space meets white space, or behind an ideographic full stop. Byte-level BPE always has a token
boundary there, so a piece's tokens are a slice of the text's tokens. Each piece but the first begins with the last
``overlap`` tokens of the one before; its text starts with the first whole character of those.

A text within the limit is one piece; null and empty texts have none; repeated rows have their pieces each.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytebpe import BYTE_BPE_50K, ByteBPE, byte_bpe, ship

PARAGRAPH, LINE, SENTENCE, WORD, INSIDE = 4, 3, 2, 1, 0
BOUNDARIES = ("inside", "word", "sentence", "line", "paragraph", "end")
#: White space, with what stands before it if that ends a sentence; or an ideographic end of sentence.
_BREAK = regex.compile(r"""(?P<end>[.!?…؟۔;:][\p{Pe}\p{Pf}"']*)?(?P<space>\s+)|[。！？][\p{Pe}\p{Pf}"']*""")


def breaks(text: str) -> tuple[list[int], list[int]]:
    """Character positions at which ``text`` may be cut, with the strength of each."""
    at, strength = [], []
    for m in _BREAK.finditer(text):
        space = m["space"]
        place = m.start("space") if space else m.end()
        if 0 < place < len(text):
            lines = space.count("\n") if space else 0
            kind = PARAGRAPH if lines > 1 else LINE if lines else SENTENCE if not space or m["end"] and m["end"][0] not in ";:" else WORD
            if at and at[-1] == place:
                strength[-1] = max(strength[-1], kind)
            else:
                at.append(place)
                strength.append(kind)
    return at, strength


def agglomerate(sizes: list[int], strength: list[int], limit: int, overlap: int) -> list[int]:
    """Indices of the segments with which pieces begin. ``strength[i]`` is that of the boundary before segment i."""
    n = len(sizes)
    sizes, after, before = list(sizes), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(strength[i], sizes[i - 1] + sizes[i], i - 1, i) for i in range(1, n)]
    heapq.heapify(heap)
    while heap:
        _, total, left, right = heapq.heappop(heap)
        if not (alive[left] and alive[right]) or total != sizes[left] + sizes[right]:
            continue
        if total + (overlap if left else 0) > limit:
            continue
        sizes[left], alive[right] = total, False
        after[left] = nxt = after[right]
        if nxt < n:
            before[nxt] = left
            heapq.heappush(heap, (strength[nxt], total + sizes[nxt], left, nxt))
        if left:
            heapq.heappush(heap, (strength[left], sizes[before[left]] + total, before[left], left))
    return [i for i in range(n) if alive[i]]


def cut_points(text: str, ends: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int]]:
    """Token index and boundary strength with which each piece of an oversized text begins.

    ``ends`` holds the byte offset behind each token.
    """
    room, n = limit - overlap, len(ends)
    at, kind = breaks(text)
    raw = np.frombuffer(text.encode(), np.uint8)
    first_bytes = np.flatnonzero((raw & 0xC0) != 0x80)  # of each character
    token = np.searchsorted(ends, first_bytes[at], side="left") + 1 if at else np.zeros(0, np.int64)
    exact = ends[token - 1] == first_bytes[at] if at else np.zeros(0, bool)
    token, kind = token[exact], np.asarray(kind, np.int64)[exact]

    begins, strengths = [0], [PARAGRAPH]
    strong = np.append(np.flatnonzero(kind >= SENTENCE), len(token))
    low = 0
    for high in strong:  # candidates low..high-1 are words inside the sentence that ends at candidate high
        stop = int(token[high]) if high < len(token) else n
        if stop - begins[-1] > room:
            for w in [*range(low, high), high]:
                place = int(token[w]) if w < len(token) else n
                while place - begins[-1] > room:
                    begins.append(_whole_character(raw, ends, begins[-1] + room, begins[-1]))
                    strengths.append(INSIDE)
                if w < high and place > begins[-1]:
                    begins.append(place)
                    strengths.append(WORD)
        if stop < n and stop > begins[-1]:
            begins.append(stop)
            strengths.append(int(kind[high]))
        low = high + 1
    sizes = np.diff([*begins, n]).tolist()
    return [(begins[i], strengths[i]) for i in agglomerate(sizes, strengths, limit, overlap)]


def _whole_character(raw: np.ndarray, ends: np.ndarray, token: int, after: int) -> int:
    """The last token index up to ``token`` at which a character begins."""
    at = token
    while at > after + 1 and (raw[ends[at - 1]] & 0xC0) == 0x80:
        at -= 1
    return at


def _pieces(bpe: ByteBPE, sizes: np.ndarray, text: str, limit: int, overlap: int):
    """Begin and end of each piece in tokens (its overlap included), its overlap, the kind of its end and its text."""
    ids = bpe.encode(pa.array([text])).values.to_numpy()
    ends = np.cumsum(sizes[ids])
    starts = cut_points(text, ends, limit, overlap)
    raw = text.encode()
    for i, (begin, _) in enumerate(starts):
        stop, kind = starts[i + 1] if i + 1 < len(starts) else (len(ids), 5)
        shared = min(overlap, begin)
        first = int(ends[begin - shared - 1]) if begin > shared else 0
        yield begin - shared, stop, shared, BOUNDARIES[kind], raw[first : int(ends[stop - 1])].decode(errors="ignore")


def split_oversized(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, overlap: int = 128, path: str = BYTE_BPE_50K, with_text: bool = True
) -> DataFrame:
    """The pieces of every text: ``id, piece_no`` (from 1), ``n_pieces, begin_token, end_token, n_tokens,
    overlap_tokens, ends_at`` and, if wanted, ``piece_text``. The module's text says how."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    ship(documents.sparkSession, path)
    id_type = documents.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, piece_no int, n_pieces int, begin_token int, end_token int, n_tokens int, overlap_tokens int, ends_at string"
    schema += ", piece_text string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        sizes = bpe.sizes
        for batch in batches:
            counts = bpe.count(batch.column(1)).to_numpy()
            fits = np.flatnonzero((counts > 0) & (counts <= limit))
            one, n = np.ones(len(fits), np.int32), counts[fits].astype(np.int32)
            small = batch.take(pa.array(fits))
            columns = [small.column(0), one, one, 0 * one, n, n, 0 * one, pa.array(["end"] * len(fits), pa.string())] + [small.column(1)] * with_text
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)
            rows = []
            for i in np.flatnonzero(counts > limit).tolist():
                key, parts = batch.column(0)[i].as_py(), list(_pieces(bpe, sizes, batch.column(1)[i].as_py(), limit, overlap))
                for k, (begin, stop, shared, kind, text) in enumerate(parts, 1):
                    rows.append((key, k, len(parts), begin, stop, stop - begin, shared, kind, *[text] * with_text))
            if rows:
                types = [batch.column(0).type, *[pa.int32()] * 6, *[pa.string()] * (1 + with_text)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = [part.split()[0] for part in schema.split(", ")]
    pieces = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    return pieces.withColumnRenamed("id", id_col)
