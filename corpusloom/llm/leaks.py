"""Test passages in a corpus, by pigeonhole edit matching.

Texts are compared after NFC, lower case and removal of everything but letters and numbers. A corpus text leaks an item
if it holds some passage of ``window`` characters of the item with at most ``errors`` edits (the whole item if it is
shorter, with a budget in proportion, rounded down).

Items are cut into consecutive blocks short enough that any passage contains ``errors + 1`` of them, so with that many
edits one block is there letter for letter. An Aho-Corasick automaton finds all blocks in a text. A hit goes on if the
characters next to the block can continue it, and is then verified with Myers' bit-parallel edit distance, run from
the block to both sides for all hits of a batch at once: the farthest that 0, 1, .. edits reach to the left and to the
right. A passage is there if the block and both reaches make up its length within the budget.

The corpus is read once for each block of test items that fits ``BLOCK_CHARS``; only such a block is broadcast.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.storage import materialize

#: Most normalised characters of test items that are broadcast at a time. Blocks hold about half of it, for which a
#: worker's automaton takes about 55 bytes a character, 220 MB.
BLOCK_CHARS = 8_000_000
#: Hits verified together.
CHUNK = 200_000


class _Keep(dict):
    def __missing__(self, point: int):
        self[point] = kept = point if unicodedata.category(chr(point))[0] in "LN" else None
        return kept


_KEEP = _Keep()


def normalise(text: str | None) -> str:
    """NFC, lower case, letters and numbers only; of null the empty text."""
    return unicodedata.normalize("NFC", text or "").lower().translate(_KEEP)


def block_length(window: int, errors: int) -> int:
    """The longest q of which any ``window`` characters contain ``errors + 1`` whole blocks."""
    return (window + 1) // (errors + 2)


class Items:
    """Normalised test items, their blocks and the automaton over them."""

    def __init__(self, texts: list[str], window: int, errors: int):
        import ahocorasick

        self.texts, self.window = texts, window
        self.length = np.array([len(t) for t in texts], np.int64)
        self.need = np.minimum(self.length, window)
        self.budget = np.minimum(errors, errors * self.length // window)
        # Padded by a window of a character that no text has, so that reaches stop at an item's ends.
        self.pad = window + errors + 1
        self.begin = np.cumsum(self.length + self.pad) - self.length
        self.points = np.full(int((self.length + self.pad).sum()) + self.pad, 0xFFFFFFFF, np.uint32)
        places: dict[str, list[tuple[int, int, int]]] = {}
        for i, text in enumerate(texts):
            self.points[self.begin[i] : self.begin[i] + len(text)] = _points(text)
            whole = len(text) < window
            q = len(text) // (int(self.budget[i]) + 1) if whole else block_length(window, int(self.budget[i]))
            count = int(self.budget[i]) + 1 if whole else len(text) // q
            for k in range(count):
                places.setdefault(text[k * q : k * q + q], []).append((i, k * q, q))
        self.automaton = ahocorasick.Automaton()
        for number, block in enumerate(places):
            self.automaton.add_word(block, number)
        if places:
            self.automaton.make_automaton()
        flat = [p for ps in places.values() for p in ps]
        self.item, self.at, self.q = (np.array([p[c] for p in flat], np.int64) for c in range(3))
        sizes = np.array([len(ps) for ps in places.values()], np.int64)
        self.first, self.count = np.cumsum(sizes) - sizes, sizes


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _reach(pattern: np.ndarray, p0: np.ndarray, step: int, text: np.ndarray, t0: np.ndarray, far: int, errors: int) -> np.ndarray:
    """How many pattern characters from ``p0`` on (in direction ``step``) match text from ``t0`` on with e edits.

    Column e of the result has the greatest i with distance(pattern[:i], text[:j]) <= e for some j. Myers' vertical
    deltas of all pairs advance together, one text character at a time; ``far`` <= 63 pattern characters are looked at.
    """
    n, one = len(p0), np.uint64(1)
    rows = pattern[p0[:, None] + step * np.arange(far)[None, :]]  # n x far
    full = np.uint64((1 << far) - 1)
    up, down = np.full(n, full, np.uint64), np.zeros(n, np.uint64)
    best = np.zeros((n, errors + 1), np.int64)
    weights = one << np.arange(far, dtype=np.uint64)
    for e in range(errors + 1):
        best[:, e] = min(e, far)  # e pattern characters deleted
    for j in range(1, far + errors + 1):
        char = text[t0 + step * (j - 1)]
        equal = ((rows == char[:, None]) * weights).sum(axis=1, dtype=np.uint64)
        vertical = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        plus, minus = down | ~(diagonal | up), up & diagonal
        plus, minus = (plus << one) | one, minus << one  # the row above the first grows by one a column
        up, down = (minus | ~(vertical | plus)) & full, plus & vertical & full
        for i in range(max(1, j - errors), min(far, j + errors) + 1):
            mask = np.uint64((1 << i) - 1)
            distance = j + np.bitwise_count(up & mask).astype(np.int64) - np.bitwise_count(down & mask).astype(np.int64)
            for e in range(errors + 1):
                np.maximum(best[:, e], np.where(distance <= e, i, 0), out=best[:, e])
    return best


def _matches(found: Items, doc: np.ndarray, at: np.ndarray, block: np.ndarray, points: np.ndarray, errors: int) -> tuple[np.ndarray, ...]:
    """Of hits (document, place of the block's begin in ``points``, number of the place in the items) those verified:
    document, item, fewest edits."""
    out = []
    for a in range(0, len(doc), CHUNK):
        d, t, b = doc[a : a + CHUNK], at[a : a + CHUNK], block[a : a + CHUNK]
        item, q = found.item[b], found.q[b]
        p, need, budget = found.begin[item] + found.at[b], found.need[item], found.budget[item]
        far = int(min(63, (need - q).max())) if len(q) else 0
        if far:
            # The cheap test: how far both sides go without an edit. With no edit left over that must suffice.
            left = _run(found.points, p - 1, -1, points, t - 1, far)
            right = _run(found.points, p + q, 1, points, t + q, far)
            exact = left + q + right >= need
            more = ~exact & (budget > 0) & _may_go_on(found.points, p, q, points, t, left, right, need, errors)
            edits = np.where(exact, 0, -1)
            w = np.flatnonzero(more)
            if len(w):
                lefts = _reach(found.points, p[w] - 1, -1, points, t[w] - 1, far, errors)
                rights = _reach(found.points, p[w] + q[w], 1, points, t[w] + q[w], far, errors)
                # Reaches end at the item's ends, but for deletions beyond them.
                lefts = np.minimum(lefts, found.at[b[w]][:, None])
                rights = np.minimum(rights, (found.length[item[w]] - found.at[b[w]] - q[w])[:, None])
                for e in range(errors, 0, -1):
                    for x in range(e + 1):
                        ok = (lefts[:, x] + q[w] + rights[:, e - x] >= need[w]) & (e <= budget[w])
                        edits[w[ok]] = e
        else:
            edits = np.zeros(len(d), np.int64)
        ok = edits >= 0
        out.append((d[ok], item[ok], edits[ok]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _run(pattern: np.ndarray, p: np.ndarray, step: int, text: np.ndarray, t: np.ndarray, far: int) -> np.ndarray:
    length, alive = np.zeros(len(p), np.int64), np.arange(len(p))
    for i in range(far):
        alive = alive[pattern[p[alive] + step * i] == text[t[alive] + step * i]]
        if not len(alive):
            break
        length[alive] = i + 1
    return length


def _may_go_on(pattern, p, q, text, t, left, right, need, errors) -> np.ndarray:
    """False only where no passage can be there: with edits, some stretch of the missing part must match.

    Of a passage with 1 to ``errors`` edits at least one side beyond the exact run is ``far`` characters or more, cut
    by the edits into ``errors + 1`` parts, and the longest of these matches on a diagonal at most ``errors`` away.
    For the test the ``s`` characters behind the first edit are compared: if they match on no diagonal and neither do
    the next ones, for as many stretches as there are edits, both sides are at their end.
    """
    missing = need - q - left - right
    s = 4
    going = missing <= (errors + 1) * (s + 1)
    for step, p0, t0 in ((1, p + q + right, t + q + right), (-1, p - 1 - left, t - 1 - left)):
        # Behind a first edit, each further edit can spoil one stretch; there are ``errors`` stretches to try.
        for k in range(errors):
            for shift in range(-errors, errors + 1):
                start = 1 + k * (s + 1)
                same = np.ones(len(p), bool)
                for i in range(s):
                    same &= pattern[p0 + step * (start + i)] == text[t0 + step * (start + i + shift)]
                going = going | same
    return going


@F.arrow_udf(StringType())
def _clean(texts: pa.Array) -> pa.Array:
    return pa.array([normalise(t) for t in texts.to_pylist()], pa.string())


@lru_cache(maxsize=1)  # a worker holds one block's automaton at a time
def _items(texts: tuple[str, ...], window: int, errors: int) -> Items:
    return Items(list(texts), window, errors)


def find_leaks(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 60, errors: int = 1, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, item_id, edits`` of every document and item that it leaks, with the fewest edits of any passage.

    Items that are null, empty or without letters and numbers leak nowhere; equal items under different ids are each
    reported, repeated item rows once, repeated document rows each. Columns of other names don't matter.
    """
    if not 0 <= errors <= 3 or not 2 * (errors + 2) <= window <= 63 + block_length(window, errors):
        raise ValueError("0 to 3 edits, in windows of up to about 80 characters")
    spark = documents.sparkSession
    known = materialize(items.select(F.col(item_id).alias("item"), _clean(F.col(item_text)).alias("t")).filter("t != ''").distinct(), "leak-items")
    total = known.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(2 * total / block_chars))
    id_type = documents.schema[doc_id].dataType.simpleString()
    corpus = documents.select(F.col(doc_id).alias("d"), F.col(doc_text).alias("t"))
    results = []
    for part in range(parts):
        texts = tuple(sorted(r.t for r in known.filter(F.pmod(F.xxhash64("t"), F.lit(parts)) == part).select("t").distinct().collect()))
        shared = spark.sparkContext.broadcast(texts)
        hits = corpus.mapInArrow(_scan(shared, window, errors), f"d {id_type}, t string, edits int")
        if parts > 1:  # its block can go before the next one comes
            hits = materialize(hits, "leak-hits")
            shared.destroy()
        results.append(hits)
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    return found.join(known, "t").select(F.col("d").alias(doc_id), F.col("item").alias(item_id), "edits")


def _scan(shared, window: int, errors: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(shared.value, window, errors)
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                doc, item, edits = _scan_batch(items, batch.column(1), errors)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array([items.texts[i] for i in item], pa.string()), pa.array(edits.astype(np.int32))], ["d", "t", "edits"]
                )

    return run


def _scan_batch(items: Items, texts: pa.Array, errors: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, item and fewest edits of every leak in a batch of texts."""
    none = (np.zeros(0, np.int64),) * 3
    if not items.texts:
        return none
    clean = [normalise(t) for t in texts.to_pylist()]
    length = np.array([len(t) for t in clean], np.int64)
    begin = np.cumsum(length + items.pad) - length
    points = np.full(int((length + items.pad).sum()) + items.pad, 0xFFFFFFFE, np.uint32)
    row, stop, block = [], [], []
    for i, text in enumerate(clean):
        if text:
            points[begin[i] : begin[i] + len(text)] = _points(text)
            for end, number in items.automaton.iter(text):
                row.append(i)
                stop.append(end)
                block.append(number)
    if not row:
        return none
    row, stop, block = (np.array(x, np.int64) for x in (row, stop, block))
    # A block that several items share stands for a place in each.
    each = items.count[block]
    place = np.repeat(items.first[block], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    row, stop = np.repeat(row, each), np.repeat(stop, each)
    row, item, edits = _matches(items, row, begin[row] + stop + 1 - items.q[place], place, points, errors)
    key = row * len(items.texts) + item
    order = np.lexsort((edits, key))
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    order = order[first]
    return row[order], item[order], edits[order]
