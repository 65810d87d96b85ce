"""Count-only Viterbi segmentation under a unigram vocabulary held in a double-array trie.

A text is cut at forced boundaries into segments (see ``bytebpe``), which no token crosses, so its best path is the
concatenation of the segments' best paths and only distinct segments are solved. All segments of a batch advance
together: the trie is walked from every byte at once, and the dynamic programme runs over positions with one array
operation for all segments. Only the path length is kept, never the path.

Ties between equal scores go to the path found first, the one whose last token is longest. Null and empty texts count 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from corpusloom.llm.bytebpe import Fragments, cut_table, read_ranks

#: Segments solved together, in bytes.
CHUNK = 1 << 20


class DoubleArrayTrie:
    """``base[s] + byte`` is the child of ``s`` if ``check`` there is ``s``; ``token`` is -1 where no token ends."""

    def __init__(self, tokens: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for number, token in enumerate(tokens):
            node = 0
            for byte in token:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][byte]
            ends[node] = number
        size = 2 * len(children) + 512
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = bytearray(b"\x01") * size
        free[0] = 0
        place, queue, low = {0: 0}, [0], 1
        for node in queue:
            kids = sorted(children[node].items())
            if not kids:
                continue
            state, first = place[node], kids[0][0]
            at = max(low, first + 1)
            while True:
                at = free.index(1, at)
                if all(free[at - first + byte] for byte, _ in kids):
                    break
                at += 1
            base[state] = at - first
            for byte, child in kids:
                to = at - first + byte
                free[to], check[to], value[to], place[child] = 0, state, ends[child], to
                queue.append(child)
            if len(kids) == 1 and at - low > 4096:
                low = at - 2048  # the region below is nearly full
        used = max(place.values()) + 257
        self.base, self.check, self.token = base[:used].copy(), check[:used].copy(), value[:used].copy()


class UnigramVocabulary:
    def __init__(self, tokens: list[bytes], log_probability: np.ndarray):
        self.score = np.asarray(log_probability, np.float64)
        self.trie = DoubleArrayTrie(tokens)
        self.cut = cut_table(tokens)
        self.longest = max(map(len, tokens))

    @classmethod
    def from_ranks(cls, path: str) -> UnigramVocabulary:
        """The tokens of a rank file, their probabilities by Zipf's law over the ranks."""
        tokens = [token for token, _ in sorted(read_ranks(path).items(), key=lambda item: item[1])]
        weight = 1.0 / (np.arange(len(tokens)) + 2.0)
        return cls(tokens, np.log(weight / weight.sum()))

    def edges(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every token found: its start, its end and its score. ``ends`` gives for each byte the end of its segment."""
        trie, active, state = self.trie, np.arange(len(data)), np.zeros(len(data), np.int32)
        starts, stops, scores = [], [], []
        for depth in range(self.longest):
            inside = active + depth < ends[active]
            active, state = active[inside], state[inside]
            if not len(active):
                break
            to = trie.base[state] + data[active + depth]
            good = trie.check[to] == state
            active, state = active[good], to[good]
            token = trie.token[state]
            is_end = token >= 0
            starts.append(active[is_end])
            stops.append(active[is_end] + depth + 1)
            scores.append(self.score[token[is_end]])
        return np.concatenate(starts), np.concatenate(stops), np.concatenate(scores)

    def lengths(self, segments: pa.Array) -> np.ndarray:
        """Tokens on the best path of each segment; a byte that is no token by itself ends a path and counts 1."""
        offsets = np.frombuffer(segments.buffers()[1], np.int64)[segments.offset : segments.offset + len(segments) + 1]
        sizes, result = np.diff(offsets), np.zeros(len(segments), np.int64)
        order = np.argsort(sizes, kind="stable")
        group = np.cumsum(sizes[order]) // CHUNK
        for part in np.split(order, np.flatnonzero(np.diff(group)) + 1) if len(order) else []:
            data = np.frombuffer(b"".join(segments.take(pa.array(part)).to_pylist()), np.uint8)
            result[part] = self._solve(data, sizes[part])
        return result

    def _solve(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        # A segment of n bytes has n + 1 nodes; node(i) = i + number of its segment.
        if not len(data):
            return np.zeros(len(sizes), np.int64)
        segment = np.repeat(np.arange(len(sizes)), sizes)
        last = np.cumsum(sizes)
        start, stop, score = self.edges(data, last[segment])
        relative = start - (last - sizes)[segment[start]]
        order = np.argsort(relative, kind="stable")
        start, stop, score, relative = start[order] + segment[start[order]], stop[order] + segment[start[order]], score[order], relative[order]
        best, count = np.full(len(data) + len(sizes), -np.inf), np.zeros(len(data) + len(sizes), np.int64)
        first = last - sizes + np.arange(len(sizes))
        best[first] = 0.0
        for a, b in zip(bounds := np.searchsorted(relative, np.arange(relative[-1] + 2)), bounds[1:]) if len(relative) else ():
            s, e = start[a:b], stop[a:b]
            total = best[s] + score[a:b]
            better = total > best[e]
            e = e[better]
            best[e], count[e] = total[better], count[s[better]] + 1
        return count[last + np.arange(len(sizes))]

    def count(self, texts: pa.Array) -> pa.Array:
        parts = Fragments(texts, self.cut)
        return pa.array(parts.per_text(self.lengths(parts.distinct)), pa.int64())
