"""External scorers: a contract, and deterministic stand-ins without a model.

A scorer maps a batch of pairs to scores. Batches reach it sorted by length, as padding costs most with mixed lengths,
and its results return in the rows' own order. A batch that fails is split until single rows fail, which score null.
"""

from __future__ import annotations

import time
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[list[str], list[str]], list[float | None]]


def call_split(scorer: Scorer, sources: list[str], targets: list[str]) -> list[float | None]:
    try:
        out = scorer(sources, targets)
        if len(out) != len(sources):
            raise ValueError("a scorer must return one score a pair")
        return list(out)
    except Exception:
        if len(sources) == 1:
            return [None]
        half = len(sources) // 2
        return call_split(scorer, sources[:half], targets[:half]) + call_split(scorer, sources[half:], targets[half:])


class RateLimit:
    """At most ``calls`` calls within any ``seconds``, for one task. A limit for a whole job is divided by its tasks
    first (``share``), as tasks don't know of each other."""

    def __init__(self, calls: int, seconds: float = 60.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.calls, self.seconds, self.clock, self.sleep = max(1, calls), seconds, clock, sleep
        self.times: deque[float] = deque()

    @staticmethod
    def share(calls: int, tasks: int) -> int:
        return max(1, calls // max(1, tasks))

    def wait(self) -> None:
        while True:
            now = self.clock()
            while self.times and now - self.times[0] >= self.seconds:
                self.times.popleft()
            if len(self.times) < self.calls:
                self.times.append(now)
                return
            self.sleep(self.seconds - (now - self.times[0]))


class Refused(Exception):
    """The service won't answer this batch at all (its content is filtered), so repeating it is of no use."""


def patient(scorer: Scorer, limit: RateLimit | None = None, attempts: int = 5, first_wait: float = 1.0, longest_wait: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Scorer:
    """A scorer that keeps to a rate and repeats failed calls, waiting twice as long each time. A ``Refused`` batch
    fails at once, so that ``call_split`` can look for the pair that it is refused for."""

    def call(sources: list[str], targets: list[str]) -> list[float | None]:
        for attempt in range(attempts):
            if limit is not None:
                limit.wait()
            try:
                return scorer(sources, targets)
            except Refused:
                raise
            except Exception:
                if attempt == attempts - 1:
                    raise
                sleep(min(longest_wait, first_wait * 2**attempt))
        return []

    return call


Labeller = Callable[[list[str]], list[tuple[str | None, float | None]]]


def label_texts(rows: DataFrame, text: str, make: Callable[[], Labeller], label: str, confidence: str, batch: int = 1000) -> DataFrame:
    """``rows`` with a language label and its confidence from a model, which ``make`` builds once per task. Null and
    blank texts are not sent and have neither; input columns stay."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = make()
        for texts in batches:
            given = texts.to_pylist()
            todo = [i for i, t in enumerate(given) if t is not None and t.strip()]
            found: list[dict | None] = [None] * len(given)
            for a in range(0, len(todo), batch):
                part = todo[a : a + batch]
                for i, (name, p) in zip(part, labeller([given[i] for i in part])):
                    found[i] = {"label": name, "confidence": p}
            yield pa.array(found, pa.struct([("label", pa.string()), ("confidence", pa.float64())]))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    labelled = rows.withColumn("_l", F.arrow_udf(run, "label string, confidence double")(F.col(text)))
    return labelled.withColumn(label, F.col("_l.label")).withColumn(confidence, F.col("_l.confidence")).drop("_l")


#: The labels of the stand-in for a language model, by the range of code points that most letters lie in.
STANDIN_RANGES = {"ell_Grek": (0x370, 0x3FF), "rus_Cyrl": (0x400, 0x4FF), "arb_Arab": (0x600, 0x6FF), "zho_Hans": (0x4E00, 0x9FFF)}


def script_labeller() -> Labeller:
    """Stand-in for a language model: the script that most characters beyond ASCII are of, else English, with its share
    of the letters."""

    def label(texts: list[str]) -> list[tuple[str | None, float | None]]:
        out = []
        for text in texts:
            letters = [ord(c) for c in text if c.isalpha()]
            counts = {name: sum(a <= p <= b for p in letters) for name, (a, b) in STANDIN_RANGES.items()}
            counts["eng_Latn"] = sum(p < 0x250 for p in letters)
            best = max(sorted(counts), key=counts.__getitem__)
            out.append((best, counts[best] / len(letters)) if letters else (None, None))
        return out

    return label


def score_pairs(rows: DataFrame, source: str, target: str, make: Callable[[], Scorer], out: str, batch: int = 256) -> DataFrame:
    """``rows`` with the scorer's result; input columns stay. Pairs with a null text score null without being sent.
    ``make`` builds the scorer once per task, so that a model is loaded on the executor."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        scorer = make()
        for sources, targets in batches:
            s, t = sources.to_pylist(), targets.to_pylist()
            todo = sorted((i for i in range(len(s)) if s[i] is not None and t[i] is not None), key=lambda i: len(s[i]) + len(t[i]))
            found: list[float | None] = [None] * len(s)
            for a in range(0, len(todo), batch):
                part = todo[a : a + batch]
                for i, v in zip(part, call_split(scorer, [s[i] for i in part], [t[i] for i in part])):
                    found[i] = v
            yield pa.array(found, pa.float64())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return rows.withColumn(out, F.arrow_udf(run, "double")(F.col(source), F.col(target)))


def hashed_vector(text: str, size: int = 64) -> np.ndarray:
    """Stand-in for a sentence embedding: counts of hashed character trigrams, of length 1."""
    v = np.zeros(size)
    padded = f"  {text.lower()} "
    for i in range(len(padded) - 2):
        v[zlib.crc32(padded[i : i + 3].encode()) % size] += 1
    return v / max(float(np.linalg.norm(v)), 1e-9)


def trigram_scorer() -> Scorer:
    """Stand-in for a similarity model: cosine of hashed trigrams."""
    return lambda sources, targets: [float(hashed_vector(s) @ hashed_vector(t)) for s, t in zip(sources, targets)]


def seen_flags(rows: DataFrame, support: DataFrame, model: str, source_lang: str, target_lang: str) -> DataFrame:
    """``rows`` with ``src_seen`` and ``tgt_seen`` from a table of ``model, lang, seen``; null means unknown.

    ``support`` is joined by the size Spark knows for it."""
    for side, lang in (("src", source_lang), ("tgt", target_lang)):
        s = support.select(F.col("model").alias("_m"), F.col("lang").alias("_l"), F.col("seen").alias(f"{side}_seen")).dropDuplicates(["_m", "_l"])
        rows = rows.join(s, (F.col(model) == F.col("_m")) & (F.col(lang) == F.col("_l")), "left").drop("_m", "_l")
    return rows


def reassign_large(rows: DataFrame, winner: str, prefix: str, other: str, default: str, size: Column, threshold: int, supported: Column, gap: Column, most_gap: float) -> DataFrame:
    """``rows`` with the model that scores a direction won by a model named ``prefix...``: ``other`` where the direction
    has more than ``threshold`` rows and ``other`` supports it or is within ``most_gap`` of the winner, else ``default``.
    Directions won by others, or by nobody, stay. A null size or gap counts as not fulfilled."""
    large = F.coalesce(size > threshold, F.lit(False))
    fits = F.coalesce(supported, F.lit(False)) | F.coalesce(F.abs(gap) < most_gap, F.lit(False))
    chosen = F.when(F.col(winner).startswith(prefix), F.when(large & fits, other).otherwise(default)).otherwise(F.col(winner))
    return rows.withColumn(winner, chosen)


def lookup_winner(rows: DataFrame, table: DataFrame, direction: str, fallback: str, sentences: str | None = None, rates: dict[str, float] | None = None) -> DataFrame:
    """``rows`` with ``winner_model`` of their direction (names trimmed), or the fallback, and the hours it would take."""
    known = table.groupBy(F.trim("direction_key").alias("_d")).agg(F.min(F.trim("winner_model")).alias("_w"))
    out = rows.join(known, F.col(direction) == F.col("_d"), "left").withColumn("winner_model", F.coalesce(F.nullif("_w", F.lit("")), F.lit(fallback))).drop("_d", "_w")
    if sentences and rates:
        rate = F.lit(None).cast("double")
        for m, r in rates.items():
            rate = F.when(F.col("winner_model") == m, float(r)).otherwise(rate)
        out = out.withColumn("est_hours", F.col(sentences) / rate)
    return out
