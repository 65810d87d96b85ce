"""Languages of texts and of the stretches of mixed ones.

Model: multinomial naive Bayes over hashed character n-grams (1 to 4 characters, words padded by spaces). It is fitted
on a bounded sample of labelled texts, twice: labels that the first model doesn't find again are left out of the second.
Its log-probability matrix (languages x buckets, float32) is broadcast.

Segments: a text is taken as a row of words, runs of ideographs, Latin, and so on. Each has its log-probabilities under
all languages, summed over its n-grams in numpy for a whole batch. The best path through the words pays for a change of
language: little behind the end of a sentence, more at a change of script or behind a dash or a bracket, and much
elsewhere, so that names and single foreign words don't split a sentence. A segment is a longest stretch of one language on that path. Words
without letters belong to the stretch they stand in.

Null, empty and wordless texts have no segment. Ties between languages go to the one first in alphabetical order.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Labelled texts used for each language, the longest text used, and the texts whose n-grams are held at once.
SAMPLE_PER_LANGUAGE, SAMPLE_CHARS, FIT_TEXTS = 3000, 2000, 2000
#: Languages a model may have: each costs 0.5 MB of the broadcast matrix.
MOST_LANGUAGES = 256
BUCKET_BITS, ORDERS = 17, (1, 2, 3, 4)
#: Cost in nats of a change of language behind a sentence, at a weak boundary, and anywhere else.
CHANGE_SENTENCE, CHANGE_WEAK, CHANGE_INSIDE = 4.0, 25.0, 60.0
_WORD = regex.compile(r"\p{Han}+|(?:(?!\p{Han})[\p{L}\p{M}])+(?:['’](?:(?!\p{Han})[\p{L}\p{M}])+)*")
_END = regex.compile(r"[.!?…;؟۔](?=[\p{P}\p{S}]*(?:\s|$))|[。！？]|\n")
_WEAK = regex.compile(r"[()\[\]«»“”\"|/♪–—\t]|\s\s")
#: Markup, entities, placeholders and addresses are no words.
_MARKUP = regex.compile(r"</?[A-Za-z][^<>]*>|&(?:[A-Za-z]+|#\d+);|%(?:\d+\$)?[-+0-9.]*[A-Za-z]\b|\$?\{[^{}]*\}|https?://\S+|www\.\S+|\S+@\S+\.\S+")
_SCRIPTS = [regex.compile(p) for p in (r"\p{Latin}", r"\p{Cyrillic}", r"\p{Greek}", r"\p{Han}", r"\p{Arabic}")]


def _script(char: str) -> int:
    for number, pattern in enumerate(_SCRIPTS):
        if pattern.match(char):
            return number
    return len(_SCRIPTS)


def _blank(match) -> str:
    return " " * len(match[0])


class Words:
    """The words of a batch of texts, with the kind of boundary before each: 0 first or end of sentence, 1 weak, 2 none."""

    def __init__(self, texts: list[str | None]):
        words, text_of, kind, begin, end = [], [], [], [], []
        scripts: dict[str, int] = {}
        for t, text in enumerate(texts):
            if not text:
                continue
            text = _MARKUP.sub(_blank, unicodedata.normalize("NFC", text))
            last, last_script = 0, -1
            for m in _WORD.finditer(text):
                first = m[0][0]
                script = scripts.get(first)
                if script is None:
                    script = scripts[first] = _script(first)
                if last_script < 0:
                    boundary = 0
                else:
                    between = text[last : m.start()]
                    if between == " ":
                        boundary = 2
                    elif _END.search(between):
                        boundary = 0
                    else:
                        boundary = 1 if _WEAK.search(between) else 2
                    if boundary == 2 and script != last_script:
                        boundary = 1
                words.append(m[0])
                text_of.append(t)
                kind.append(boundary)
                begin.append(m.start())
                end.append(m.end())
                last, last_script = m.end(), script
        self.words, self.text_of, self.kind = words, np.array(text_of, np.int64), np.array(kind, np.int8)
        self.begin, self.end = np.array(begin, np.int64), np.array(end, np.int64)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and for each the number of its word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer((" " + " ".join(words).lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = points == 32
    number = np.cumsum(space) - 1  # a space belongs to the word behind it
    mixed, buckets, owners = np.zeros(len(points), np.uint64), [], []
    crossed = np.zeros(len(points), bool)  # a space inside, not at either end
    for n in range(1, max(ORDERS) + 1):
        size = len(points) - n + 1
        if size <= 0:
            break
        mixed = (mixed[:size] * np.uint64(0x100000001B3)) ^ (points[n - 1 :] + np.uint64(1))
        if n > 2:
            crossed = crossed[:size] | space[n - 2 : n - 2 + size]
        if n in ORDERS:
            good = ~crossed[:size] if n > 1 else ~space[:size]
            if n == 2:
                good = good & ~(space[:size] & space[1 : 1 + size])
            hashed = mixed[good] * np.uint64(0x9E3779B97F4A7C15)
            buckets.append((hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
            owners.append(np.minimum(number[:size][good], len(words) - 1))
    return np.concatenate(buckets), np.concatenate(owners)


class NaiveBayes:
    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = 0.05):
        self.languages = languages
        weighted = counts + smoothing
        # buckets x languages, so that a lookup reads one row
        self.log_p = np.log(weighted / weighted.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()

    def word_scores(self, words: list[str], step: int = 50_000) -> np.ndarray:
        """Log-probabilities, words x languages. Distinct words are scored once; an n-gram of length n weighs alike."""
        distinct = {}
        index = np.fromiter((distinct.setdefault(w, len(distinct)) for w in words), np.int64, len(words))
        listed = list(distinct)
        scores = np.zeros((len(listed), len(self.languages)), np.float64)
        for a in range(0, len(listed), step):
            bucket, owner = grams(listed[a : a + step])
            order = np.argsort(owner, kind="stable")
            first = np.flatnonzero(np.diff(owner[order], prepend=-1))
            scores[a + owner[order][first]] = np.add.reduceat(self.log_p[bucket[order]], first, axis=0)
        return scores[index]

    def path(self, words: Words, scores: np.ndarray) -> np.ndarray:
        """The best language of each word; all texts of the batch advance together, one word at a time."""
        n, count = len(words.words), len(self.languages)
        best_language = np.zeros(n, np.int64)
        if not n:
            return best_language
        cost = np.array([CHANGE_SENTENCE, CHANGE_WEAK, CHANGE_INSIDE])[words.kind]
        starts = np.flatnonzero(np.diff(words.text_of, prepend=-1))
        sizes = np.diff(np.append(starts, n))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        total = scores[starts].copy()
        came = np.zeros((n, count), np.int16)  # the language before, for each language
        came[starts] = np.arange(count)
        for k in range(1, int(sizes[0])):
            active = int(np.searchsorted(-sizes, -k, side="left"))  # texts with more than k words
            at, before = starts[:active] + k, total[:active]
            top = before.argmax(axis=1)
            jump = before[np.arange(active), top] - cost[at]
            stay = before >= jump[:, None]
            came[at] = np.where(stay, np.arange(count)[None, :], top[:, None])
            total[:active] = np.where(stay, before, jump[:, None]) + scores[at]
        current = total.argmax(axis=1)
        for k in range(int(sizes[0]) - 1, -1, -1):
            active = int(np.searchsorted(-sizes, -k, side="left"))
            at = starts[:active] + k
            best_language[at] = current[:active]
            current[:active] = came[at, current[:active]]
        return best_language


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", per_language: int = SAMPLE_PER_LANGUAGE, longest: int = SAMPLE_CHARS) -> NaiveBayes:
    """Fit on at most ``per_language`` texts of each label, drawn by hash among those of 1 to ``longest`` characters.

    The sample bounds what reaches the driver, whatever the table's size: of more than ``MOST_LANGUAGES`` labels those
    with most texts are learnt. Null labels and texts are left out.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & F.length("text").between(1, longest))
    # A hash threshold leaves about four times the bound, so that ranking the rest by hash moves little text.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "lang").limit(MOST_LANGUAGES)
    chance = F.shiftrightunsigned(F.xxhash64("text"), 11) / F.lit(float(2**53))
    ranked = (
        rows.join(F.broadcast(sizes), "lang")  # at most MOST_LANGUAGES rows
        .filter(chance * F.col("size") < 4.0 * per_language)
        .select("lang", "text").dropDuplicates()
        .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")))
        .filter(F.col("n") <= per_language)
    )
    sample = sorted((r.lang, r.text) for r in ranked.select("lang", "text").collect())
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        raise ValueError("no labelled text to learn from")
    label = np.array([languages.index(lang) for lang, _ in sample])
    # Words are split once; their n-grams, many times larger, are held for a part at a time.
    parts = [(slice(a, a + FIT_TEXTS), Words([text for _, text in sample[a : a + FIT_TEXTS]])) for a in range(0, len(sample), FIT_TEXTS)]

    def model(keep: np.ndarray) -> NaiveBayes:
        counts = np.zeros(len(languages) << BUCKET_BITS, np.int64)
        for part, words in parts:
            bucket, owner = grams(words.words)
            of_text = words.text_of[owner]
            used = keep[part][of_text]
            counts += np.bincount((label[part][of_text[used]] << BUCKET_BITS) + bucket[used], minlength=len(counts))
        return NaiveBayes(languages, counts.reshape(len(languages), -1))

    first = model(np.ones(len(sample), bool))
    agrees = []
    for part, words in parts:
        totals = np.zeros((len(label[part]), len(languages)))
        np.add.at(totals, words.text_of, first.word_scores(words.words))
        agrees.append(totals.argmax(axis=1) == label[part])
    return model(np.concatenate(agrees))


def segments(texts: DataFrame, model: NaiveBayes, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, segment_no, lang, confidence, n_words, begin, end`` of every segment of ``texts``.

    ``segment_no`` counts from 1 within the text; ``begin`` and ``end`` are character positions in the text's NFC form;
    ``confidence`` in (0, 1] is the segment's posterior probability, tempered by the n-grams' overlap. Repeated rows
    have their segments each.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)
    kinds = [texts.schema[k].dataType.simpleString() for k in keys]
    schema = ", ".join(f"k{i} {t}" for i, t in enumerate(kinds)) + ", segment_no int, lang string, confidence double, n_words int, begin int, end int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nb = shared.value
        for whole in batches:
            for first in range(0, whole.num_rows, 2000):
                batch = whole.slice(first, 2000)
                words = Words(batch.column(len(keys)).to_pylist())
                scores = nb.word_scores(words.words)
                language = nb.path(words, scores)
                change = np.ones(len(language), bool)
                change[1:] = (np.diff(language) != 0) | (np.diff(words.text_of) != 0)
                at = np.flatnonzero(change)
                text_of, n_words = words.text_of[at], np.diff(np.append(at, len(language)))
                no = np.arange(len(at)) - np.searchsorted(text_of, text_of) + 1
                sums = np.add.reduceat(scores, at, axis=0) if len(at) else np.zeros((0, len(nb.languages)))
                sums = (sums - sums.max(axis=1, keepdims=True)) / len(ORDERS)
                chosen = np.exp(sums[np.arange(len(at)), language[at]]) / np.exp(sums).sum(axis=1)
                rows = pa.array(text_of)
                arrays = [batch.column(i).take(rows) for i in range(len(keys))]
                arrays += [pa.array(no.astype(np.int32)), pa.array([nb.languages[i] for i in language[at]], pa.string()), pa.array(chosen)]
                arrays += [pa.array(n_words.astype(np.int32)), pa.array(words.begin[at].astype(np.int32)), pa.array(words.end[at + n_words - 1].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = [part.split()[0] for part in schema.split(", ")]
    found = texts.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).cast("string").alias("t")).mapInArrow(run, schema)
    for i, k in enumerate(keys):
        found = found.withColumnRenamed(f"k{i}", k)
    return found
