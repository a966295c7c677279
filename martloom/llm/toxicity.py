"""Toxicity by compression distance: two zstandard dictionaries compete for each word window.

A window is one word with its borders, however short the word. Scripts without
spaces give a window for every two neighbouring letters, other runs of more than
``LONGEST`` letters one for every four. Each byte of a window is spelled as four, so
that a compressed length counts the pieces a window is made of rather than its
letters: a window that stands in a dictionary as a whole costs one match. The
toxic dictionary holds the words, of toxic training text, that are toxic by the
G-test, alone or by their beginning; the ordinary one the commonest words of
ordinary text. A window speaks for toxicity if the toxic dictionary takes at
most ``longest`` bytes for it and at least ``gain`` fewer than the ordinary one;
both thresholds, and the score for a number of such windows, are calibrated on
the training rows.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import by_batches, hashed_sample, slices, stored, texts_of

_WORD = re.compile(r"\w+")
_SPELLING = [bytes(random.Random(n).sample(range(256), 4)) for n in range(256)]
# Letters of a run that is taken as one word at most, and of the windows a longer one is cut into.
LONGEST, CUT = 40, 4
# Runs in scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+)")
UNSPACED_CUT = 2
# Words a task remembers before it starts anew.
REMEMBERED = 400_000
# Windows counted per pair of thresholds while calibrating.
_LENGTHS, _GAINS = range(14, 22), (2, 4, 6)


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    longest: int = 16
    gain: int = 2
    weights: tuple[float, float, float] = (-3.0, 4.0, 0.0)


def _overlapping(run: str, letters: int) -> Iterator[str]:
    return (run[i : i + letters] for i in range(max(1, len(run) - letters + 1)))


def words_of(text: str) -> Counter[str]:
    """The words of the windows of a text and how often they occur; every letter is in one at least."""
    runs = _WORD.findall(text.lower())
    if len(max(runs, key=len, default="")) <= LONGEST and not _UNSPACED.search(text):
        return Counter(runs)
    words = Counter()
    for run in runs:
        # Runs in a script without spaces stand at odd places.
        for k, part in enumerate(_UNSPACED.split(run)):
            if k % 2:
                words.update(_overlapping(part, UNSPACED_CUT))
            elif len(part) > LONGEST:
                words.update(_overlapping(part, CUT))
            elif part:
                words[part] += 1
    return words


def _window(word: str) -> bytes:
    return b"".join(_SPELLING[c] for c in f" {word} ".encode())


def _compressor(content: bytes, level: int = 9) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level)
    return zstandard.ZstdCompressor(
        level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
    )


class WindowLengths:
    """Compressed lengths of windows under both dictionaries, remembered per word."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.toxic, self.ordinary = _compressor(model.toxic), _compressor(model.ordinary)
        self.votes: dict[str, bool] = {}

    def pair(self, word: str) -> tuple[int, int]:
        window = _window(word)
        return len(self.toxic.compress(window)), len(self.ordinary.compress(window))

    def vote(self, word: str) -> bool:
        window = _window(word)
        short = len(self.toxic.compress(window))
        # The ordinary dictionary matters only where the toxic one does well.
        return short <= self.model.longest and len(self.ordinary.compress(window)) - short >= self.model.gain

    def count(self, words: Counter[str]) -> int:
        votes = self.votes
        if len(votes) > REMEMBERED:
            votes.clear()
        for word in words:
            if word not in votes:
                votes[word] = self.vote(word)
        return sum(n for word, n in words.items() if votes[word])


@cache
def _lengths(model: ToxicityModel) -> WindowLengths:
    return WindowLengths(model)


def _g_root(a: str, b: str) -> str:
    """SQL: signed root of the G statistic for a word in a toxic and b ordinary documents."""
    expected = f"(({a} + {b}) * toxic_share)"
    other = f"(({a} + {b}) * (1 - toxic_share))"
    part = f"{a} * ln({a} / {expected}) + if({b} > 0, {b} * ln({b} / {other}), 0)"
    return f"if({a} > {expected}, sqrt(2 * ({part})), 0)"


def _word_counts(rows: DataFrame) -> DataFrame:
    """Documents of each label that hold a word, from rows (text, label)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1024):
                counts: dict[str, list[int]] = {}
                for text, label in zip(texts_of(part), part.column("label").to_pylist()):
                    for word in words_of(text):
                        counts.setdefault(word, [0, 0])[1 - label] += 1
                a, b = (pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), a, b], names=["word", "a", "b"])

    counts = by_batches(rows.select("text", "label"), work, "word string, a bigint, b bigint")
    return counts.groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, lightly regularised."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        w = w - np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w)
    return w


def _features(votes: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(votes)), np.log1p(votes), np.log1p(words)])


def fit_toxicity(
    rows: DataFrame, id_col: str = "doc_id", sample_rows: int = 20_000, strength: float = 6.5, dictionary_words: int = 400
) -> ToxicityModel:
    """Fits dictionaries and thresholds to rows (id, text, label), label 1 for toxic.

    About ``sample_rows`` rows are used, chosen by a hash of their id. At most
    ``dictionary_words`` words of a G-test root of at least ``strength`` enter the
    toxic dictionary and ten times as many the ordinary one. Rows without a
    label take no part; without both labels nothing is toxic.
    """
    rows = hashed_sample(rows.filter("label in (0, 1)"), id_col, sample_rows)
    rows = stored(rows.select(id_col, "text", F.col("label").cast("int").alias("label")), "toxicity-sample")
    seen = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, plain = seen.get(1, 0), seen.get(0, 0)
    if not toxic or not plain:
        return ToxicityModel(b"", b"", longest=0, weights=(-5.0, 0.0, 0.0))
    counts = stored(_word_counts(rows), "toxicity-words")
    a_all, b_all = counts.agg(F.sum("a"), F.sum("b")).first()
    if not a_all or not b_all:
        return ToxicityModel(b"", b"", longest=0, weights=(-5.0, 0.0, 0.0))
    share = a_all / (a_all + b_all)
    # Beginnings have three letters at least; a word of up to three stands for itself alone.
    begin = "explode(if(length(word) > 3, transform(sequence(3, length(word)), n -> left(word, n)), array(word || ' '))) as start"
    starts = counts.selectExpr(begin, "a", "b").groupBy("start").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    starts = starts.withColumn("toxic_share", F.lit(share)).selectExpr("start", f"{_g_root('a', 'b')} as root")
    strong = (
        counts.filter((F.col("a") >= 3) & (F.col("a") * plain > F.col("b") * 8 * toxic))
        .selectExpr("word", begin)
        .join(starts.filter(F.col("root") >= strength), "start")
        .groupBy("word")
        .agg(F.max("root").alias("root"))
        .orderBy(F.desc("root"), "word")
        .limit(dictionary_words)
    )
    common = counts.filter("b > 0").orderBy(F.desc("b"), "word").limit(10 * dictionary_words)
    # What stands last in a dictionary is cheapest to refer to.
    content = [b"".join(_window(r["word"]) for r in reversed(part.collect())) for part in (strong, common)]
    return _calibrated(ToxicityModel(*content), rows)


def _calibrated(model: ToxicityModel, rows: DataFrame) -> ToxicityModel:
    grid = [(n, g) for n in _LENGTHS for g in _GAINS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, known = WindowLengths(model), {}
        for batch in batches:
            for part in slices(batch):
                words, votes = [], []
                for text in texts_of(part):
                    found = words_of(text)
                    for word in found:
                        if word not in known:
                            known[word] = lengths.pair(word)
                    pairs = np.array([known[w] for w in found] or [(99, 99)])
                    gain = pairs[:, 1] - pairs[:, 0]
                    often = np.array(list(found.values()) or [0])
                    words.append(found.total())
                    votes.append([int(often[(pairs[:, 0] <= n) & (gain >= g)].sum()) for n, g in grid])
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(words, pa.int64()), pa.array(votes, pa.list_(pa.int64()))],
                    names=["label", "words", "votes"],
                )

    found = by_batches(rows.select("text", "label"), work, "label int, words bigint, votes array<bigint>").collect()
    found.sort(key=lambda r: (r["label"], r["words"], r["votes"]))
    label = np.array([r["label"] for r in found], float)
    words = np.array([r["words"] for r in found], float)
    votes = np.array([r["votes"] for r in found], float)
    best = None
    for i, (longest, gain) in enumerate(grid):
        x = _features(votes[:, i], words)
        w = _logistic(x, label)
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-6, 1 - 1e-6)
        loss = -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()
        if w[1] > 0 and (best is None or loss < best[0] - 1e-9):
            best = loss, ToxicityModel(model.toxic, model.ordinary, longest, gain, tuple(map(float, w)))
    return best[1] if best else ToxicityModel(b"", b"", longest=0, weights=(-5.0, 0.0, 0.0))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, toxic_windows, windows and ``score`` from 0 to 1.

    Whole texts are scored. A null or empty text has no windows and scores as
    low as any; repeated rows score alike; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(model)
        for batch in batches:
            for part in slices(batch):
                found = [(ws.total(), lengths.count(ws)) for ws in map(words_of, texts_of(part))]
                words, votes = np.array(found, np.int64).reshape(-1, 2).T
                logit = np.clip(_features(votes, words) @ np.array(model.weights), -30, 30)
                score = np.where(words > 0, 1 / (1 + np.exp(-logit)), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(votes), pa.array(words), pa.array(score)],
                    names=["id", "toxic_windows", "windows", "score"],
                )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, toxic_windows bigint, windows bigint, score double"
    return by_batches(slim, work, schema).withColumnRenamed("id", id_col)
