"""Language proportions of documents by expectation-maximisation over n-gram likelihoods.

Each letter with its two neighbours is an n-gram. A model holds the probability
of every hashed n-gram in each language. For a document, EM estimates the mixture
of languages that makes its n-grams likeliest; languages are taken in order of
their share, as many as a penalised likelihood (BIC, with the weight of the
penalty a parameter) asks for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import by_batches, hashed_sample, slices, texts_of

UNKNOWN = "und"
BUCKETS = 1 << 16
# Code points of a text that are hashed at a time.
BLOCK = 1 << 20
STEPS = 25


@cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter, as Python has it."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the n-grams of a lower-cased text; one n-gram per letter."""
    text = text.lower()
    counts = np.zeros(BUCKETS, np.int64) if len(text) > BLOCK else None
    # Letters around a cut are seen from both sides, each counted where it is in the middle.
    for start in range(0, max(len(text), 1), BLOCK):
        first, last = max(0, start - 1), min(len(text), start + BLOCK + 1)
        points = np.frombuffer(text[first:last].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letter = _letters()[points]
        points = np.concatenate([[0], np.where(letter, points, 0), [0]])
        letter[: start - first] = False
        letter[min(start + BLOCK, last) - first :] = False
        middle = np.flatnonzero(letter)
        key = (points[middle] * 0x9E3779B1 + points[middle + 1] * 0x85EBCA77 + points[middle + 2] * 0xC2B2AE3D)
        found, n = np.unique((key ^ (key >> 17)) & (BUCKETS - 1), return_counts=True)
        if counts is None:
            return found, n
        counts[found] += n
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    # Probability of each bucket, one row per language.
    odds: np.ndarray
    penalty: float = 6.0


def mixture(model: LanguageModel, text: str) -> dict[str, float]:
    """Share of each language in a text; empty if the text has no letter."""
    if not model.languages:
        return {}
    buckets, counts = ngram_counts(text)
    total = counts.sum()
    if not total:
        return {}
    odds = model.odds[:, buckets]
    shares, _ = _em(odds, counts)
    order = np.argsort(-shares, kind="stable")
    best = None
    for size in range(1, len(order) + 1):
        chosen = order[:size]
        part, fit = _em(odds[chosen], counts)
        value = fit - model.penalty * size * np.log(total + 1)
        if best is not None and value <= best[0]:
            break
        best = value, chosen, part
    return {model.languages[i]: float(p) for i, p in zip(best[1], best[2])}


def _em(odds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    shares = np.full(len(odds), 1 / len(odds))
    if len(odds) > 1:
        for _ in range(STEPS):
            whole = shares @ odds
            new = shares * (odds @ (counts / whole))
            new /= new.sum()
            if np.abs(new - shares).max() < 1e-4:
                shares = new
                break
            shares = new
    return shares, float(counts @ np.log(shares @ odds))


def fit_languages(
    rows: DataFrame, id_col: str = "doc_id", sample_rows: int = 40_000, penalty: float = 6.0, smoothing: float = 0.2
) -> LanguageModel:
    """Learns n-gram probabilities from rows (id, text, lang).

    About ``sample_rows`` rows are used, chosen by a hash of their id. Rows
    without a language take no part. The driver gets one number per language
    and bucket.
    """
    rows = hashed_sample(rows.filter("lang is not null and text is not null"), id_col, sample_rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                for text, lang in zip(texts_of(part), part.column("lang").to_pylist()):
                    found, n = ngram_counts(text)
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[found] += n
        for lang, n in sums.items():
            found = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(n[found])],
                names=["lang", "bucket", "n"],
            )

    counts = by_batches(rows.select("text", "lang"), work, "lang string, bucket bigint, n bigint")
    sums: dict[str, np.ndarray] = {}
    for lang, buckets, n in (
        counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list("bucket"), F.collect_list("n")).collect()
    ):
        sums.setdefault(lang, np.full(BUCKETS, smoothing))[buckets] += n
    languages = tuple(sorted(sums))
    odds = np.array([sums[x] / sums[x].sum() for x in languages]).reshape(len(languages), BUCKETS)
    return LanguageModel(languages, odds, penalty)


def detect_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score and ``mixture`` (language to share).

    ``lang_pred`` has the largest share and ``score`` is that share. Whole texts
    are read. A text that is null, empty or has no letter gives ``und``, score 0
    and an empty mixture. Repeated rows repeat; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [mixture(sent.value, t) for t in texts_of(part)]
                best = [max(m, key=m.get) if m else UNKNOWN for m in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(best, pa.string()),
                        pa.array([min(1.0, m[b]) if m else 0.0 for m, b in zip(found, best)], pa.float64()),
                        pa.array([list(m.items()) for m in found], pa.map_(pa.string(), pa.float64())),
                    ],
                    names=["id", "lang_pred", "score", "mixture"],
                )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, lang_pred string, score double, mixture map<string,double>"
    return by_batches(slim, work, schema).withColumnRenamed("id", id_col)


def keep_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows, with the columns they came with, in which a language is found, in whatever mixture.

    Texts that are null, empty or without letters are rejected, also by a model
    that knows no language, and nothing else is.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = texts_of(part, text_col)
                if sent.value.languages:
                    keep = [bool(mixture(sent.value, t)) for t in texts]
                else:
                    keep = [any(map(str.isalpha, t)) for t in texts]
                yield part.filter(pa.array(keep, pa.bool_()))

    return by_batches(docs, work, docs.schema)
