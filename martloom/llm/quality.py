"""Quality of texts by logistic regression over hashed word n-grams.

Weights are learned with follow-the-regularised-leader updates (per-coordinate
steps, L1 and L2), and a text is scored as a sparse dot product. Words are runs
of letters and digits or runs of other signs; pairs of neighbours count as well,
and a word that follows itself counts as the same pair whatever the word is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import hashing
from martloom.llm.common import by_batches, hashed_sample, slices, texts_of

BITS = 18
# Bytes of a text hashed at a time; pairs of words do not cross a cut.
BLOCK = 1 << 20
_REPEAT = np.uint64(0x5851F42D4C957F2D)
_KIND = np.full(256, 2, np.uint8)
_KIND[[*range(48, 58), *range(97, 123), *range(128, 256)]] = 1
_KIND[[32, *range(9, 14)]] = 0


def _block_ngrams(raw: np.ndarray) -> np.ndarray:
    kind = _KIND[raw]
    edges = np.flatnonzero(np.diff(kind)) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [len(raw)]])
    real = kind[starts] > 0
    words = hashing.spans(raw, starts[real], ends[real])
    first, second = words[:-1], words[1:]
    pairs = hashing.mix(first * np.uint64(0x9E3779B97F4A7C15) + second)
    return np.concatenate([words, np.where(first == second, _REPEAT, pairs)])


def features(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams and their values: damped counts of unit length."""
    data = text.encode("utf-8", "surrogatepass").lower()
    found = [_block_ngrams(np.frombuffer(data[i : i + BLOCK], np.uint8)) for i in range(0, len(data), BLOCK)]
    if not found:
        return np.empty(0, np.int64), np.empty(0)
    grams = np.concatenate(found) & np.uint64((1 << bits) - 1)
    buckets, counts = np.unique(grams.astype(np.int64), return_counts=True)
    values = 1 + np.log(counts)
    return buckets, values / np.sqrt((values * values).sum() or 1.0)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, text: str) -> float:
        buckets, values = features(text, self.bits)
        logit = self.bias + float(self.weights[buckets] @ values)
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def train_ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    bits: int = BITS,
    passes: int = 5,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.02,
) -> QualityModel:
    """FTRL-proximal over (buckets, values, label), in the given order each pass.

    The last coordinate is the bias, which is not regularised.
    """
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        own_l1 = np.where(at == size - 1, 0.0, l1)
        own_l2 = np.where(at == size - 1, 0.0, l2)
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - own_l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + own_l2)

    for _ in range(passes):
        for buckets, values, label in examples:
            at, x = np.append(buckets, size - 1), np.append(values, 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    all_ = weights(np.arange(size))
    return QualityModel(all_[:-1], float(all_[-1]), bits)


def fit_quality(
    rows: DataFrame, id_col: str = "doc_id", sample_rows: int = 6_000, longest: int = 100_000, bits: int = BITS
) -> QualityModel:
    """Fits the classifier to rows (id, text, label), label 1 for good.

    About ``sample_rows`` rows are used, chosen by a hash of their id; texts of
    more than ``longest`` characters are not learned from (they are scored).
    Rows without a label take no part; without rows every score is one half.
    """
    fit = rows.filter("label in (0, 1)").filter(F.length(F.coalesce("text", F.lit(""))) <= longest)
    fit = hashed_sample(fit, id_col, sample_rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [features(t, bits) for t in texts_of(part)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("turn"),
                        part.column("label"),
                        pa.array([b.astype("<i4").tobytes() for b, _ in found], pa.binary()),
                        pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                    ],
                    names=["turn", "label", "buckets", "values"],
                )

    turn = F.xxhash64(F.lit("order"), id_col).alias("turn")
    fit = fit.select(turn, F.col("label").cast("int").alias("label"), "text")
    found = by_batches(fit, work, "turn bigint, label int, buckets binary, values binary").collect()
    found.sort(key=lambda r: (r["turn"], r["label"], bytes(r["buckets"])))
    return train_ftrl(
        [
            (np.frombuffer(r["buckets"], "<i4").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float), r["label"])
            for r in found
        ],
        bits,
    )


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``score`` from 0 to 1.

    Whole texts are scored. A null or empty text has no n-grams and gets the
    score of the bias alone. Repeated rows score alike; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                scores = [sent.value.score(t) for t in texts_of(part)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return by_batches(slim, work, f"id {kind}, score double").withColumnRenamed("id", id_col)
