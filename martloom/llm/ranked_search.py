"""Ranked lexical search: accumulators of short lists joined with skipping over long ones.

Documents are cut into blocks, each with the postings of the asked terms: per
term the documents that hold it, in order, and how often. Statistics are summed
over all blocks. Every block then answers every item. Lists that are short in
the block are summed term by term into accumulators, which from then on act as
one list with one bound, their largest sum. That list and the long ones are run
through document by document, some documents at a time: lists whose bounds
together cannot reach the k-th score so far bring no candidates, they are only
looked up at the places of candidates that can still reach it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import by_batches, slices, stored

# Fixed values of the score: 1000 weights the logarithm, 1200 and a quarter share of the length the saturation.
SCALE, SHARE = 1_000_000_000, 25
# Bytes that part words become blanks, capital letters small ones; all else stays.
_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
).lower()

# Documents and postings of a block, characters split at a time, bytes of items asked at a time.
BLOCK_DOCS, BLOCK_POSTINGS, STRETCH, ASKED_BYTES = 4096, 1_000_000, 1 << 22, 1 << 24
# A list is short if it holds at most this share of the block's documents; candidates looked up at a time.
SHORT, STEP = 16, 1024

_BLOCK = (
    "n_docs bigint, n_terms bigint, docs array<bigint>, lengths array<bigint>, "
    "terms array<int>, counts array<bigint>, places array<int>, times array<bigint>"
)


def terms_of(text: bytes) -> Counter:
    """Terms of a text in UTF-8 with their numbers of occurrences; long texts are split stretch by stretch."""
    found: Counter = Counter()
    text, start = text.translate(_BYTES), 0
    while start < len(text):
        end = text.find(b" ", start + STRETCH) if len(text) - start > STRETCH else -1
        end = len(text) if end < 0 else end
        found.update(text[start:end].split())
        start = end
    return found


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def _postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Blocks of documents (id, text) with the postings of the numbered terms."""

    def block(ids: list, lengths: list, rows: list, n_docs: int, n_terms: int) -> pa.RecordBatch:
        terms = np.concatenate([r[0] for r in rows]) if rows else np.empty(0, np.int32)
        times = np.concatenate([r[1] for r in rows]) if rows else np.empty(0, np.int64)
        places = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[0]) for r in rows])
        order = np.argsort(terms, kind="stable")
        present, counts = np.unique(terms, return_counts=True)
        arrays = (ids, lengths, present, counts, places[order], times[order])
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
        columns = [pa.array([np.asarray(a)], pa.list_(k)) for a, k in zip(arrays, kinds)]
        names = ["n_docs", "n_terms", "docs", "lengths", "terms", "counts", "places", "times"]
        return pa.RecordBatch.from_arrays([pa.array([n_docs]), pa.array([n_terms]), *columns], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, rows, n_docs, n_terms, size = [], [], [], 0, 0, 0
        for some in (s for batch in batches for s in slices(batch)):
            for doc, text in zip(some.column("id").to_pylist(), _texts(some, "text")):
                found = terms_of(text)
                length = found.total()
                if not length:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + length
                held = found.keys() & numbers.keys()
                if not held:
                    continue
                ids.append(doc)
                lengths.append(length)
                rows.append(
                    (
                        np.fromiter((numbers[t] for t in held), np.int32, len(held)),
                        np.fromiter((found[t] for t in held), np.int64, len(held)),
                    )
                )
                size += len(held)
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_POSTINGS:
                    yield block(ids, lengths, rows, n_docs, n_terms)
                    ids, lengths, rows, n_docs, n_terms, size = [], [], [], 0, 0, 0
        if n_docs:
            yield block(ids, lengths, rows, n_docs, n_terms)

    return by_batches(docs, work, _BLOCK)


class _List:
    """A list of places with scores, and the most that it can add."""

    def __init__(self, places: np.ndarray, scores: np.ndarray):
        self.places, self.scores, self.bound = places, scores, int(scores.max())

    def at(self, places: np.ndarray) -> np.ndarray:
        """What the list adds at the given places."""
        spot = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[spot] == places, self.scores[spot], 0)


def _accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> _List:
    """Term at a time: the sums of short lists as one list."""
    places = np.concatenate([p for p, _ in lists])
    order = np.argsort(places, kind="stable")
    places, scores = places[order], np.concatenate([s for _, s in lists])[order]
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    return _List(places[first], np.add.reduceat(scores, first))


class _Best:
    """The k best documents of an item so far; equal scores go to the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.floor = k, np.empty(0, np.int64), np.empty(0, np.int64), 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


def _answer(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, short: int, best: _Best) -> None:
    """Adds a block's documents to the best of an item; ``lists`` has places and scores of its terms."""
    few = [x for x in lists if len(x[0]) <= short]
    runs = [_List(*x) for x in lists if len(x[0]) > short]
    if few:
        sums = _accumulated(few)
        runs.append(sums)
        # Whole scores of the documents with the largest sums tell what has to be reached.
        top = np.sort(sums.places[np.argpartition(-sums.scores, min(best.k, len(sums.scores)) - 1)[: best.k]])
        if len(top) == best.k:
            best.floor = max(best.floor, int(sum(run.at(top) for run in runs).min()))
    runs.sort(key=lambda run: -run.bound)
    rest = np.cumsum([0, *(run.bound for run in reversed(runs))])[::-1]
    after = -1
    while True:
        # Lists from here on cannot reach the floor by themselves.
        leading = int(np.count_nonzero(rest[:-1] >= best.floor))
        ahead = [run.places[start : start + STEP] for run in runs[:leading] if (start := np.searchsorted(run.places, after, "right")) < len(run.places)]
        if not ahead:
            return
        # As far as every leading list has been read.
        full = [a[-1] for a in ahead if len(a) == STEP]
        after = min(full) if full else max(a[-1] for a in ahead)
        places = np.unique(np.concatenate(ahead))
        places = places[places <= after]
        scores = np.zeros(len(places), np.int64)
        for run, others in zip(runs, rest):
            alive = scores + others >= best.floor
            if not alive.all():
                places, scores = places[alive], scores[alive]
            if not len(places):
                break
            scores = scores + run.at(places)
        alive = scores >= best.floor
        if alive.any():
            best.add(scores[alive], ids[places[alive]])


def _search(blocks: DataFrame, items: list[tuple[int, dict[int, int]]], weights: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """The k best documents of each task for each item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {item: _Best(k) for item, _ in items}
        asked = [(item, np.array(sorted(terms), np.int32), np.array([terms[t] for t in sorted(terms)])) for item, terms in items]
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths, terms, counts, places, times = (
                    batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                    for c in ("docs", "lengths", "terms", "counts", "places", "times")
                )
                if not len(ids):
                    continue
                m = 100 - SHARE + SHARE * lengths * n // total
                scores = SCALE * times // (1000 * times + 12 * m[places]) * np.repeat(weights[terms], counts)
                starts = np.concatenate([[0], np.cumsum(counts)])
                for item, wanted, repeats in asked:
                    spots = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
                    lists = [
                        (places[starts[s] : starts[s + 1]], scores[starts[s] : starts[s + 1]] * r)
                        for s, r, held in zip(spots, repeats, terms[spots] == wanted)
                        if held and weights[terms[s]] > 0
                    ]
                    if lists:
                        _answer(lists, ids, max(1, len(ids) // SHORT), found[item])
        for item, best in found.items():
            if len(best.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(best.ids), pa.int64()), pa.array(best.ids), pa.array(best.scores)],
                    names=["item_id", "doc_id", "score"],
                )

    return by_batches(blocks, work, "item_id bigint, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """The k documents of highest score above 0 for each item: item_id, rank, doc_id, score.

    Terms are runs of letters, digits and characters beyond ASCII, A to Z in
    small letters. Scores are whole numbers, a rare term counting more, a repeated
    one less each time, and long documents less. Equal scores go to the smaller
    id. Every document is searched and counted whole; items are asked in blocks of
    about ``ASKED_BYTES`` of text, one pass over the documents each.

    Null or wordless texts match nothing and are not counted. Rows without an
    integer id take no part. A repeated document id is ranked once per row; of
    items that repeat an id the smallest text asks. Empty tables give no rows.
    """
    given = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter(
        "id is not null and text is not null"
    )
    asked = items.select(F.col(item_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    asked = asked.filter("id is not null and text is not null").groupBy("id").agg(F.min("text").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // ASKED_BYTES))
    found = None
    for group in range(groups):
        mine = asked.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == group)
        part = _of_items(given, [(row["id"], terms_of(row["text"].encode())) for row in mine.toLocalIterator()], k)
        found = part if found is None else found.unionByName(part)
    rank = "cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank"
    return found.selectExpr("item_id", rank, "doc_id", "score").filter(F.col("rank") <= k)


def _of_items(docs: DataFrame, items: list[tuple[int, Counter]], k: int) -> DataFrame:
    """Candidates for a bounded block of items."""
    terms = sorted(set().union(*(held for _, held in items)))
    numbers = {term: i for i, term in enumerate(terms)}
    blocks = stored(_postings(docs, numbers), "postings")
    held = blocks.select(F.inline(F.arrays_zip("terms", "counts"))).groupBy("terms").agg(F.sum("counts").alias("n"))
    # One row per asked term and one for all documents.
    frequency = {row["terms"]: row["n"] for row in held.toLocalIterator()}
    totals = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, total = (totals[0] or 0), max(totals[1] or 0, 1)
    weights = np.zeros(max(1, len(terms)), np.int64)
    for term, df in frequency.items():
        weights[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    queries = [(item, {numbers[t]: times for t, times in held.items()}) for item, held in items]
    return _search(blocks, queries, weights, n, total, k)
