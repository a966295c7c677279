"""Vector best-fit packing of tokenized documents into sequences.

Each piece of a document asks for three capacities of a sequence: tokens, one
place among its documents, and attention cost (length squared). Pieces of one
length ask for the same, so sequences are filled by classes: a class of equal
sequences takes one more piece of a length in each of its members at once. The
plan is made from the number of pieces of each length, which has as many rows
as a sequence has tokens, however large the corpus. Pieces then find their place
in the plan by their number among the pieces of their length.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import by_batches, slices, stored, texts_of

# Entries (about 200 bytes each) after which a task starts its table of words anew.
TABLE_ENTRIES = 400_000
# A longer word is encoded without being remembered.
LONG_WORD = 64
# A word of plain Latin letters and ASCII signs after it: two groups of tokens that never merge.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u012f\u0131-\u024f]*)([!-/:-@\[-`{-~]*)")
# Counts (one per task and length, 24 bytes each) that are broadcast.
FEW_COUNTS = 500_000


class WordTable:
    """Ids of the words of a text, each distinct word encoded by the library once.

    White space ends every token of this kind of vocabulary and is dropped, so
    the ids of a text are those of its words in order. A word of Latin letters,
    signs, or letters and then signs is two pre-tokens at most, whose ids are
    remembered as well; any other word goes to the library as it is.
    """

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = "Ab cD\\n12,x. it's"
        apart = [i for w in probe.split() for i in self._encode([w])[0]]
        if self._encode([probe])[0] != apart:
            raise ValueError(f"{path} is no vocabulary of words")
        # Only a vocabulary that does not tell capitals from small letters may be asked for small ones alone.
        capitals = "THE Quick bROWN fox It's A1B2 QX-ZZ W.V. Jumped OVER Lazy Dogs"
        self.lowers = self._encode([capitals])[0] == self._encode([capitals.lower()])[0]
        self.entries = entries
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # How byte-level vocabularies spell bytes: visible ones as themselves, the others from 256 on.
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in visible]
        self.spelling = {b: chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)}
        probes = ["Hello,", "naïve!!", "ÆØÅ", "groß)", "dž%%%", "'", "it's", "a_b", "İx", "x²", "×"]
        self.by_parts = True
        wanted = (np.array(i, "<u4").tobytes() for i in self._encode(probes))
        self.by_parts = all(self._word(w) in (None, ids) for w, ids in zip(probes, wanted))

    def _part(self, part: str) -> bytes:
        """Ids of one run of letters or signs, straight from the merges."""
        ids = self.parts.get(part)
        if ids is None:
            spelled = part if part.isascii() else "".join(map(self.spelling.__getitem__, part.encode()))
            ids = self.parts[part] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return ids

    def _word(self, word: str) -> bytes | None:
        """Ids of a word whose pre-tokens are plain to see; None for any other word."""
        found = _PLAIN.fullmatch(word) if self.by_parts else None
        if not found or not word:
            return b"" if not word else None
        letters, signs = found.groups()
        if letters and not letters.isalpha():
            return None
        letters = letters.lower() if self.lowers else letters
        return (self._part(letters) if letters else b"") + (self._part(signs) if signs else b"")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def convert(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit numbers."""
        known = self.known
        if len(known) + len(self.parts) > self.entries:
            known.clear()
            self.parts.clear()
        whole = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        words = [[] if i in whole else self._words(t) for i, t in enumerate(texts)]
        new = set(chain.from_iterable(words)).difference(known)
        plain = {w: self._word(w) for w in new}
        other = [w for w, ids in plain.items() if ids is None]
        known.update(plain)
        known.update((w, np.array(i, "<u4").tobytes()) for w, i in zip(other, self._encode(other)))
        found = [np.frombuffer(b"".join(map(known.__getitem__, ws)), "<u4") for ws in words]
        for i in whole:
            found[i] = np.array(self._encode([texts[i]])[0], "<u4")
        for word in new:
            if len(word) > LONG_WORD:
                del known[word]
        return found

    def _words(self, text: str) -> list[str]:
        # Blanks, tabs and line ends are white space by every rule; other kinds are left to the library.
        text = text.lower() if self.lowers and text.isascii() else text
        return text.replace("\n", " ").replace("\t", " ").split(" ")


@cache
def _table(path: str) -> WordTable:
    return WordTable(path)


def tokenized_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents: id, piece, start, length and ``ids`` (little-endian unsigned 32 bit).

    A document is its ids and then ``end_id``; only one longer than ``capacity``
    is cut. A null or empty text is one piece that holds just the end id. Two
    more columns number the pieces once the rows are stored: ``task``, and
    ``local``, the place of a piece among those of its length in its task.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(vocabulary)
        tail = np.array([end_id], "<u4")
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in slices(batch):
                rows, piece, start, data, local = [], [], [], [], []
                for row, ids in enumerate(table.convert(texts_of(part))):
                    ids = np.concatenate([ids, tail])
                    for number, at in enumerate(range(0, len(ids), capacity)):
                        rows.append(row)
                        piece.append(number)
                        start.append(at)
                        data.append(ids[at : at + capacity].tobytes())
                        length = len(data[-1]) // 4
                        local.append(seen[length])
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array([len(d) // 4 for d in data], pa.int64()),
                        pa.array(data, pa.binary()),
                        pa.array([task] * len(rows), pa.int32()),
                        pa.array(local, pa.int64()),
                    ],
                    names=["id", "piece", "start", "length", "ids", "task", "local"],
                )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, piece int, start bigint, length bigint, ids binary, task int, local bigint"
    return by_batches(slim, work, schema).withColumnRenamed("id", id_col)


@dataclass(frozen=True)
class Capacities:
    """What one sequence can hold, and how much each capacity weighs in the choice."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)
    # "dot": largest weighted product of demand and what is left; "norm": least left over.
    rule: str = "norm"


def plan_classes(counts: dict[int, int], caps: Capacities) -> list[tuple[int, int, int, int, int]]:
    """Places for all pieces: (length, first number, pieces, first sequence, offset).

    Lengths go from long to short. A class of open sequences is (what is left,
    first sequence, sequences); one that takes a piece in only some of its
    members is split in two.
    """
    whole = np.array([caps.tokens, caps.documents, caps.attention], float)
    weights = np.array(caps.weights) / np.sum(caps.weights)
    plan: list[tuple[int, int, int, int, int]] = []
    left = np.zeros((0, 3))
    first: list[int] = []
    many: list[int] = []
    used = 0
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], float)
        if (need > whole).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        todo, number = counts[length], 0
        while todo:
            fits = np.flatnonzero((left >= need).all(axis=1))
            if len(fits):
                after = (left[fits] - need) / whole
                if caps.rule == "dot":
                    order = -((left[fits] / whole) * (need / whole) * weights).sum(axis=1)
                else:
                    order = (after * after * weights).sum(axis=1)
                at = fits[np.lexsort((fits, order))[0]]
                take = min(todo, many[at])
                plan.append((length, number, take, first[at], int(caps.tokens - left[at][0])))
                if take < many[at]:
                    left = np.vstack([left, left[at]])
                    first.append(first[at] + take)
                    many.append(many[at] - take)
                many[at] = take
                left[at] = left[at] - need
            else:
                # As many new sequences as hold the rest, each with as many of this length as fit.
                each = int(np.min(whole // need))
                take = -(-todo // each)
                plan.append((length, number, take, used, 0))
                left = np.vstack([left, whole - need])
                first.append(used)
                many.append(take)
                used += take
            todo -= take
            number += take
        open_ = (left[:, 0] > 0) & (left[:, 1] > 0) & (left[:, 2] > 0)
        if not open_.all():
            keep = np.flatnonzero(open_)
            left, first, many = left[keep], [first[i] for i in keep], [many[i] for i in keep]
    return plan


def assign_sequences(pieces: DataFrame, caps: Capacities) -> DataFrame:
    """Replaces ``task`` and ``local`` of stored pieces by sequence_id and offset.

    Pieces of a length are numbered over all tasks by the counts of the tasks
    before, so nothing is sorted and no length, however common, meets in one task.
    """
    spark = pieces.sparkSession
    counts = stored(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length: dict[int, np.ndarray] = {}
    table = np.array(plan_classes(totals, caps), np.int64).reshape(-1, 5)
    for length in totals:
        rows = table[table[:, 0] == length][:, 1:]
        by_length[length] = rows[np.argsort(rows[:, 0], kind="stable")]
    sent = spark.sparkContext.broadcast(by_length)
    before = counts.selectExpr("length", "task", "sum(n) over (partition by length order by task) - n as before")
    before = F.broadcast(before) if counts.count() <= FEW_COUNTS else before
    names = [c for c in pieces.columns if c not in ("task", "local")]
    numbered = pieces.join(before, ["length", "task"]).selectExpr(*names, "before + local as _pk_number")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            numbers = batch.column("_pk_number").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                rows = sent.value[int(length)]
                mine = np.flatnonzero(lengths == length)
                step = np.searchsorted(rows[:, 0], numbers[mine], side="right") - 1
                sequence[mine] = rows[step, 2] + numbers[mine] - rows[step, 0]
                offset[mine] = rows[step, 3]
            kept = batch.schema.get_field_index("_pk_number")
            yield pa.RecordBatch.from_arrays(
                [*(c for i, c in enumerate(batch.columns) if i != kept), pa.array(sequence), pa.array(offset)],
                names=[*(n for n in batch.schema.names if n != "_pk_number"), "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{n}` {pieces.schema[n].dataType.simpleString()}" for n in names)
    return by_batches(numbered, work, f"{fields}, sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame,
    vocabulary: str,
    caps: Capacities = Capacities(),
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset and, if kept, ids.

    Sequences are gapless from offset 0. A null text counts as empty and takes
    one token, the end id. Repeated rows are packed each. An empty table gives
    no rows; other columns are not read.
    """
    pieces = tokenized_pieces(docs, vocabulary, caps.tokens, end_id, id_col, text_col)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    table = stored(pieces if keep_ids else pieces.drop("ids"), "pieces")
    return assign_sequences(table, caps)
