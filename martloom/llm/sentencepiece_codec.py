"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary holds a white-space marker after another character,
so no piece crosses the start of a marked word. Each distinct marked word is
segmented once and its ids are joined back by position. The table is kept by
each task and bounded in entries: a table of all chunks of the corpus would
have to travel to every text, at a multiple of the size of the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from martloom.llm.common import by_batches, slices, texts_of

MARK = "▁"
# Entries after which a task starts its table anew.
TABLE_ENTRIES = 300_000
# A longer chunk is segmented without being remembered.
LONG_CHUNK = 64
# Characters after which the chunks seen so far are looked up.
JOINED_CHARS = 1 << 20
_CHUNK_START = re.compile(f"(?<=[^{MARK}]){MARK}")




class ChunkTable:
    """Ids and decoded text of marked words, each segmented by the library once."""

    def __init__(self, model: str, entries: int = TABLE_ENTRIES):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.processor.serialized_model_proto())
        normal = spec.normalizer_spec
        # What the method rests on; a model without these properties goes by whole texts.
        self.splits = (
            normal.name == "identity"
            and not normal.precompiled_charsmap
            and normal.add_dummy_prefix
            and normal.escape_whitespaces
            and not normal.remove_extra_whitespaces
            and not spec.trainer_spec.treat_whitespace_as_suffix
            and not any(MARK in p.piece.lstrip(MARK) or p.type == p.USER_DEFINED for p in spec.pieces)
            and any(p.piece == MARK for p in spec.pieces)
        )
        self.entries = entries
        # After a piece without a marker, decoding keeps the space of the next one.
        self.anchor = next(i for i, p in enumerate(spec.pieces) if p.type == p.NORMAL and MARK not in p.piece)
        self.anchor_chars = len(self.processor.decode([self.anchor]))
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}

    def _segment(self, chunks: list[str]) -> tuple[list[bytes], list[str]]:
        # The library puts a marker before a text; it stands for the chunk's own first one.
        found = self.processor.encode([c[1:] for c in chunks], num_threads=1)
        alone = self.processor.piece_to_id(MARK)
        found = [ids if c != MARK else [alone] for c, ids in zip(chunks, found)]
        decoded = self.processor.decode([[self.anchor, *ids] for ids in found], num_threads=1)
        return [np.array(i, "<i4").tobytes() for i in found], [d[self.anchor_chars :] for d in decoded]

    def learn(self, chunks: set[str]) -> list[str]:
        """Segments the chunks not in the table; returns those too long to stay there."""
        if len(self.ids) > self.entries:
            self.ids.clear()
            self.decoded.clear()
        new = [c for c in chunks if c not in self.ids]
        if new:
            ids, decoded = self._segment(new)
            self.ids.update(zip(new, ids))
            self.decoded.update(zip(new, decoded))
        return [c for c in new if len(c) > LONG_CHUNK]

    def forget(self, chunks: list[str]) -> None:
        for chunk in chunks:
            del self.ids[chunk], self.decoded[chunk]

    def convert(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """Ids and decoded text of each text."""
        if not self.splits:
            found = self.processor.encode(texts, num_threads=1)
            return [(np.array(i, "<i4"), d) for i, d in zip(found, self.processor.decode(found, num_threads=1))]
        done = [([], []) for _ in texts]
        for group in _groups(texts):
            long = self.learn(set(chain.from_iterable(chunks for _, chunks in group)))
            for at, chunks in group:
                done[at][0].append(b"".join(map(self.ids.__getitem__, chunks)))
                done[at][1].append("".join(map(self.decoded.__getitem__, chunks)))
            self.forget(long)
        # The marker put before the text is no part of it.
        return [(np.frombuffer(b"".join(i), "<i4"), "".join(d)[1:]) for i, d in done]


def chunks_of(marked: str) -> list[str]:
    """Marked words of a text that starts with a marker: a run of markers and what follows it."""
    parts = marked.split(MARK)[1:]
    if "" not in parts:
        return [MARK + p for p in parts]
    chunks, marks = [], ""
    for part in parts:
        marks += MARK
        if part:
            chunks.append(marks + part)
            marks = ""
    return [*chunks, marks] if marks else chunks


def _pieces(marked: str) -> Iterator[str]:
    """Cuts a long text before marked words, so that few chunks are held at a time."""
    start = 0
    while len(marked) - start > JOINED_CHARS:
        cut = _CHUNK_START.search(marked, start + JOINED_CHARS)
        if not cut:
            break
        yield marked[start : cut.end() - 1]
        start = cut.end() - 1
    yield marked[start:]


def _groups(texts: list[str]) -> Iterator[list[tuple[int, list[str]]]]:
    """Chunks with the place of their text, about ``JOINED_CHARS`` characters at a time."""
    group, size = [], 0
    for at, text in enumerate(texts):
        if not text:
            continue
        for piece in _pieces(MARK + text.replace(" ", MARK)):
            group.append((at, chunks_of(piece)))
            size += len(piece)
            if size >= JOINED_CHARS:
                yield group
                group, size = [], 0
    if group:
        yield group


@cache
def _table(model: str) -> ChunkTable:
    """One table per Python worker and model; it serves all tasks that worker runs."""
    return ChunkTable(model)


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``ids`` and the ``decoded`` text.

    ``model`` is the path of a SentencePiece model that every executor can open.
    Ids are those the library gives for the whole text, without begin or end
    ids. A null text counts as empty: no ids, empty text. Repeated rows repeat
    in the result; other columns are not read; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for batch in batches:
            for part in slices(batch):
                found = table.convert(texts_of(part))
                offsets = np.cumsum([0, *(len(ids) for ids, _ in found)]).astype("i4")
                flat = np.concatenate([ids for ids, _ in found]) if found else np.empty(0, "<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
                        pa.array([text for _, text in found], pa.string()),
                    ],
                    names=["id", "ids", "decoded"],
                )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return by_batches(slim, work, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
