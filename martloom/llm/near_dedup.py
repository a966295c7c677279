"""Near duplicates by bottom-k sketches.

One hash function orders all word shingles; a document keeps the k smallest of
its own. Inverted lists of kept values give the pairs that may overlap enough,
the sketch of the union estimates their similarity, and pairs that pass are
compared on their full sets. Documents with equal sets are one class from the
start, so copies are never paired.

Lists are kept short by order: a class is listed only under its rarest values,
as many as any pair that shares half a sketch must have in common with. Groups
of many different near copies do have long lists. Classes that long lists hold
together form a family, which is cut into even blocks by the size of its sets; a
task compares all full sets of two blocks by a matrix product and returns links that
connect what is linked, fewer than it has classes. Blocks whose sizes rule the
similarity out never meet. So no pair that is not a link is ever written for a
family, and no link is lost.

Classes are named by the number of one of their rows, not by an id: rows that share
an id but not a text are classes of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm import hashing
from martloom.llm.common import by_batches, slices, stored
from martloom.llm.components import components

# Sketch size, and how far below the threshold the share of a union sketch that a
# linked pair has in common may fall, in hundredths. At a threshold of 0.8 a pair
# shares less than half of a sketch with a chance below one in a million.
SKETCH = 64
MARGIN = 30
# Names of at most this many documents are broadcast (24 bytes each).
FEW_IDS = 500_000
# Classes with at least this share of all rows; at most 1 / HOT_SHARE exist.
HOT_SHARE = 1e-3
# Entries up to which all pairs of a list are written; longer lists form families.
SHORT = 8
# Classes and shingles that a block of a family has at most, about.
BLOCK_CLASSES, BLOCK_SHINGLES = 2048, 1 << 20
# A family is cut finer than that, so that its tasks are like others: into blocks of an
# eighth of it, but into no more than EVEN for this alone, since each class is copied to
# each block it meets.
FINER, EVEN = 8, 64
# Columns of the matrices that are multiplied at a time.
COLUMNS = 1 << 13


def _sketches(docs: DataFrame, id_col: str, text_col: str, words: int, exact: int | None) -> DataFrame:
    """Per row: its number, id, mark (hash of the text), n (set size), digest of the set, sketch.

    With ``exact``, a percentage, the sketch is so long that any two sets of that
    similarity have a value of it in common.
    """

    def kept(s: np.ndarray) -> np.ndarray:
        least = SKETCH if exact is None else len(s) - (exact * len(s) + 99) // 100 + 1
        return s[:least].view(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch):
                sets = [hashing.shingles(t, words) for t in part.column("text").to_pylist()]
                named = part.column("id").is_valid().to_pylist()
                digests = [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) and known else None
                    for s, known in zip(sets, named)
                ]
                sketches = [kept(s) for s in sets]
                offsets = np.cumsum([0, *map(len, sketches)]).astype("i4")
                flat = np.concatenate(sketches) if sketches else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(sets)), pa.int64()),
                        part.column("id"),
                        part.column("mark"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    names=["row", "id", "mark", "n", "digest", "sketch"],
                )
                row += len(sets)

    slim = _slim(docs, id_col, text_col)
    return by_batches(slim, work, "row bigint, id bigint, mark bigint, n bigint, digest binary, sketch array<bigint>")


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))


def _members(docs: DataFrame, id_col: str, text_col: str, words: int, exact: int | None) -> DataFrame:
    """Per row: id, mark, n, cid (least row number of its class), least (its smallest id).

    The row that names a class also has its sketch.
    """
    rows = stored(_sketches(docs, id_col, text_col, words, exact), "sketches")
    known = rows.filter("digest is not null")
    classes = known.groupBy("digest").agg(F.min("row").alias("cid"), F.min("id").alias("least"), F.count(F.lit(1)).alias("size"))
    classes = stored(classes.filter("size > 1"), "classes")
    large = F.col("size") >= max(2.0, HOT_SHARE * rows.count())
    hot = classes.filter(large).select("digest", F.col("cid").alias("hot"), F.col("least").alias("hot_least"))
    cold = classes.filter(~large).select(F.col("digest").alias("key"), "cid", "least")
    marked = rows.join(F.broadcast(hot), "digest", "left")
    # Rows of large classes have their answer; a key of their own spreads them in the next join.
    spread = F.concat(F.lit("-"), F.col("row").cast("string")).cast("binary")
    plain = F.col("hot").isNull() & F.col("digest").isNotNull()
    marked = marked.withColumn("key", F.when(plain, F.col("digest")).otherwise(spread)).join(cold, "key", "left")
    cid = F.coalesce("hot", "cid", "row")
    return marked.select(
        "id",
        "mark",
        "n",
        cid.alias("cid"),
        F.coalesce("hot_least", "least", "id").alias("least"),
        F.when((cid == F.col("row")) & F.col("digest").isNotNull(), F.col("sketch")).alias("sketch"),
    )


def _least_share(percent: int) -> int:
    """Hundredths of a sketch that a linked pair has in common, but for a negligible chance."""
    return max(percent - MARGIN, 2)


def _postings(classes: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Inverted lists (v, cid, n) of the rarest kept values of each class; of all of them if ``exact``."""
    entries = classes.select("cid", F.explode("sketch").alias("v"))
    shared = entries.groupBy("v").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = entries.join(shared, "v").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("found"))
    needed = F.lit(1) if exact else F.ceil(F.size("sketch") * _least_share(percent) / 100).cast("int")
    # Values of one class alone come first in the order and take part in no list.
    chosen = ranked.join(classes, "cid").withColumn("many", F.size("found") - needed + 1).filter("many > 0")
    return chosen.select("cid", "n", F.explode(F.slice("found", 1, F.col("many"))).alias("e")).selectExpr(
        "e.v as v", "cid", "n"
    )


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that have enough of their union sketch in common."""
    sketches = classes.select("cid", "sketch")
    joined = pairs.join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b")
    size = F.greatest(F.size("sa"), F.size("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, size)
    common = F.array_intersect(F.array_intersect(union, F.col("sa")), F.col("sb"))
    return joined.filter(100 * F.size(common) >= _least_share(percent) * F.size(union)).select("a", "b")


def _sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Full sets (cid, data, n) of the given classes, as n sorted 64-bit hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [hashing.shingles(t, words).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("cid"), pa.array(sets, pa.binary())], names=["cid", "data"])

    heads = classes.join(ids, "cid", "left_semi").select("cid", "id", "mark")
    wanted = _slim(docs, id_col, text_col).join(_if_few(stored(heads, "heads")), ["id", "mark"]).select("cid", "text")
    # Repeated rows give a set more than once.
    sets = by_batches(wanted, work, "cid bigint, data binary").dropDuplicates(["cid"])
    return stored(sets.withColumn("n", (F.length("data") / 8).cast("bigint")), "sets")


def _if_few(stored_rows: DataFrame) -> DataFrame:
    """The rows, to be broadcast if they are few."""
    return F.broadcast(stored_rows) if stored_rows.count() <= FEW_IDS else stored_rows


def _alike(both: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of x and y elements, ``both`` of them common, have the similarity."""
    return 100 * both >= percent * (x + y - both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have a Jaccard similarity of at least ``percent`` hundredths."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("da"), batch.column("db")
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(_alike(both, len(x), len(y), percent)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = sets.select("cid", "data")
    joined = pairs.join(sets.toDF("a", "da"), "a").join(sets.toDF("b", "db"), "b")
    return by_batches(joined.select("a", "b", "da", "db"), compare, "a bigint, b bigint")


def _split(lists: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b) of the short lists whose sizes allow the similarity; families (cid, family) of the long ones."""
    sizes = lists.groupBy("v").agg(F.count(F.lit(1)).alias("entries"), F.min("cid").alias("head"))
    marked = stored(lists.join(sizes.filter("entries > 1"), "v"), "lists")
    short = marked.filter(F.col("entries") <= SHORT).select("v", "cid", "n")
    other = short.toDF("v", "y", "yn")
    close = 100 * F.least("n", "yn") >= percent * F.greatest("n", "yn")
    pairs = short.join(other, "v").filter(F.col("cid") < F.col("y")).filter(close)
    edges = marked.filter(F.col("entries") > SHORT).select(F.col("head").alias("a"), F.col("cid").alias("b"))
    families = components(edges).select(F.col("id").alias("cid"), F.col("label").alias("family"))
    return pairs.select(F.col("cid").alias("a"), F.col("y").alias("b")).distinct(), families


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    values = [np.unique(np.concatenate(side)) for side in (left, right)]
    shared = np.intersect1d(*values, assume_unique=True)
    places = []
    for side in (left, right):
        rows = np.repeat(np.arange(len(side)), [len(s) for s in side])
        flat = np.concatenate(side)
        at = np.searchsorted(shared, flat)
        known = at < len(shared)
        known[known] = shared[at[known]] == flat[known]
        order = np.argsort(at[known], kind="stable")
        places.append((rows[known][order], at[known][order]))
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(shared), COLUMNS):
        pair = []
        for (rows, at), side in zip(places, (left, right)):
            first, last = np.searchsorted(at, [start, start + COLUMNS])
            matrix = np.zeros((len(side), min(COLUMNS, len(shared) - start)), np.float32)
            matrix[rows[first:last], at[first:last] - start] = 1
            pair.append(matrix)
        total += pair[0] @ pair[1].T
    # Counts below 2**24 are exact in single precision; a block has fewer common shingles.
    return total.astype(np.int64)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row, column) that connect all that a matrix of links connects, and no more."""
    new_row, new_column = np.ones(linked.shape[0], bool), np.ones(linked.shape[1], bool)
    edges = []
    for start in np.flatnonzero(linked.any(axis=1)):
        if not new_row[start]:
            continue
        new_row[start] = False
        rows = [start]
        while rows:
            row = rows.pop()
            for column in np.flatnonzero(linked[row] & new_column):
                new_column[column] = False
                edges.append((row, column))
                for other in np.flatnonzero(linked[:, column] & new_row):
                    new_row[other] = False
                    edges.append((other, column))
                    rows.append(other)
    return edges


def _family_links(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what is linked within each family."""

    def compare(table: pa.Table) -> pa.Table:
        sides = []
        for name in ("i", "j"):
            side = table.filter(pc.equal(table.column("block"), table.column(name)))
            data = side.column("data").combine_chunks()
            sides.append((side.column("cid").to_numpy(), [np.frombuffer(d.as_buffer(), np.uint64) for d in data]))
        (a_ids, a_sets), (b_ids, b_sets) = sides
        edges = []
        if len(a_sets) and len(b_sets):
            x, y = (np.array([len(s) for s in side], np.int64) for side in (a_sets, b_sets))
            both = _common(a_sets, b_sets)
            linked = _alike(both, x[:, None], y[None, :], percent) & (a_ids[:, None] != b_ids[None, :])
            edges = _forest(linked)
        rows, columns = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(a_ids[rows], pa.int64()), "b": pa.array(b_ids[columns], pa.int64())})

    units = _blocks(sets.join(families, "cid"), percent)
    return units.groupBy("family", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def _parts(total: Column, at_most: int) -> Column:
    """Blocks that a family needs for ``total`` classes or shingles."""
    return F.greatest(F.least(total * FINER / at_most, F.lit(EVEN)), total / at_most)


def _blocks(held: DataFrame, percent: int) -> DataFrame:
    """Each class (family, cid, data, block, i, j) once for each pair i <= j of blocks it takes part in.

    Blocks are even slices of a family in the order of set sizes, ties by a hash;
    beyond EVEN of them, slices are cut by a second hash.
    """
    place = F.col("n") + F.pmod(F.xxhash64("cid"), F.lit(1 << 20)) / (1 << 20)
    cuts = [k / EVEN for k in range(1, EVEN)]
    count = F.count(F.lit(1))
    many = F.greatest(_parts(count, BLOCK_CLASSES), _parts(F.sum("n"), BLOCK_SHINGLES))
    sizes = held.select("family", "n", place.alias("place")).groupBy("family")
    sizes = sizes.agg(F.ceil(many).cast("int").alias("blocks"), F.percentile_approx("place", cuts, 1000).alias("cuts"))
    # One block needs no cuts, and most families are one.
    cuts = F.when(F.col("blocks") > 1, F.col("cuts")).otherwise(F.array().cast("array<double>"))
    sizes = _if_few(stored(sizes.select("family", "blocks", cuts.alias("cuts")), "families"))
    placed = held.withColumn("place", place).join(sizes, "family")
    at = F.size(F.filter("cuts", lambda c: c < F.col("place")))
    even = F.floor(at * F.least("blocks", F.lit(EVEN)) / EVEN).cast("int")
    deep = F.pmod(F.xxhash64("cid", F.lit("deep")), F.ceil(F.col("blocks") / EVEN)).cast("int")
    placed = placed.withColumn("block", even + EVEN * deep)
    ranges = placed.groupBy("family", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    ranges = ranges.groupBy("family").agg(F.collect_list(F.struct("block", "lo", "hi")).alias("ranges"))
    ranges = _if_few(stored(ranges, "ranges"))
    # A class meets a block that has sets of a size like its own block's.
    own = F.filter("ranges", lambda r: r["block"] == F.col("block"))[0]
    meets = F.filter(
        F.col("ranges"),
        lambda r: (100 * r["hi"] >= percent * F.col("own")["lo"]) & (100 * F.col("own")["hi"] >= percent * r["lo"]),
    )
    met = placed.select("family", "cid", "data", "block").join(ranges, "family").withColumn("own", own)
    met = met.select("family", "cid", "data", "block", F.explode(meets["block"]).alias("other"))
    return met.select(
        "family", "cid", "data", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, exact: bool) -> DataFrame:
    """Per row: id, mark, n, answer (smallest id of its component), chosen (its class is the one that stays)."""
    if not 0 < percent <= 100 or words < 1:
        raise ValueError("percent is 1 to 100, words at least 1")
    members = stored(_members(docs, id_col, text_col, words, percent if exact else None), "members")
    classes = members.filter("sketch is not null")
    pairs, families = _split(_postings(classes.select("cid", "n", "sketch"), percent, exact), percent)
    pairs, families = stored(pairs if exact else _estimated(pairs, classes, percent), "candidates"), stored(families, "families")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("cid")).union(families.select("cid")).distinct()
    sets = _sets(ids, classes, docs, id_col, text_col, words)
    links = _verified(pairs, sets, percent).unionByName(_family_links(families, sets, percent))
    labels = components(links).select(F.col("id").alias("cid"), "label").join(classes.select("cid", "least"), "cid")
    tops = labels.groupBy("label").agg(F.min(F.struct("least", "cid")).alias("top"))
    answers = labels.join(tops, "label").select("cid", F.col("top.least").alias("answer"), (F.col("top.cid") == F.col("cid")).alias("chosen"))
    members = members.select("id", "mark", "n", "cid", "least").join(answers, "cid", "left")
    return members.select(
        "id", "mark", "n", F.coalesce("answer", "least").alias("answer"), F.coalesce("chosen", F.lit(True)).alias("chosen")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    exact: bool = False,
) -> DataFrame:
    """One row per document: its id, n_shingles, component_id and kept.

    Words are split at ASCII white space, with A-Z in lower case; a document's
    set holds its distinct runs of ``words`` words, or its whole sequence if that
    is shorter, as 64-bit hashes. Documents are linked at a Jaccard similarity of
    ``percent`` hundredths; a component is named by its smallest id, and that
    document is kept. A null or empty text, or one without words, is linked with
    nothing and kept. A row without an id is linked with nothing and kept, with a
    null component; an id that is no number counts as none. Repeated rows are
    copies of one document and get the same answer. Rows that share an id but not
    a text are documents of their own: each has the component of its own text. An
    empty table gives no rows; other columns are not read.

    A pair that shares less than half of a sketch is no candidate, a chance below
    one in a million at 80 hundredths. ``exact`` takes a part of each set instead
    of a sketch that any linked pair must share a value of, which loses none but
    writes about (100 - percent) hundredths of all shingles.
    """
    found = _labelled(docs, id_col, text_col, words, percent, exact)
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("answer").alias("component_id"),
        F.coalesce(F.col("answer") == F.col("id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    exact: bool = False,
) -> DataFrame:
    """The documents that stay, one of each component, with the columns they came with.

    As ``near_duplicates``; where texts of one id are linked, those with the set of
    one of them stay. Up to FEW_IDS dropped rows no text is moved for this.
    """
    found = _labelled(docs, id_col, text_col, words, percent, exact)
    stays = F.coalesce((F.col("answer") == F.col("id")) & F.col("chosen"), F.lit(True))
    dropped = _if_few(stored(found.filter(~stays).select("id", "mark").distinct(), "dropped"))
    same = (docs[id_col].cast("bigint") == dropped["id"]) & (F.xxhash64(docs[text_col]) == dropped["mark"])
    return docs.join(dropped, same, "left_anti")
