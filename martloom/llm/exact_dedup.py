"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition starts with a sorted run of (digest, identifier, count).
In each round the partitions of a group exchange parts of their runs, by some
bits of the digest, each part to the task that has its place, and each merges the
parts it got, keeping one entry per digest. After the last round a partition holds
all there is about its digests. A group of copies shrinks to one entry per partition
before anything moves, so no task ever sees the rows of a large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import by_batches, stored

# An entry of a run: same is the number of rows of the group that have the id that stays.
RUN = "slot int, digest binary, keep_id bigint, group_size bigint, same bigint"
# Groups with at least this share of all rows are joined by broadcast: there are
# at most 1 / HOT_SHARE of them, whatever the size of the table.
HOT_SHARE = 1e-3
# Groups up to which all are joined by broadcast (48 bytes each): no text moves then.
FEW_GROUPS = 500_000


def digest_of(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, as bytes; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _merged(keep: str):
    """Merges the sorted entries of a partition, streaming: neighbours with one digest become one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_entry = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if open_entry is not None:
                batch = pa.concat_batches([open_entry, batch])
            merged = _neighbours(batch, keep)
            # The next batch may go on with the last digest.
            open_entry = merged.slice(merged.num_rows - 1)
            yield merged.slice(0, merged.num_rows - 1)
        if open_entry is not None:
            yield open_entry

    return work


def _neighbours(batch: pa.RecordBatch, keep: str) -> pa.RecordBatch:
    """One entry for each run of equal slots and digests."""
    changes = np.ones(batch.num_rows, bool)
    slot, digest = batch.column("slot"), batch.column("digest")
    differ = [pc.not_equal(c.slice(1), c.slice(0, batch.num_rows - 1)) for c in (slot, digest)]
    changes[1:] = pc.or_(*differ).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(changes)
    ids, known = batch.column("keep_id"), batch.column("keep_id").is_valid().to_numpy(zero_copy_only=False)
    worst = np.iinfo(np.int64).min if keep == "largest" else np.iinfo(np.int64).max
    numbers = ids.fill_null(worst).to_numpy(zero_copy_only=False)
    best = (np.maximum if keep == "largest" else np.minimum).reduceat(numbers, starts)
    any_known = np.logical_or.reduceat(known, starts)
    of_entry = np.cumsum(changes) - 1
    # Entries without an id count only in a group where no row has one.
    stays = (numbers == best[of_entry]) & (known == any_known[of_entry])
    same = np.where(stays, batch.column("same").to_numpy(zero_copy_only=False), 0)
    at = pa.array(starts)
    columns = [
        slot.take(at),
        digest.take(at),
        pa.array(best, pa.int64(), mask=~any_known),
        pa.array(np.add.reduceat(batch.column("group_size").to_numpy(zero_copy_only=False), starts)),
        pa.array(np.add.reduceat(same, starts)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def rounds_for(partitions: int, fan_in: int) -> int:
    """Rounds until every pair of partitions has met, ``fan_in`` runs at a time."""
    rounds = 1
    while fan_in**rounds < partitions:
        rounds += 1
    return rounds


def merged_runs(entries: DataFrame, keep: str = "smallest", fan_in: int = 8) -> DataFrame:
    """One row (digest, keep_id, group_size, same) per digest of ``entries`` (digest, id)."""
    spark = entries.sparkSession
    rounds = rounds_for(int(spark.conf.get("spark.sql.shuffle.partitions")), fan_in)
    size = fan_in**rounds
    work = _merged(keep)
    runs = entries.select(
        F.pmod(F.spark_partition_id(), F.lit(size)).cast("int").alias("slot"),
        "digest",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(1).cast("bigint").alias("same"),
    )
    runs = by_batches(runs.sortWithinPartitions("slot", "digest"), work, RUN)
    for level in range(rounds):
        step = fan_in**level
        # The digest chooses the place of the partition within its group of this round.
        part = F.pmod(F.shiftright(F.xxhash64("digest"), 8 * level), F.lit(fan_in)).cast("int")
        own = F.pmod(F.floor(F.col("slot") / step), F.lit(fan_in)).cast("int")
        runs = runs.withColumn("slot", F.col("slot") + (part - own) * step)
        runs = runs.repartitionById(size, "slot").sortWithinPartitions("slot", "digest")
        runs = by_batches(runs, work, RUN)
    return runs.drop("slot")


def _groups(docs: DataFrame, id_col: str, text_col: str, keep: str, fan_in: int) -> DataFrame:
    """Groups of two rows or more (digest, keep_id, group_size, same), written."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    entries = docs.select(F.col(id_col).cast("bigint").alias("id"), digest_of(F.col(text_col)).alias("digest"))
    return stored(merged_runs(entries, keep, fan_in).filter("group_size > 1"), "digest-groups")


def _found(docs: DataFrame, id_col: str, text_col: str, groups: DataFrame) -> DataFrame:
    """Rows (row: all columns, digest, found: entry of their group or null).

    Few groups are joined by broadcast. Of more, only the large ones are, and the
    others meet the rows by digest.
    """
    entry = F.struct("keep_id", "group_size", "same")
    row = F.struct(*[docs[c] for c in docs.columns])
    marked = docs.select(row.alias("row"), docs[id_col].cast("bigint").alias("id"), digest_of(docs[text_col]).alias("digest"))
    if groups.count() <= FEW_GROUPS:
        return marked.join(F.broadcast(groups.select("digest", entry.alias("found"))), "digest", "left")
    large = F.col("group_size") >= max(2.0, HOT_SHARE * docs.count())
    hot = groups.filter(large).select("digest", entry.alias("hot"))
    cold = groups.filter(~large).select(F.col("digest").alias("key"), entry.alias("cold"))
    marked = marked.join(F.broadcast(hot), "digest", "left")
    # Rows of hot groups have their answer; a key of their own spreads them in the next join.
    spread = F.concat(F.lit("-"), F.xxhash64("id").cast("string")).cast("binary")
    key = F.when(F.col("hot").isNull(), F.col("digest")).otherwise(spread)
    marked = marked.withColumn("key", key).join(cold, "key", "left")
    return marked.select("row", "id", "digest", F.coalesce("hot", "cold").alias("found"))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = 8
) -> DataFrame:
    """One row per document: its id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical; the whole 256-bit digest is compared.
    A null text counts as empty. Of equal texts the smallest (or ``largest``)
    id stays. A row without an id stays only if no row of its group has one.
    Rows that repeat id and text of the kept one are all marked kept. An empty
    table gives an empty result; other columns are not read.
    """
    docs = docs.select(id_col, text_col)
    found = _found(docs, id_col, text_col, _groups(docs, id_col, text_col, keep, fan_in))
    alone = F.col("found").isNull()
    keep_id = F.when(alone, F.col("id")).otherwise(F.col("found.keep_id"))
    return found.select(
        F.col("row").getField(id_col).alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("found.group_size", F.lit(1).cast("bigint")).alias("group_size"),
        keep_id.eqNullSafe(F.col("id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = 8
) -> DataFrame:
    """The documents that stay, with the columns they came with.

    As ``exact_duplicates``; of rows that repeat both id and text one stays. Only
    such rows, if there are any, move for that, and other texts only where there
    are more than FEW_GROUPS groups.
    """
    groups = _groups(docs, id_col, text_col, keep, fan_in)
    found = _found(docs, id_col, text_col, groups)
    kept = found.filter(F.col("found").isNull() | F.col("found.keep_id").eqNullSafe(F.col("id")))
    repeated = F.coalesce(F.col("found.same") > 1, F.lit(False))
    if not groups.filter("same > 1").isEmpty():
        once = kept.filter(repeated).dropDuplicates(["digest", "id"])
        kept = kept.filter(~repeated).unionByName(once)
    return kept.select("row.*")
