"""Exact de-duplication with an extendible-hash index kept in shared files; DataFrame functions only.

Every text gets a 64-bit key, the hash of its normal form. The leading bits of a key choose a cell of the
directory. A bucket with more than ``capacity`` distinct keys is split by one more bit, which doubles the
directory there, until no bucket is overfull. A bucket is a key range and belongs to one task, which writes its part
of the index in key order: of every key how many rows have it and, of a single row, the row's answer.

A key that several rows share holds a chain. Its texts, equal ones merged before they move, go to the owner of the
bucket, which compares them by their bytes; one text that fills a third of the table sends one row per task. Rows
look their answer up in the chains; chains of very many rows are told to all tasks instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import fresh, small_enough
from brooklet.session import saved

FIRST_BITS = 6  # the directory starts with 64 buckets
HOT_CHAINS = 100_000  # rows of the list of long chains, at most
CELL_BITS = 20  # and is never finer than 2^20 cells: what shares a cell stays together


def normal_form(text: Column) -> Column:
    """Runs of blanks become one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _cell(key: str) -> Column:
    return F.shiftrightunsigned(key, 64 - CELL_BITS)


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """``cell -> bucket``: the bucket is the first cell of its key range. ``keys`` has distinct ``key``."""
    cells = saved(keys.groupBy(_cell("key").alias("cell")).agg(F.count("*").alias("size")), "dedup-cells")
    table = cells.withColumn("depth", F.lit(FIRST_BITS))
    while True:
        shift = F.lit(CELL_BITS) - F.col("depth")
        table = table.withColumn("bucket", F.expr(f"shiftleft(shiftright(cell, {CELL_BITS} - depth), {CELL_BITS} - depth)")).drop("full")
        full = table.groupBy("bucket", "depth").agg(F.sum("size").alias("total")).where((F.col("total") > capacity) & (shift > 0))
        if full.isEmpty():
            return table.select("cell", "bucket")
        split = full.select("bucket", "depth", F.lit(1).alias("full"))
        table = table.join(split, ["bucket", "depth"], "left").withColumn("depth", F.col("depth") + F.coalesce("full", F.lit(0)))
        table = saved(table.select("cell", "size", "depth"), "dedup-directory")


def build_index(entries: DataFrame, capacity: int) -> DataFrame:
    """The index, written by bucket and key and read back: ``bucket, key, n``, and ``row``, an entry of the key."""
    keys = saved(entries.groupBy("key").agg(F.count("*").alias("n"), F.first(F.struct("id", "sha")).alias("row")), "dedup-keys")
    cells = F.broadcast(directory(keys, capacity))  # 2^CELL_BITS rows at most
    slots = keys.withColumn("cell", _cell("key")).join(cells, "cell").select("bucket", "key", "n", "row")
    return saved(slots.repartition("bucket").sortWithinPartitions("bucket", "key"), "dedup-index")


def find_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = 250_000) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if their normal forms are. Of equal texts the smallest id stays. Null is the empty text;
    an empty table gives no rows. Rows with a null id lose to any other id (``keep_id`` is null if all ids of
    the group are). Rows that repeat both id and text are one document: each is counted, all share its
    verdict. Other columns of ``docs`` are not looked at, whatever their names.
    """
    rows = docs.select(F.col(id).alias("id"), normal_form(F.col(text)).alias("normal"))
    rows = rows.select("id", "normal", F.xxhash64("normal").alias("key"))
    entries = saved(rows.select("id", "key", F.sha2("normal", 256).alias("sha")), "dedup-entries")
    index = build_index(entries, capacity)
    shared = saved(index.where("n > 1").select("bucket", "key"), "dedup-shared")
    merged = rows.join(small_enough(shared), "key").groupBy("bucket", "key", "normal").agg(F.min("id").alias("keep"), F.count("*").alias("size"))
    # The owner of a bucket has its chains in order, and of each text one row.
    owned = merged.repartition("bucket").sortWithinPartitions("bucket", "key", "normal")
    chains = saved(owned.select("key", F.sha2("normal", 256).alias("sha"), "keep", "size"), "dedup-chains")
    single = index.where("n = 1").select("row.id", "row.sha", F.col("row.id").alias("keep"), F.lit(1).cast("bigint").alias("size"))
    copied = entries.join(small_enough(shared.select("key")), "key")
    most = max(1_000, entries.count() // HOT_CHAINS)
    hot = F.broadcast(chains.where(F.col("size") > most))  # fewer than HOT_CHAINS rows
    told = copied.join(hot, ["key", "sha"]).unionByName(copied.join(hot.select("key", "sha"), ["key", "sha"], "left_anti").join(chains.where(F.col("size") <= most), ["key", "sha"]))
    answers = single.unionByName(told.select("id", "sha", "keep", "size"))
    return answers.select(
        F.col("id").alias(id),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = 250_000) -> DataFrame:
    """The rows of ``docs`` that ``find_copies`` marks kept, with all their columns.

    Rows are known by id and normal form: a null id or a repeated id takes no other text with it.
    """
    own_id, own_sha = fresh(docs, "dropped_id"), fresh(docs, "dropped_sha")
    named = F.col(id).alias(own_id), F.unhex("text_sha256").alias(own_sha)
    dropped = saved(find_copies(docs, id, text, capacity).where("NOT kept").select(*named).distinct(), "dedup-dropped")
    match = docs[id].eqNullSafe(F.col(own_id)) & (F.unhex(F.sha2(normal_form(docs[text]), 256)) == F.col(own_sha))
    return docs.join(small_enough(dropped), match, "left_anti")
