"""Control streams on streams: every record sees the rule that was in force at its time.

The control stream is written to a *rule log* by one query; each version is in force from its time to the next
one's. The query over the records joins each micro-batch with the versions that its records can see. Records that are
ahead of the control stream's own watermark wait in a held table, so a rule that is read later than the records it
governs still reaches them, and the result is that of the batch operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.operators.rules import block_listed, hit_by_latest_rule
from brooklet.streaming.held import Held

Sink = Callable[[DataFrame, int], None]


class RuleLog:
    """All versions of a control stream with columns ``ts``, ``id_col`` and a payload, a folder per micro-batch."""

    def __init__(self, folder: str, schema: T.StructType, ts: str, id_col: str, delay_ms: int = 0):
        self.folder, self.schema, self.ts, self.id_col, self.delay_ms = folder, schema, ts, id_col, delay_ms

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function of the control stream; a replayed batch overwrites itself."""
        batch.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.folder)

    def watermark(self, log: DataFrame) -> int | None:
        """Microseconds before which no more rules come: the latest time seen, less the delay."""
        top = log.agg(F.max(F.unix_micros(F.col(self.ts).cast("timestamp")))).first()[0]
        return None if top is None else top - 1000 * self.delay_ms

    def in_force(self, log: DataFrame, records: DataFrame) -> DataFrame:
        """The versions that ``records`` can see: those of their time span, and the one in force when it begins."""
        low, high = records.agg(F.min(self.ts), F.max(self.ts)).first()
        if low is None:
            return log.limit(0)
        head = log.where(F.col(self.ts) <= F.lit(low)).orderBy(F.col(self.ts).desc(), F.col(self.id_col).desc()).limit(1)
        return head.unionByName(log.where((F.col(self.ts) > F.lit(low)) & (F.col(self.ts) <= F.lit(high))))


def with_rules(log: RuleLog, held: Held, apply: Callable[[DataFrame, DataFrame], DataFrame], sink: Sink) -> Sink:
    """A ``foreachBatch`` function for records with the log's ``ts``: ``apply(records, rules)`` is given the records
    whose rules are all known, those of earlier batches included, and ``sink`` its result. Others are held; ``held``
    has the schema of the records."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rules = log.read(spark)
        mark = log.watermark(rules)
        us = F.unix_micros(F.col(log.ts).cast("timestamp"))
        known = F.lit(False) if mark is None else F.coalesce(us < mark, F.lit(False))
        pending = held.before(spark, batch_id).unionByName(batch.select(*held.schema.fieldNames()))
        held.write(pending.where(~known), batch_id)
        ready = pending.where(known)
        sink(apply(ready, log.in_force(rules, ready)), batch_id)

    return run


def block_listed_stream(log: RuleLog, held: Held, word: str, words: str, default: list[str], sink: Sink) -> Sink:
    """Streaming form of ``rules.block_listed``; ``tag`` tells the side outputs apart."""
    return with_rules(log, held, lambda records, rules: block_listed(records, rules, log.ts, log.id_col, word, words, default), sink)


def matching_rule_stream(log: RuleLog, held: Held, action: str, first: str, second: str, payload: list[str], sink: Sink, prev: str = "prev_action") -> Sink:
    """Streaming form of ``rules.matching_rule``, for records that have their key's previous action in ``prev``
    (``processors.with_previous_stream``)."""
    return with_rules(log, held, lambda records, rules: hit_by_latest_rule(records, rules, log.ts, log.id_col, action, first, second, payload, prev), sink)
