"""Control streams: each record sees the latest rule that arrived before it.

Rules and records become one tagged sequence and the latest rule is carried along it, so neither the
number of rules nor the number of records is limited and nothing is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.operators.ordered import Last, Ordered


def with_latest_rule(df: DataFrame, rules: DataFrame, ts: str, id_col: str, payload: list[str]) -> DataFrame:
    """Add ``rule``, a struct of ``payload`` of the latest rule with ``rules.ts <= df.ts`` (null before the first).

    ``id_col`` orders records, and rules, of equal time; a rule comes before a record of the same time.
    """
    control = rules.select(ts, F.lit(0).alias("__kind"), F.col(id_col), F.struct(*payload).alias("__rule"))
    records = df.withColumn("__kind", F.lit(1))
    merged = records.unionByName(control, allowMissingColumns=True)
    is_rule = F.col("__kind") == 0
    seen = Ordered(merged, [], [ts, "__kind", id_col]).scan(rule=Last("__rule", where=is_rule))
    return seen.result().where(F.col("__kind") == 1).drop("__kind", "__rule")


def block_listed(df: DataFrame, rules: DataFrame, ts: str, id_col: str, word: str, words: str, default: list[str]) -> DataFrame:
    """Tag a record ``blocked`` if its word is in the latest word set (``default`` before the first), else ``passed``."""
    initial = F.array(*[F.lit(w) for w in default])
    rows = with_latest_rule(df, rules, ts, id_col, [words])
    rows = rows.withColumn("word_set", F.coalesce(F.col("rule")[words], initial)).drop("rule")
    hit = F.array_contains("word_set", F.col(word))
    return rows.withColumn("tag", F.when(hit, F.lit("blocked")).otherwise(F.lit("passed")))


def matching_rule(
    df: DataFrame, rules: DataFrame, ts: str, id_col: str, keys: list[str], action: str, first: str, second: str, payload: list[str]
) -> DataFrame:
    """Records whose key's previous action and own action are the two of the latest rule, with the rule's ``payload``."""
    before = Ordered(df, keys, [ts, id_col]).scan(prev_action=Last(action)).result()
    return hit_by_latest_rule(before, rules, ts, id_col, action, first, second, payload)


def hit_by_latest_rule(
    df: DataFrame, rules: DataFrame, ts: str, id_col: str, action: str, first: str, second: str, payload: list[str], prev: str = "prev_action"
) -> DataFrame:
    """The same for records that have their key's previous action in ``prev``."""
    rows = with_latest_rule(df, rules, ts, id_col, [first, second, *payload])
    hit = (F.col(prev) == F.col("rule")[first]) & (F.col(action) == F.col("rule")[second])
    return rows.where(hit).select(*df.columns, *[F.col("rule")[c].alias(c) for c in payload])


def apply_rules_batch(records: DataFrame, rules_path: str, join: Column, how: str = "left") -> DataFrame:
    """For ``foreachBatch``: join a micro-batch with the rules table as it is now (re-read every time). ``join`` should
    compare columns of both sides for equality: other conditions look at every rule for every record."""
    rules = records.sparkSession.read.parquet(rules_path)
    return records.alias("d").join(rules.alias("r"), join, how)
