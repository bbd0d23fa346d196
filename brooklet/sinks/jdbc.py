"""Database sinks. Executors write a staging table in parallel; one transaction on the driver moves it over.

No row passes through the driver. The statements are standard SQL (``MERGE``) or, for databases without it,
``INSERT ... ON DUPLICATE KEY UPDATE``; ``dialect`` says which. ``options`` are those of Spark's JDBC writer, such
as user, password and driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    values = [c for c in df.columns if c not in (*keys, *order)]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__v"))
    return last.select(*keys, "__v.*")


def merge_sql(table: str, staging: str, keys: list[str], values: list[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    update = ", ".join(f"{v} = s.{v}" for v in values)
    names, fresh = ", ".join(keys + values), ", ".join(f"s.{c}" for c in keys + values)
    matched = f" WHEN MATCHED THEN UPDATE SET {update}" if values else ""
    return f"MERGE INTO {table} t USING {staging} s ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({fresh})"


def duplicate_key_sql(table: str, staging: str, keys: list[str], values: list[str]) -> str:
    names = ", ".join(keys + values)
    changes = ", ".join(f"{v} = VALUES({v})" for v in values) or f"{keys[0]} = {table}.{keys[0]}"
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON DUPLICATE KEY UPDATE {changes}"


UPSERT = {"standard": merge_sql, "duplicate_key": duplicate_key_sql}


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def staging_name(table: str, query_id: str, batch_id: int | str) -> str:
    """A staging table of its own for each writer and batch."""
    mark = hashlib.md5(f"{query_id}/{batch_id}".encode()).hexdigest()[:12]
    return f"{table}_staging_{mark}"


def connect(spark: SparkSession, url: str, options: Mapping[str, str]):
    """A driver-side connection. A driver class named in ``options`` is loaded as Spark loads it, from added jars too."""
    properties = spark._jvm.java.util.Properties()
    for name, value in options.items():
        if name != "driver":
            properties.setProperty(name, value)
    if driver := options.get("driver"):
        loader = spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()
        return loader.loadClass(driver).getDeclaredConstructor().newInstance().connect(url, properties)
    return spark._jvm.java.sql.DriverManager.getConnection(url, properties)


def in_transaction(
    spark: SparkSession, url: str, work: Callable[[Callable[[str], int], Callable[[str], bool]], None], options: Mapping[str, str] | None = None
) -> None:
    """Run ``work(execute, exists)`` on one driver-side connection; commit, or roll back on an error."""
    connection = connect(spark, url, options or {})
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        work(statement.executeUpdate, lambda q: statement.executeQuery(q).next())
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def stage(df: DataFrame, url: str, staging: str, batch_rows: int = 500, options: Mapping[str, str] | None = None) -> None:
    settings = {**(options or {}), "url": url, "dbtable": staging, "batchsize": str(batch_rows), "truncate": "true"}
    df.write.format("jdbc").options(**settings).mode("overwrite").save()


def upsert_jdbc(
    df: DataFrame, url: str, table: str, keys: list[str], order: list[str], staging: str | None = None,
    dialect: str = "standard", options: Mapping[str, str] | None = None,
) -> None:
    """Insert or replace rows by key, the latest row of a key winning."""
    staging = staging or staging_name(table, "upsert", uuid.uuid4().hex)
    rows = latest_per_key(df, keys, order)
    stage(rows, url, staging, options=options)
    statement = UPSERT[dialect](table, staging, keys, [c for c in rows.columns if c not in keys])

    def work(execute, exists):
        execute(statement)
        execute(f"DROP TABLE {staging}")

    in_transaction(df.sparkSession, url, work, options)


def ledger_statements(table: str, staging: str, ledger: str, query_id: str, batch_id: int, columns: list[str]) -> tuple[str, list[str]]:
    """The question whether a batch is done, and the statements that do it and say so."""
    names = ", ".join(columns)
    done = f"SELECT 1 FROM {ledger} WHERE query_id = {text_literal(query_id)} AND batch_id = {batch_id}"
    return done, [
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
        f"INSERT INTO {ledger} (query_id, batch_id) VALUES ({text_literal(query_id)}, {batch_id})",
    ]


def exactly_once_jdbc(url: str, table: str, ledger: str, query_id: str, options: Mapping[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: rows and the ledger entry commit together. The ledger is asked first, so that a
    replayed batch is not even staged, and once more inside the transaction."""

    def write(batch: DataFrame, batch_id: int) -> None:
        staging = staging_name(table, query_id, batch_id)
        done, statements = ledger_statements(table, staging, ledger, query_id, batch_id, batch.columns)
        finished: list[bool] = []
        in_transaction(batch.sparkSession, url, lambda execute, exists: finished.append(exists(done)), options)
        if finished[0]:
            return
        stage(batch, url, staging, options=options)

        def work(execute, exists):
            if not exists(done):
                for s in statements:
                    execute(s)
            execute(f"DROP TABLE {staging}")

        in_transaction(batch.sparkSession, url, work, options)

    return write
