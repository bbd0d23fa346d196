"""Sources and sinks without a live service: options, statements and files."""

import os

import pytest
from pyspark.sql import functions as F

from brooklet.operators import widecol
from brooklet.operators.aggregates import lag_report
from brooklet.session import discard_saved, saved
from brooklet.sinks import documents, jdbc, log
from brooklet.sources.files import elements, key_range, read_csv_table, read_lines
from brooklet.sources.generators import generate
from brooklet.sources.jdbc import Split, as_field_maps, jdbc_options
from brooklet.sources.log import decode_log
from tests.conftest import rows


def test_jdbc_reader_options():
    assert jdbc_options("jdbc:x", "SELECT * FROM t")["query"] == "SELECT * FROM t"
    split = jdbc_options("jdbc:x", "SELECT * FROM t", Split("id", "0", "100", 4))
    assert split["dbtable"] == "(SELECT * FROM t) src" and split["numPartitions"] == "4" and "query" not in split
    assert jdbc_options("jdbc:x", "t", Split("id", "0", "100", 4))["dbtable"] == "t"


def test_merge_statement():
    assert jdbc.merge_sql("person", "person_staging", ["name"], ["age", "height"]) == (
        "MERGE INTO person t USING person_staging s ON t.name = s.name WHEN MATCHED THEN UPDATE SET age = s.age, height = s.height "
        "WHEN NOT MATCHED THEN INSERT (name, age, height) VALUES (s.name, s.age, s.height)"
    )


def test_ledger_statements():
    done, todo = jdbc.ledger_statements("t", "t_staging", "ledger", "q", 3, ["a", "b"])
    assert done == "SELECT 1 FROM ledger WHERE query_id = 'q' AND batch_id = 3"
    assert todo == ["INSERT INTO t (a, b) SELECT a, b FROM t_staging", "INSERT INTO ledger (query_id, batch_id) VALUES ('q', 3)"]


def test_latest_per_key(spark):
    df = elements(spark, [("a", 1, 10), ("a", 2, 20), ("b", 1, 30)], "name string, o int, age int")
    assert rows(jdbc.latest_per_key(df, ["name"], ["o"])) == [("a", 20), ("b", 30)]


def test_reindexing_overwrites(spark):
    df = elements(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "name string, o int, v string")
    index = documents.to_documents(df, F.col("name"), ["name", "v"], ["o"])
    again = documents.upsert_documents(index, documents.to_documents(df.where("o = 1"), F.col("name"), ["v"], ["o"]))
    assert rows(again, "body") == [('{"v":"x"}',), ('{"v":"z"}',)]


def test_charset(spark, tmp_path):
    (tmp_path / "latin.txt").write_bytes("é;\"ü, ß\nzweite\n".encode("latin-1"))
    assert rows(read_lines(spark, str(tmp_path), "ISO-8859-1")) == [("zweite",), ('é;"ü, ß',)]


@pytest.mark.parametrize("charset, first", [("ISO-8859-1", "é1"), ("GBK", "中1"), ("UTF-8", "é1")])
def test_charset_keeps_every_line(spark, tmp_path, charset, first):
    lines = [first, "", "   ", "x\x01y", "end"]
    (tmp_path / "in.txt").write_bytes("\n".join(lines).encode(charset))
    assert sorted(r.value for r in read_lines(spark, str(tmp_path), charset).collect()) == sorted(lines)


def test_charset_that_cannot_be_split(spark, tmp_path):
    with pytest.raises(ValueError, match="ASCII"):
        read_lines(spark, str(tmp_path), "utf_16le")


def test_saved_tables_are_discarded(spark):
    kept = saved(spark.range(3).toDF("n"), "discard")
    path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert kept.count() == 3 and os.path.isdir(path)
    discard_saved(spark)
    assert not os.path.exists(path)


def test_lag_compares_all_partitions(spark):
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 100), ("u", 0, 5)], "topic string, partition int, end_offset long")
    done = [("a", "t", 0, 4), ("a", "t", 2, 7), ("b", "t", 0, 9), ("b", "t", 1, 90), ("b", "u", 0, 5)]
    committed = spark.createDataFrame(done, "`group` string, topic string, partition int, committed long")
    assert rows(lag_report(ends, committed)) == [("a", "t", None, "lost"), ("a", "u", None, "lost"), ("b", "t", 11, "ok"), ("b", "u", 0, "ok")]


def test_wide_column_conditions_name_the_projection(spark):
    df = spark.createDataFrame([("r1", {"f:a": "x", "f:b": "y", "f:c": "z"}), ("r2", {"f:b": "y"})], "rowkey string, cols map<string,string>")
    cells = lambda **terms: {r.rowkey: r.cols for r in widecol.scan(df, **terms).collect()}
    assert cells(equal=["f:a:x"]) == {"r1": {"f:a": "x"}}
    assert cells(regexes=["f:a:^x"], columns=["f:b"]) == {"r1": {"f:a": "x", "f:b": "y"}, "r2": {"f:b": "y"}}
    assert cells(containing=["f:a:X"]) == {"r1": {"f:a": "x", "f:b": "y", "f:c": "z"}, "r2": {"f:b": "y"}}


def test_csv_view(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,a\n2,b\n")
    read_csv_table(spark, str(tmp_path), "id int, name string", view="csv_view")
    assert rows(spark.sql("SELECT name FROM csv_view WHERE id = 2")) == [("b",)]


def test_log_formats_and_offsets(spark):
    records = elements(spark, [("t", 0, o, str(o), f"{o},{o * 2}") for o in range(5)] + [("u", 0, 9, "k", "1,2")], "topic string, partition int, offset long, key string, value string")
    starts = elements(spark, [("t", 0, 3)], "topic string, partition int, start long")
    got = decode_log(records, "a int, b int", fmt="csv", topics=["t"], start_offsets=starts)
    assert rows(got, "offset", "a", "b") == [(3, 3, 6), (4, 4, 8)]
    assert decode_log(records, fmt="text").count() == 6


def test_log_partition_of_a_key(spark):
    got = log.with_partition(elements(spark, [("hello",), (None,)], "key string"), 10)
    assert rows(got) == [("hello", 2), (None, 0)]


def test_key_range_spans_blocks(spark):
    assert rows(key_range(elements(spark, [(7,), (3,)], "n long"), "n", block=3)) == [(i,) for i in range(8)]


def test_generator_repeats(spark):
    once, twice = generate(spark, "sensors", 50, seed=1), generate(spark, "sensors", 50, seed=1)
    assert rows(once) == rows(twice)
    assert once.select("sensor").distinct().count() == 10 and once.where("temp < 55 OR temp > 65").count() == 0


def test_field_maps(spark):
    got = as_field_maps(elements(spark, [(1, None)], "id int, name string")).first()[0]
    assert got == {"id": "1", "name": None}


def test_upsert_without_merge():
    statement = jdbc.UPSERT["duplicate_key"]("t", "s", ["a"], ["b", "c"])
    assert statement == "INSERT INTO t (a, b, c) SELECT a, b, c FROM s ON DUPLICATE KEY UPDATE b = VALUES(b), c = VALUES(c)"
    assert jdbc.UPSERT["duplicate_key"]("t", "s", ["a"], []).endswith("UPDATE a = t.a")


def test_each_writer_has_its_staging_table_and_names_are_quoted():
    names = {jdbc.staging_name("t", q, b) for q in ("q1", "q2") for b in (0, 1)}
    assert len(names) == 4 and names == {jdbc.staging_name("t", q, b) for q in ("q1", "q2") for b in (0, 1)}
    done, statements = jdbc.ledger_statements("t", "s", "l", "it's", 3, ["a"])
    assert "query_id = 'it''s'" in done and "VALUES ('it''s', 3)" in statements[1]


@pytest.mark.parametrize("finished", [True, False])
def test_the_ledger_is_asked_before_staging(spark, monkeypatch, finished):
    calls = []

    def transaction(session, url, work, options):
        work(lambda s: calls.append(s.split(" ")[0]), lambda q: calls.append("ask") or finished)

    monkeypatch.setattr(jdbc, "in_transaction", transaction)
    monkeypatch.setattr(jdbc, "stage", lambda *a, **k: calls.append(("stage", k["options"]["user"])))
    jdbc.exactly_once_jdbc("jdbc:x", "t", "l", "q", {"user": "u"})(spark.range(1), 5)
    assert calls == (["ask"] if finished else ["ask", ("stage", "u"), "ask", "INSERT", "INSERT", "DROP"])
