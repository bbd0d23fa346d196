"""Line dedup against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brooklet.llm import line_dedup
from brooklet.llm.line_dedup import Geometry, drop_repeated_lines
from tests.llm.odd import TEXTS, empty_docs, odd_docs

BLANK = " \t\n\x0b\x0c\r"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))


def brute(docs):
    last = lambda i: (i is None, i or 0)
    holders = {}
    for id, text in docs:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 10:
                holders.setdefault(key_of(line), set()).add(last(id))
    out = []
    for id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(h := holders.get(key_of(x), ())) > 1 and min(h) != last(id))]
        out.append((id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def some_texts(rng):
    lines = ["A shared line of text", "  a SHARED line of text\t", "short", "", " ", "é" * 9, "é" * 10, "\x0bten chars!\x0c", "TEN CHARS!", "日本語日本語日本語日本", "x" * 30_000, "\r", "own"]
    texts = [*TEXTS, "\n", "\n\n\n", "a\n", "\na", "A shared line of text\nA shared line of text\n"]
    return texts + ["\n".join(rng.choice([*lines, f"line number {rng.randrange(40)}"]) for _ in range(rng.randrange(1, 30))) for _ in range(80)]


@pytest.mark.parametrize(
    "geometry",
    [None, Geometry(1000, slice_bits=1 << 10), Geometry(1000, slice_bits=1 << 10, twice_bits=64), Geometry(0, slice_bits=8, twice_bits=8)],
    ids=["whole", "slices", "full twice filter", "one full slice"],
)
def test_against_brute_force(spark, geometry):
    docs = odd_docs(spark, some_texts(random.Random(5)))
    docs = docs.unionByName(docs.where("doc_id IN (30, 31)")).withColumns({c: F.lit("clash") for c in ("line", "digest", "first", "gone", "lines", "slice")})
    got = sorted((tuple(r) for r in drop_repeated_lines(docs, geometry=geometry).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_hot_lines_are_told_apart_by_a_list(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LEAST_HOT", 5)
    texts = [f"the very common line\nown line number {i // 2}\nend" for i in range(60)]
    docs = odd_docs(spark, texts)
    got = sorted((tuple(r) for r in drop_repeated_lines(docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_lines_of_a_batch():
    texts = ["a\n\nb", "", None, "\n", " Xy z \nQ"]
    lines = line_dedup.Lines(pa.array(texts))
    spans = [(t, p, bytes(lines.data[s:e]).decode()) for t, p, s, e in zip(lines.text, lines.place, lines.starts, lines.ends)]
    assert spans == [(0, 0, "a"), (0, 1, ""), (0, 2, "b"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (3, 1, ""), (4, 0, "xy z"), (4, 1, "q")]


def test_filters_never_miss_and_rarely_suspect(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('unique line number ', id, '\nshared line number ', id % 1500) AS text")
    geometry = Geometry(8000)
    twice = line_dedup._twice_filter(docs.repartition(7), "text", 10, geometry)
    lines = line_dedup.Lines(pa.array([r.text for r in docs.orderBy("doc_id").collect()]))
    found = twice.has(lines.hashes(np.arange(len(lines.text))))
    assert found[1::2].all() and found[0::2].mean() < 0.01


def test_empty_tables(spark):
    assert drop_repeated_lines(empty_docs(spark)).count() == 0
