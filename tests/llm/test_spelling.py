"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brooklet.llm import spelling
from brooklet.llm.queries import spoil
from tests.conftest import rows
from tests.llm.odd import CLASHING, TEXTS, empty_docs, odd_docs

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [v for v in counts if v != w and are_near(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def brute_counts(docs, spoiled):
    counts = Counter()
    for id, text in docs:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if spoiled and h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def vocabulary(rng):
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))): rng.randrange(1, 100) for _ in range(400)}
    long = "x" * 3000
    return words | {long: 5, long + "x": 50, long[:1500] + "y" + long[1501:]: 7, "y" + long: 200, "z": 1, "zz": 2, "zzz": 4}


@pytest.mark.parametrize("group_chars", [10**6, 300, 10])
def test_variants_against_brute_force(spark, group_chars):
    words = vocabulary(random.Random(1))
    table = spark.createDataFrame([(w, n, "clash", "clash") for w, n in words.items()], "word string, n bigint, near string, form string")
    got = spelling.group_variants(table, group_chars=group_chars)
    assert rows(got, "word", "form", "root", "n", "n_near", "form_n") == brute_variants(words)


def test_groups_dealt_again_are_small_and_lose_nothing(spark):
    # A third of all words agree in their first and last half.
    words = [a + m + b for a, b in (("abcdef", "uvwxyz"),) for m in (x + y for x in map(chr, range(97, 123)) for y in map(chr, range(97, 123)))]
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    sizes = spelling._dealt(table, 600).groupBy("size", "low", "high", "fixed").agg(F.sum(F.length("form")).alias("chars"), F.max(F.col("high") - F.col("low")).alias("free"))
    assert sizes.where("chars > 600 AND free > 1").count() == 0
    pairs = rows(spelling.near_words(table, 600), "word", "near")
    assert len(pairs) == len(set(pairs)) == 26 * 26 * 50


def test_chunks_end_at_groups(spark, monkeypatch):
    words = vocabulary(random.Random(2))
    monkeypatch.setattr(spelling, "CHUNK_CHARS", 50)
    batches = spelling._dealt(spark.createDataFrame(list(words.items()), "word string, n bigint"), 10**6).orderBy(*spelling._GROUP, "form")
    found = list(spelling._near_batches(batches.toArrow().to_batches(max_chunksize=37)))
    assert len(found) > 20
    pairs = {(w, v, h) for b in found for w, v, h in zip(*(b.column(c).to_pylist() for c in ("word", "near", "high")))}
    want = {(a, b) for a in words for b in words if a != b and are_near(a, b)}
    assert {(w, v) for w, v, _ in pairs} | {(w[::-1], v[::-1]) for w, v, _ in pairs} >= want


@pytest.mark.parametrize("spoiled", [False, True])
def test_words_of_odd_documents(spark, spoiled):
    rng = random.Random(3)
    texts = [*TEXTS, *(" ".join(rng.choice(["Theatre", "theater", "theaTre,", "ÀÉÿxyz", "naïves", "naives", "×÷æøå", "x" * 70, "ab"]) for _ in range(200)) for _ in range(5))]
    docs = odd_docs(spark, texts).withColumns({c: F.lit("clash") for c in ("word", "run", "form")})
    assert set(CLASHING) < set(docs.columns)
    counted = spelling.word_counts(docs, change=spoil if spoiled else None)
    plain = brute_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], spoiled)
    assert dict(rows(counted, "word", "n")) == plain
    assert rows(spelling.group_variants(counted)) == brute_variants(plain)


def test_ties_take_the_first_word_and_chains_go_to_the_end(spark):
    counts = {"baaaa": 1, "caaaa": 2, "daaaa": 2, "dbaaa": 4, "dbbaa": 8, "dbbba": 16, "dbbbb": 32, "zzzzz": 3}
    got = {r.word: (r.form, r.root, r.form_n) for r in spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()}
    assert got["baaaa"] == ("caaaa", "caaaa", 2)
    assert got["daaaa"] == ("dbaaa", "dbbbb", 4)
    assert got["zzzzz"] == (None, "zzzzz", None)


def test_empty_tables(spark):
    assert spelling.group_variants(spelling.word_counts(empty_docs(spark))).count() == 0
