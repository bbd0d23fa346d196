"""Passages that repeat inside one document, or under one id, against plain Python."""

import random

import numpy as np
import pytest

from brooklet.llm import repeats
from brooklet.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.test_dedup import words_of


def brute_own(docs, least):
    """By row: words in windows that occur at several places, all under the row's id; and those that another id has."""
    places = {}
    for i, text in dict.fromkeys(docs):
        w = words_of(text)
        for s in range(len(w) - least + 1):
            places.setdefault(tuple(w[s : s + least]), set()).add((i, text, s))
    out = []
    for i, text in docs:
        w, own, others = words_of(text), set(), set()
        for s in range(len(w) - least + 1):
            found = places[tuple(w[s : s + least])]
            if len({p[0] for p in found}) > 1:
                others |= set(range(s, s + least))
            elif len(found) > 1:
                own |= set(range(s, s + least))
        out.append((i, len(others), sorted(own)))
    return sorted(out)


@pytest.mark.parametrize("hot", [100_000, 2])
def test_repeats_of_one_document(spark, hot):
    rng = random.Random(12)
    passages = [[f"p{p}w{rng.randrange(30)}" for _ in range(rng.randrange(9, 25))] for p in range(12)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(5)):
            p = passages[i % 12] if rng.random() < 0.7 and i < 12 else rng.choice(passages[12 - 4 :])
            parts += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(8))] + p
        docs.append((i, " ".join(parts)))
    docs += [(100, "a b c d e f g h i j k l tail"), (100, "x a b c d e f g h i j k l"), (101, "z " * 40), (102, docs[3][1]), (102, docs[3][1])]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_repeated, sorted({w for s in r.own_spans for w in range(s.start, s.end)})) for r in repeats.find_repeats(table, least=10, shingle=6, hot=hot).collect())
    assert got == brute_own(docs, 10)
    assert any(own for _, _, own in got)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_repeated, sorted({w for s in r.own_spans for w in range(s.start, s.end)})) for r in QUERIES["op7_repeats"](spark, DATA).collect())
    assert got == brute_own(docs, 50)


def test_runs_agree_with_plain_comparison():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 3, 50).astype(np.uint64)
    side = rng.integers(0, 3, (50, 4)).astype(np.uint64)
    order, common, depth = repeats._runs(h, side)
    lead = [next((j for j in range(4) if side[i, j] == 0), 4) for i in range(50)]
    assert depth.tolist() == lead
    for length in range(5):
        numbers = repeats._run_numbers(order, common, length)
        for i in range(50):
            for j in range(50):
                if lead[i] >= length and lead[j] >= length:
                    assert (numbers[i] == numbers[j]) == (h[i] == h[j] and (side[i, :length] == side[j, :length]).all())
