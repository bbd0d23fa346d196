import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from brooklet.llm.exact_dedup import drop_copies, find_copies
from brooklet.llm.near_dedup import MinHash, _survivors, components, drop_near_copies, link_near_copies
from tests.llm.odd import TEXTS, empty_docs, odd_docs


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(texts, k=2):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_exact_against_brute_force(spark):
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in find_copies(odd_docs(spark), capacity=2).collect()}
    plain = {}
    listed = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id"), (5, "another text of five")]
    for i, t in listed:
        plain.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    want = set()
    for ids in plain.values():
        least = min((i for i in ids if i is not None), default=None)
        want |= {(i, least, len(ids), i == least) for i in ids}
    assert rows == want


def test_exact_keeps_columns_and_takes_empty_tables(spark):
    docs = odd_docs(spark)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert find_copies(empty_docs(spark)).count() == 0 and drop_copies(empty_docs(spark)).count() == 0


def test_exact_drops_what_find_copies_drops(spark):
    docs = odd_docs(spark, [*TEXTS, "no id"]).select("doc_id", "text")
    more = spark.createDataFrame([(None, "alone"), (None, "two words"), (40, "a"), (41, "a"), (41, "b"), (None, None)], docs.schema)
    docs = docs.union(more)
    plain = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    want = Counter((r.doc_id, r.text_sha256) for r in find_copies(docs).where("kept").collect())
    got = Counter((r.doc_id, plain(r.text)) for r in drop_copies(docs).collect())
    assert got == want
    assert {(None, plain("alone")), (41, plain("b"))} <= set(got) and not {(None, plain("no id")), (None, plain("two words")), (41, plain("a"))} & set(got)


def test_splitting_the_directory_changes_nothing(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id % 1700) AS text")
    few, many = (find_copies(docs, capacity=c).orderBy("doc_id").collect() for c in (3, 10**6))
    assert few == many


def family(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, i = {}, 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 40, 120]))]
        for _ in range(rng.randrange(1, 12)):
            texts[i] = family(rng, base, rng.randrange(0, max(1, len(base) // 8)))
            i += 1
    order = list(texts)
    rng.shuffle(order)  # the base is not always the smallest id
    return {n: texts[o] for n, o in enumerate(order)}


def test_near_against_brute_force(spark, corpus):
    docs = spark.createDataFrame(list(corpus.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_near_copies(docs).collect()}
    assert got == brute_components(corpus)


def test_near_with_small_blocks_and_five_words(spark, corpus):
    docs = spark.createDataFrame(list(corpus.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_near_copies(docs, MinHash(shingle=5, block=3)).collect()}
    assert got == brute_components(corpus, 5)


def test_near_odd_inputs(spark):
    docs = odd_docs(spark)
    got = {(r.doc_id, r.component_id) for r in link_near_copies(docs).collect()}
    assert {(0, 0), (1, 1), (2, 2), (4, 4), (5, 4), (6, 4), (10, 9), (11, 9), (None, None)} <= got
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert link_near_copies(empty_docs(spark)).count() == 0


def test_pruning_bound_follows_the_posterior():
    for first, last, least in MinHash().needed():
        rng = np.random.default_rng(0)
        posterior = rng.beta(least + 1, last - least + 1, 200_000)
        assert (posterior >= 0.8).mean() < 0.01
        assert least < 0.8 * last


def test_rest_pairs_stay_with_their_first_true_band():
    how = MinHash()
    sig = np.zeros((2, how.size), np.uint16)  # all values agree in their 16 bits
    bands = np.array([np.arange(how.bands), np.arange(how.bands) + 100])
    bands[1, [3, 7]] = bands[0, [3, 7]]  # but only these bands do in truth
    both, label = np.arange(2), np.array([0, 1])
    found = {b: sum(len(x) for x, _ in _survivors(both, both, True, label, sig, bands, b, how)) for b in range(how.bands)}
    assert found == {b: int(b == 3) for b in range(how.bands)}


def test_components_with_hubs(spark):
    rng = random.Random(5)
    # Stars whose middle is the smallest, the largest or some id; links between a few of their leaves; lone pairs.
    pairs = [(middle, leaf) for middle, leaves in ((0, range(10, 60)), (999, range(100, 180)), (300, range(250, 350))) for leaf in leaves if middle != leaf]
    pairs += [(rng.randrange(250, 350), rng.randrange(100, 180)) for _ in range(3)] + [(i, i + 1) for i in range(600, 700, 2)] + [(5, 5), (600, 601)]
    label = {}

    def root(i):
        while label.setdefault(i, i) != i:
            i = label[i]
        return i

    for a, b in pairs:
        if a != b:
            ra, rb = root(a), root(b)
            label[max(ra, rb)] = min(ra, rb)
    links = spark.createDataFrame(pairs, "a long, b long")
    assert {(r.id, r.label) for r in components(links).collect()} == {(i, root(i)) for i in label}


def test_components_of_long_chains(spark):
    links = spark.range(300).selectExpr("(id * 7) % 301 AS a", "((id + 1) * 7) % 301 AS b")
    assert {r.label for r in components(links).collect()} == {0}
