"""Alignment of two tokenizers against plain Python on whole texts."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from brooklet.llm import cross_tokenizer
from brooklet.llm.cross_tokenizer import ByteSide, PieceSide, align, align_texts, count_links
from brooklet.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.odd import TEXTS, empty_docs, odd_docs

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a ", "a  ", "  ", "a  b ", " a", "x▁y ▁ z", "\n \n", "a b　c", "\x00 a", " " * 50 + "b", "tab\t x", "<s> </s> <unk> <0x41>", "日本語 " * 40, "ﬁ ½ ́", "7" * 500, "é" * 300, "\U0001f600\U0001f601"]


@pytest.fixture(scope="module")
def plain():
    """Groups of one text, straight from the libraries."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    entry = {i: t for t, i in a.get_vocab().items()}
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(c): c for c in letters} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in letters)}

    def groups(text):
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a = [bytes(alphabet[c] for c in entry[i]) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return []
        ends = [[sum(map(len, x[: i + 1])) for i in range(len(x))] for x in (bytes_a, bytes_b)]
        out, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            m, n = ends[0].index(end) + 1, ends[1].index(end) + 1
            out.append((tuple(ids_a[i:m]), tuple(ids_b[j:n])))
            i, j = m, n
        return out

    return groups


def brute_rows(docs, groups):
    of = [(id, groups(text)) for id, text in docs]
    links = [Counter((a, b) for ga, gb in g for a in ga for b in gb) for _, g in of]
    counts = Counter(pair for own in links for pair in own)
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for (id, g), own in zip(of, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        best = sum(t for p, t in own.items() if counts[p] == highest[p[0]])
        digest = hashlib.sha256(written.encode()).hexdigest() if g else ""
        out.append((id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()), best, sum(t * counts[p] for p, t in own.items()), digest))
    return sorted(out, key=repr)


def short(texts):
    return [t if t is None or len(t) < 3000 else t[:3000] for t in texts]


@pytest.mark.parametrize("block_bytes", [cross_tokenizer.BLOCK_BYTES, 500])
def test_counts_against_brute_force(spark, plain, block_bytes):
    rng = random.Random(8)
    texts = [*short(TEXTS), *ODD, *(" ".join(rng.choice(["theatre", "naïve", "and", "2024,", "日本", "(x)"]) for _ in range(30)) for _ in range(30))]
    docs = odd_docs(spark, texts).withColumns({c: F.lit("clash") for c in ("block", "times", "best")}).repartition(3)
    got = sorted((tuple(r) for r in count_links(docs, A, B, block_bytes=block_bytes).collect()), key=repr)
    assert got == brute_rows([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], plain)


def test_query_against_brute_force(spark, plain):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    small = [(r.doc_id, r.text) for r in docs]
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_cross_tokenizer"](spark, DATA).collect()}
    assert len(got) == len(small)
    texts = {i: t for i, t in small if len(t or "") < 4000}
    for i, t in texts.items():
        g = plain(t)
        assert got[i][1:5] == (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(len(a) * len(b) for a, b in g))


def test_groups_and_overlaps(spark, plain):
    texts = [*short(TEXTS), *ODD]
    docs = odd_docs(spark, texts)
    got = sorted(((r.doc_id, [(tuple(g.a), tuple(g.b)) for g in r.groups]) for r in align(docs, A, B).collect()), key=repr)
    assert got == sorted(((r.doc_id, plain(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
    found = align_texts(pa.array(texts), ByteSide.of(A), PieceSide.of(B))
    pairs = {(int(i), int(j)) for i, j in zip(found.overlaps["a"], found.overlaps["b"])}
    assert len(pairs) == len(found.overlaps)
    a, b = found.a, found.b
    want, j = set(), 0
    for i in range(len(a.ids)):
        while j and b.ends[j - 1] > a.starts[i]:
            j -= 1
        while j < len(b.ids) and b.starts[j] < a.ends[i]:
            if b.ends[j] > a.starts[i]:
                want.add((i, j))
            j += 1
    assert pairs == want


def test_links_in_parts_are_the_same(monkeypatch):
    column = pa.array([*short(TEXTS), *ODD])
    found = align_texts(column, ByteSide.of(A), PieceSide.of(B))
    whole = found.links(60_000)
    monkeypatch.setattr(cross_tokenizer, "LINKS_AT_ONCE", 7)
    assert all((x == y).all() for x, y in zip(whole, found.links(60_000)))


def test_parts_of_a_text_are_its_encoding():
    side = PieceSide.of(B)
    assert side.cut
    for text in [*short(t for t in TEXTS if t), *ODD]:
        assert side.encode(pa.array([" " + text]))[1].tolist() == side.library.encode(text)


def test_empty_tables(spark):
    assert count_links(empty_docs(spark), A, B).count() == 0 and align(empty_docs(spark), A, B).count() == 0
