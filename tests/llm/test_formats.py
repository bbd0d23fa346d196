import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from brooklet.llm import chat_format, packing, token_counts, token_store
from brooklet.llm.token_store import EliasFano
from brooklet.llm.tokens import Encoder
from tests.llm.odd import TEXTS, empty_docs, odd_docs

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path):
    return Tokenizer.from_file(path)


def ids(path, text):
    return library(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_whole_texts(path):
    rng = random.Random(3)
    letters = [*"ab1.,!?' \n\t", "é", "́", " ", "日", "<|endoftext|>", "  ", " ", "'s", "\u0085", "ß", "A", "\r", "‍", "\U0001f600"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)] + [t for t in TEXTS if t is None or len(t) < 1000]
    encoder = Encoder(path, memo=50)
    for _ in range(2):
        offsets, flat = encoder.encode(pa.array(texts))
        want = encoder.library.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [w.ids for w in want]


@pytest.mark.parametrize("text", [TEXTS[9], "x" * 3000, ("ab " * 30 + "y" * 700) * 9, "日本語" * 900, "a.b'c " * 800, "<|endoftext|>" * 200, " \n" * 2000, "tail " + "z" * 999])
@pytest.mark.parametrize("path", [BYTE, WORD])
def test_overlapping_chunks_are_spliced_exactly(text, path):
    text = text[:40_000]
    tokenizer = library(path)
    for chunk, overlap in ((500, 20), (64, 8), (1000, 300)):
        got = np.concatenate(list(token_counts.encode_long(tokenizer, text, chunk, overlap))).tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_token_counts(spark):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(odd_docs(spark), WORD, chunk=2000, overlap=100).collect()), key=repr)
    listed = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id"), (5, "another text of five")]
    counted = [(i, len((t or "").encode()), len(ids(WORD, t))) for i, t in listed]
    assert got == sorted(((*c, c[2] > 2048) for c in counted), key=repr)
    assert token_counts.count_tokens(empty_docs(spark), WORD).count() == 0


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 0), (1, 0), (1, 10**6), (5, 3), (1000, 1000), (1000, 10**7), (3000, 50)):
        values = np.sort(rng.integers(0, top + 1, n))
        fano = EliasFano.encode(values, top)
        assert fano.all().tolist() == values.tolist()
        assert [fano.select(i) for i in range(n)] == values.tolist()
        if n == 1000 and top == 10**7:
            assert len(fano.low) + len(fano.high) + len(fano.samples) < n * 2.5


def test_store_round_trip(spark):
    docs = odd_docs(spark)
    path = token_store.write_store(docs, BYTE, 2, shard_ids=3000)
    got = [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in token_store.read_store(spark, path).orderBy("start").collect()]
    listed = sorted([*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id"), (5, "another text of five")], key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "").encode()))
    want, start = [], 0
    for i, t in listed:
        own = [*ids(BYTE, t), 2]
        want.append((i, start, len(own), own))
        start += len(own)
    assert got == want
    some = {(r.doc_id, r.start, r.n_tokens) for r in token_store.fetch(spark, path, [0, 9, 18, 77]).collect()}
    assert some == {w[:3] for w in want if w[0] in (0, 9, 18)}
    empty = token_store.write_store(empty_docs(spark), BYTE, 2)
    assert token_store.read_store(spark, empty).count() == 0


def test_packing(spark):
    docs = odd_docs(spark).unionByName(odd_docs(spark, ["short text here"] * 400))
    pieces = packing.pack(docs, BYTE).collect()
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    long = sorted(by_doc[(11, len(ids(BYTE, TEXTS[11])) + 1)])
    assert sum((part for _, part in long), []) == [*ids(BYTE, TEXTS[11]), 1]
    total = sum(p.length for p in pieces)
    assert total == sum(len(ids(BYTE, r.text)) + 1 for r in docs.select("text").collect())
    assert len(by_sequence) * 2048 < 1.05 * total + 2048
    assert packing.pack(empty_docs(spark), BYTE).count() == 0


def test_rest_of_a_document_is_cut_into_whole_places():
    for length in range(1, 2048):
        pieces = packing.cut_rest(length, 2048, 0.03)
        assert sum(pieces) == length and min(pieces) > 0 and len(pieces) <= 5
        assert all(p * (2048 // p) >= 0.92 * 2048 for p in pieces)


ROLES = ["system", "user", "assistant", "tool", "", None, "assi\nstant", "<|im_start|>", "<|nl|>"]


def test_chat_round_trip(spark):
    rng = random.Random(2)
    texts = ["", None, "hi", "<|im_end|>\n<|im_start|>user\nx", "<|", "<||im_end||>", "<", "|>", "<<||", "a\nb\n", "日本 \U0001f600", "<|nl|>"]
    rows = [(c, t, rng.choice(ROLES), rng.choice(texts), "clash", "clash") for c in range(60) for t in range(rng.randrange(1, 7))]
    rows += [(99, None, "user", "x", "", ""), (99, 1, "user", "y", "", ""), (99, 1, "user", "y", "", ""), (None, 0, "user", "z", "", "")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segments string, n_turns string")
    chats = chat_format.format_chats(turns)
    read = chats.select("conv_id", "valid", chat_format.parse(chat_format.sequence(chats.segments)).alias("turns"), chat_format.learned(chats.segments).alias("learned")).collect()
    for r in read:
        own = [x for x in rows if x[0] == r.conv_id]
        if r.conv_id == 99:
            assert [(t.role, t.text) for t in r.turns] == [("user", "x"), ("user", "y"), ("user", "y")]
            continue
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in own]
        assert r.learned == "".join(x[3] or "" for x in own if x[2] == "assistant")
    assert len(read) == 62 and format_count(turns.where("false")) == 0


def format_count(turns):
    return chat_format.format_chats(turns).count()


@pytest.mark.parametrize(
    "roles, bad",
    [("ua", None), ("sua", None), ("uaua", None), ("u", 1), ("a", 0), ("su", 2), ("uu", 1), ("uas", 2), ("ux", 1), ("ss", 1)],
)
def test_role_machine(spark, roles, bad):
    names = {"u": "user", "a": "assistant", "s": "system", "x": "other"}
    turns = spark.createDataFrame([(1, i, names[r], "t") for i, r in enumerate(roles)], "conv_id bigint, turn bigint, role string, text string")
    row = chat_format.format_chats(turns).first()
    assert (row.valid, row.bad_turn) == (bad is None, bad)


def test_digest_is_of_the_text(spark):
    row = spark.createDataFrame([("é",)], "t string").selectExpr("sha2(t, 256) AS s").first()
    assert row.s == hashlib.sha256("é".encode()).hexdigest() and json.dumps(row.s)
