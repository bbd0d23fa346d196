"""Token counts of whole texts; huge texts are encoded in overlapping chunks.

A text longer than ``chunk`` characters is cut into chunks that overlap. Neighbouring chunks are encoded with
offsets and spliced inside their overlap at the begin of a pre-token that both encodings have, with the same tokens
around it. The pre-tokenizer reads from left to right: what it makes of the left chunk is what it makes of the text,
but for the chunk's last pre-token, and from a place that is a begin in both on, so is what it makes of the right
one. Places near a chunk's edge, where a special token or a composed character may be cut, do not count. If there is no
common place the overlap is widened, in the end until both chunks are one, four times as long, so that a text without
any such place costs little more than encoding it at once. Shorter texts are encoded by ``tokens.Encoder``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import byte_slices, with_fields
from brooklet.llm.tokens import Encoder

CHUNK, OVERLAP = 16_384, 256

class _Chunk:
    def __init__(self, library, text: str, start: int, end: int, edge: int):
        encoded = library.encode(text[start:end], add_special_tokens=False)
        self.start, self.end = start, end
        n = len(encoded)
        self.ids = np.fromiter(encoded.ids, np.int64, n)
        self.spans = np.fromiter(chain.from_iterable(encoded.offsets), np.int64, 2 * n).reshape(-1, 2) + start
        of_word = np.fromiter((-1 if w is None else w for w in encoded.word_ids), np.int64, n)
        heads = np.flatnonzero(np.diff(of_word, prepend=-2) != 0)
        # Begins of pre-tokens; the first is where the chunk was cut, the last may go on behind it.
        begins = self.spans[heads[1:-1], 0]
        self.begins = begins[(begins >= start + edge) & (begins < end - edge)]

    def before(self, at: int) -> int:
        """Number of tokens that begin before a position."""
        return int(np.searchsorted(self.spans[:, 0], at))

    def token(self, i: int) -> tuple | None:
        return (int(self.ids[i]), *self.spans[i].tolist()) if 0 <= i < len(self.ids) else None


def _alone(text: str, at: int) -> bool:
    """Whether the characters on both sides of a place stay apart when they are composed."""
    a, b = text[at - 1], text[at]
    if b.isascii():
        return True
    form = lambda s: unicodedata.normalize("NFC", s)
    return not unicodedata.combining(b) and form(a + b) == form(a) + form(b)


def _boundary(text: str, left: _Chunk, right: _Chunk) -> int | None:
    """A common begin in the overlap around which both encodings have the same tokens."""
    middle = (right.start + left.end) // 2
    places = np.intersect1d(left.begins, right.begins)
    for at in places[np.argsort(abs(places - middle), kind="stable")].tolist():
        i, j = left.before(at), right.before(at)
        last, first = left.token(i - 1), left.token(i)
        if last and first and last == right.token(j - 1) and first == right.token(j) and last[2] <= at and _alone(text, at):
            return at
    return None


def encode_long(library, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[np.ndarray]:
    """The ids of ``text``, part by part; the parts together are what encoding the whole text gives."""
    edge = 4 + max((len(t.content) for t in library.get_added_tokens_decoder().values()), default=0)
    left = _Chunk(library, text, 0, min(len(text), chunk + overlap), edge)
    done = 0
    while left.end < len(text):
        wide, at = max(overlap, 4 * edge), None
        while at is None:
            start = max(left.end - wide, left.start)
            if (left.begins >= start + edge).any():  # without a begin on the left there is none in common
                right = _Chunk(library, text, start, min(len(text), left.end + chunk), edge)
                at = _boundary(text, left, right)
                if at is not None and left.before(at) < done:
                    at = None
            if start == left.start:
                break
            wide *= 4
        if at is None:  # one chunk from here on: nothing of the left one is spliced yet but what was done before
            left = _Chunk(library, text, left.start, min(len(text), left.start + 4 * (left.end - left.start)), edge)
            continue
        yield left.ids[done : left.before(at)]
        left, done = right, right.before(at)
    yield left.ids[done:]


def count_tokens(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per row of ``docs``: ``id, n_bytes, n_tokens, over_limit``.

    ``tokenizer`` is the path of a tokenizers file that every executor can open. No begin, end or other special
    tokens are added; special strings inside texts are what the library makes of them. Null counts as empty:
    0 bytes and 0 tokens. An empty table gives no rows; repeated rows are counted alike; other columns are
    not read.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = with_fields(rows.select("id"), "n_bytes bigint, n_tokens bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                texts = batch.column("text").fill_null("")
                size = pc.utf8_length(texts).to_numpy()
                huge = size > chunk + overlap
                short = pc.if_else(pa.array(huge), pa.scalar("", texts.type), texts)
                counts = np.diff(encoder.encode(short, ids=False)[0])
                for i in np.flatnonzero(huge).tolist():
                    counts[i] = sum(map(len, encode_long(encoder.library, texts[i].as_py(), chunk, overlap)))
                n_bytes = pc.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id"), n_bytes, pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    found = rows.mapInArrow(run, schema)
    return found.select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
