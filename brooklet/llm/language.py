"""Language identification as a mixture: each document's language proportions by expectation-maximisation.

Training counts hashed byte trigrams by language on labelled documents. A document is a bag of trigrams drawn
from a mixture of the languages' distributions; EM estimates the proportions. The set of languages is chosen by
penalised likelihood: starting from all languages that explain at least half a trigram, the language with the
smallest share is given up, one after the other, and the proportions are fitted anew; the set that pays best
stays, whatever its size. The language with the largest share is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import LOWER, byte_slices, raw_texts, with_fields

GRAMS = 1 << 14
TRAIN_DOCS = 200_000  # bound of the training sample
MOST_LANGUAGES = 2_048  # bound of the model: the labels with the most labelled rows are learned
HELD_LABELS = 256  # whose counts a task keeps before it passes them on
CELLS = 8 << 20  # numbers in a table of documents x trigrams x languages
UNKNOWN = "und"

# Everything that is no ASCII letter and not beyond ASCII is one kind of gap.
_FOLD = LOWER.copy()
_FOLD[:0x80] = np.where((LOWER[:0x80] >= 97) & (LOWER[:0x80] <= 122), LOWER[:0x80], 32)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts and the text each is from. A text is read with a gap on either side."""
    edged = np.full(len(data) + 2 * (len(offsets) - 1), 32, dtype=np.uint32)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    edged[np.arange(len(data)) + 2 * owner + 1] = _FOLD[data]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 2)
    if len(edged) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = edged[:-2], edged[1:-1], edged[2:]
    keep = (doc[:-2] == doc[2:]) & (b != 32)
    codes = (((a << 16 | b << 8 | c) * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64)
    return codes[keep], doc[:-2][keep]


@dataclass
class LanguageModel:
    """Trigram distributions, one column per language."""

    languages: list[str]
    probabilities: np.ndarray
    rounds: int = 12
    least: float = 0.5  # trigrams that a language explains at the start, or it is no candidate
    always: int = 4  # candidates of every document, however few trigrams they explain
    penalty: float = 3.0  # neighbouring trigrams share letters: three of them count as one observation

    def _fit(self, p: np.ndarray, share: np.ndarray, doc: np.ndarray, counts: np.ndarray, begins: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """EM for all documents at once. ``p`` has a row per (document, trigram); returns shares and log-likelihoods."""
        size = np.add.reduceat(counts, begins)
        for _ in range(rounds):
            joint = share[doc] * p
            joint *= (counts / joint.sum(axis=1))[:, None]
            share = np.add.reduceat(joint, begins, axis=0) / size[:, None]
        return share, np.add.reduceat(counts * np.log((share[doc] * p).sum(axis=1)), begins)

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: number of its language or -1, that language's share, all shares."""
        # As many texts at a time as the table below has room for; a text has GRAMS trigrams at most.
        room = np.minimum(np.diff(raw_texts(column)[1]) + 2, GRAMS) * max(1, len(self.languages))
        parts, at, reach = [], 0, np.cumsum(room)
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + CELLS, "right")))
            parts.append(self._predict(column.slice(at, end - at)))
            at = end
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else self._predict(column)

    def _predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = raw_texts(column)
        n, languages = len(offsets) - 1, len(self.languages)
        best, score, shares = np.full(n, -1), np.zeros(n), np.zeros((n, languages), dtype=np.float32)
        codes, owner = _grams(data, offsets)
        if not len(codes) or not languages:
            return best, score, shares
        table = np.bincount(owner * GRAMS + codes, minlength=n * GRAMS)
        cells = np.flatnonzero(table)
        docs, counts = cells // GRAMS, table[cells].astype(np.float32)
        known, begins, doc = np.unique(docs, return_index=True, return_inverse=True)
        p = self.probabilities[cells % GRAMS]
        share, _ = self._fit(p, np.full((len(known), languages), 1 / languages, np.float32), doc, counts, begins, self.rounds)
        size = np.add.reduceat(counts, begins)
        chosen, chosen_cost = share.copy(), np.full(len(known), np.inf)
        # The languages of a document by share; the first ``candidates`` of them are its set to begin with.
        order = np.argsort(-share, axis=1, kind="stable")
        share = np.take_along_axis(share, order, axis=1)
        candidates = np.maximum((share * size[:, None] >= self.least).sum(axis=1), min(self.always, languages))
        for k in range(int(candidates.max()), 0, -1):
            at = np.flatnonzero(candidates >= k)  # only documents whose set is that large
            cell = candidates[doc] >= k
            own = np.repeat(np.arange(len(at)), np.diff(np.append(begins, len(doc)))[at])
            own_begins = np.searchsorted(own, np.arange(len(at)))
            start = share[at, :k] + np.float32(1e-6)
            fitted, likelihood = self._fit(
                np.take_along_axis(p[cell], order[at, :k][own], axis=1), start / start.sum(axis=1, keepdims=True), own, counts[cell], own_begins, 6 if k > 1 else 0
            )
            cost = -2 * likelihood + self.penalty * (k - 1) * np.log(size[at] + 1)
            better = cost <= chosen_cost[at]
            whole = np.zeros((len(at), languages), dtype=share.dtype)
            np.put_along_axis(whole, order[at, :k], fitted, axis=1)
            chosen[at[better]], chosen_cost[at[better]] = whole[better], cost[better]
            rank = np.argsort(-fitted, axis=1, kind="stable")
            share[at, :k] = np.take_along_axis(fitted, rank, axis=1)
            order[at, :k] = np.take_along_axis(order[at, :k], rank, axis=1)
        top = chosen.argmax(axis=1)
        best[known], score[known], shares[known] = top, chosen[np.arange(len(known)), top], chosen
        return best, np.clip(score, 0, 1), shares


def _rates(sizes: dict[str, int], most: int) -> dict[str, float]:
    """The share of each label's rows to take, ``most`` rows in all: the same number of each, or all it has."""
    rest, level = most, 0.0
    for i, n in enumerate(sorted(sizes.values())):
        level = rest / (len(sizes) - i)
        if n > level:
            break
        rest -= n
    return {name: min(1.0, level / n) for name, n in sizes.items()}


def train(docs: DataFrame, label: str = "lang", id: str = "doc_id", text: str = "text", most: int = TRAIN_DOCS, smoothing: float = 0.5, most_languages: int = MOST_LANGUAGES) -> LanguageModel:
    """A model of the labels in ``docs``; rows without label or text are passed over. Of more than ``most``
    labelled rows about ``most`` are taken, chosen by the hash of their id: of each label the same number, or
    all rows of a label that has no more. Of more than ``most_languages`` labels those with the most labelled rows
    are learned, of equal ones the first by name; documents of others are predicted as one of these. Without any row
    the model knows no language and predicts none."""
    spark = docs.sparkSession
    labelled = docs.select(F.col(id).alias("id"), F.col(label).cast("string").alias("label"), F.col(text).alias("text")).where(F.col("label").isNotNull() & F.col("text").isNotNull())
    known = docs.select(F.col(label).cast("string").alias("label")).where("label IS NOT NULL").groupBy("label").count()
    sizes = {r[0]: r[1] for r in known.orderBy(F.col("count").desc(), "label").limit(most_languages + 1).collect()}
    if len(sizes) > most_languages or sum(sizes.values()) > most:
        rates = _rates(dict([*sizes.items()][:most_languages]), most)
        table = F.broadcast(spark.createDataFrame(list(rates.items()), "label string, rate double"))  # most_languages rows
        labelled = labelled.join(table, "label").where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < F.col("rate") * (1 << 40)).select("id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                codes, owner = _grams(*raw_texts(batch.column("text")))
                labels = batch.column("label").dictionary_encode()
                number = labels.indices.to_numpy()[owner]
                for i, name in enumerate(labels.dictionary.to_pylist()):
                    counts.setdefault(name, np.zeros(GRAMS, np.int64))
                    counts[name] += np.bincount(codes[number == i], minlength=GRAMS)
                if len(counts) > HELD_LABELS:
                    yield from told(counts)
                    counts = {}
        yield from told(counts)

    def told(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(own[at])], ["label", "gram", "n"])

    summed = labelled.mapInArrow(run, "label string, gram int, n bigint").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    rows = summed.toArrow()  # at most most_languages x GRAMS counts, whatever the corpus
    languages = sorted(set(rows.column("label").unique().to_pylist()))
    counts = np.full((GRAMS, len(languages)), smoothing, np.float32)
    where = pc.index_in(rows.column("label"), pa.array(languages, pa.string())).to_numpy()
    counts[rows.column("gram").to_numpy(), where] += rows.column("n").to_numpy()
    counts /= counts.sum(axis=0, dtype=np.float64).astype(np.float32)
    return LanguageModel(languages, counts)


def _little_batches(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Few texts at a time: the trigram counts of each are a row of ``GRAMS`` cells."""
    for piece in byte_slices(batch, column, 400_000):
        for at in range(0, piece.num_rows, 128):
            yield piece.slice(at, 128)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, lang_pred, score, mixture``.

    ``lang_pred`` is a language of the model, or ``und`` with score 0 if the text is null or has no letter;
    ``score`` its share of the document, ``mixture`` the shares of the document's language set. Of languages with
    equal shares the first by name is taken. Repeated rows
    get the same prediction; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # GRAMS x languages
    rows = docs.select(F.col(id).alias("id"), F.when(has_letter(F.col(text)), F.col(text)).alias("text"))
    schema = with_fields(rows.select("id"), "lang_pred string, score double, mixture map<string,float>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in _little_batches(whole, "text"):
                best, score, shares = model.predict(batch.column("text"))
                mixture = [[(model.languages[j], float(s[j])) for j in np.flatnonzero(s > 1e-4)] for s in shares]
                known = batch.column("text").is_valid().to_numpy(zero_copy_only=False) & (best >= 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        pa.array([model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                        pa.array(mixture, pa.map_(pa.string(), pa.float32())),
                    ],
                    ["id", "lang_pred", "score", "mixture"],
                )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known and has a share of at least ``least``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    lettered = docs.where(has_letter(F.col(text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _little_batches(whole, text):
                best, score, _ = shared.value.predict(batch.column(text))
                yield batch.filter(pa.array((best >= 0) & (score >= least)))

    return lettered.mapInArrow(run, docs.schema)
