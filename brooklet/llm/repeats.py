"""Repeated passages with a sparse suffix array over words.

Only suffixes at content-selected positions are kept: of every ``least - k + 1`` neighbouring k-word shingles
the one with the smallest hash (a minimiser). A passage of ``least`` words holds all shingles of such a window,
so its copies keep a suffix at the same place. Suffixes whose first k words occur once only are dropped.

The others are brought together by their first k words and sorted by the words that follow, and once more by the
words before, read backwards. Adjacent common prefixes give, for every length, the runs of suffixes that go on alike
to the right, and those that agree to the left. Two suffixes match if their agreement on both sides together makes
``least`` words: for some a they are in one run of a words to the left and one of ``least - k - a`` to the right. The
matched windows of a document are united, which gives the maximal extension of every match.

Matches are not paired. The surroundings that share a window are a set; its hash is the class of the window.
Neighbouring extensions of a suffix with the same set are one stretch of the text, which all places of the
class have in common, so equal classes give all partners.

This finds every window of ``least`` words that occurs at another place too, and no other, but for collisions of
64-bit hashes of words. Suffixes with the same surroundings are merged before they are sorted. A shingle with very many
different surroundings is not sorted in one place: its windows are dealt out by their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import NOT_BLANK, byte_slices, lists, mix, small_enough, with_fields, words
from brooklet.session import saved

LEAST, SHINGLE = 50, 30
HOT = 100_000  # surroundings of one shingle that are sorted in one task
STRETCHES = "array<struct<near:int,far:int,class:bigint,own:boolean>>"
SHARED = "array<struct<start:int,end:int,class:bigint>>"
SPANS = "array<struct<start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _minimisers(hashes: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Indices of shingles that are the first smallest of some window within one document."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(hashes, window).argmin(axis=1) + np.arange(len(hashes) - window + 1)
    return np.unique(least[doc[: len(least)] == doc[window - 1 :]])


def _scan(rows: DataFrame, least: int, k: int, surroundings: bool) -> DataFrame:
    """The sparse suffixes: ``id, d, pos, h``, and ``around``, the hashes of the words left and right of the shingle."""
    extra = least - k
    schema = with_fields(rows.select("id", "d"), "pos int, h bigint", *(["c bigint, around binary"] if surroundings else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                found = words(batch.column("text"), NOT_BLANK)
                at, grams = found.grams(k)
                doc = np.searchsorted(found.offsets, at, "right") - 1
                keep = _minimisers(grams, doc, extra + 1)
                at, grams, doc = at[keep], grams[keep], doc[keep]
                rows_of = batch.select(["id", "d"]).take(pa.array(doc))
                columns = [rows_of.column("id"), rows_of.column("d"), pa.array(at - found.offsets[doc], pa.int32()), pa.array(grams.view(np.int64))]
                if surroundings:
                    # A place beyond the text's ends is 0: no window lies across it.
                    places = at[:, None] + np.concatenate([np.arange(-extra, 0), np.arange(k, k + extra)])
                    inside = (places >= found.offsets[doc][:, None]) & (places < found.offsets[doc + 1][:, None])
                    around = np.where(inside, found.hashes[np.where(inside, places, 0)], np.uint64(0))
                    around[inside & (around == 0)] = 1
                    name = grams.copy()
                    for j in range(2 * extra):
                        name = mix(name * np.uint64(0x9E3779B97F4A7C15) + around[:, j])
                    flat = pa.py_buffer(around.tobytes())
                    columns += [pa.array(name.view(np.int64)), pa.FixedSizeBinaryArray.from_buffers(pa.binary(16 * extra), len(at), [None, flat]).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "d", "pos", "h", "c", "around"][: len(columns)])

    return rows.mapInArrow(run, schema)


def _alignment(h: np.ndarray, around: np.ndarray, a: int, extra: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows that begin a words before the shingles, and whether they lie within their texts."""
    part = around[:, extra - a : 2 * extra - a]
    name = mix(h + np.uint64(a))
    for j in range(extra):
        name = mix(name * np.uint64(0x9E3779B97F4A7C15) + part[:, j])
    return name, (part != 0).all(axis=1)


def _around(column: pa.ChunkedArray | pa.Array, extra: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, 2 * extra)


def _runs(h: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes sorted by ``h`` and the words of a side: their order, each one's common words with the one before (-1
    where ``h`` differs), and how many words each has before its text ends."""
    order = np.lexsort((*side.T[::-1], h))
    words, hashes = side[order], h[order]
    equal = (words[1:] == words[:-1]) & (words[1:] != 0)
    common = np.append(-1, np.where(hashes[1:] != hashes[:-1], -1, np.where(equal.all(axis=1), side.shape[1], equal.argmin(axis=1)))) if len(h) else np.zeros(0, np.int64)
    depth = np.where((side != 0).all(axis=1), side.shape[1], (side != 0).argmin(axis=1))
    return order, common, depth


def _run_numbers(order: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """For every suffix the run of those that agree with it in ``length`` words."""
    numbers = np.zeros(len(order), np.int64)
    numbers[order] = np.cumsum(common < length)
    return numbers


def _ranks(places: list[pa.Array]) -> list[np.ndarray]:
    """Places ``(id, d, pos)`` of several columns as numbers in their order, equal ones alike."""
    fields = [np.concatenate([p.field(name).to_numpy(zero_copy_only=False) for p in places]) for name in ("pos", "d", "id")]
    order = np.lexsort(fields)
    new = np.append(False, np.logical_or.reduce([f[order][1:] != f[order][:-1] for f in fields])) if len(order) else np.zeros(0, bool)
    ranks = np.zeros(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return np.split(ranks, len(places))


def _sorted_matches(contexts: DataFrame, extra: int, groups: int) -> DataFrame:
    """``c, low, high, stretches``: a stretch ``near, far, class, own`` are the windows at extensions near to far to the
    left that occur at two places, with the class of the contexts that share them; ``own`` if all have one id.
    ``low`` and ``high`` are ids that share one of the others, null without."""
    kind = contexts.schema["low"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        column = {name: table.column(name).chunk(0) if table.num_rows else pa.array([], table.schema.field(name).type) for name in table.column_names}
        h, around = column["h"].to_numpy().view(np.uint64), _around(column["around"], extra)
        low, high, c = (column[x].to_numpy() for x in ("low", "high", "c"))
        begin, end = _ranks([column["first"], column["last"]])
        right_order, right_common, right_depth = _runs(h, around[:, extra:])
        left_order, left_common, left_depth = _runs(h, around[:, extra - 1 :: -1])
        least, most = low.copy(), high.copy()
        across = np.zeros(len(h), bool)
        inside, began, own = np.zeros(len(h), np.int8), np.zeros(len(h), np.int32), np.zeros(len(h), np.int64)
        done = []  # context, near, far, class, kind

        for a in range(extra + 2):
            now, classes = np.zeros(len(h), np.int8), np.zeros(len(h), np.int64)  # 1: another id has it, 2: the id itself
            if a <= extra:
                at = np.flatnonzero((left_depth >= a) & (right_depth >= extra - a))
                name = _run_numbers(right_order, right_common, extra - a) * len(h) + _run_numbers(left_order, left_common, a)
                order = at[np.argsort(name[at], kind="stable")]
                if len(order):
                    run_names = name[order]
                    begins = np.concatenate([[0], np.flatnonzero(run_names[1:] != run_names[:-1]) + 1])
                    sizes = np.diff(np.append(begins, len(order)))
                    spread = lambda x: np.repeat(x, sizes)  # noqa: E731, B023
                    first, last = spread(np.minimum.reduceat(low[order], begins)), spread(np.maximum.reduceat(high[order], begins))
                    match = spread(np.minimum.reduceat(begin[order], begins) != np.maximum.reduceat(end[order], begins))
                    hit = order[match]
                    now[hit] = np.where(first != last, 1, 2)[match]
                    classes[hit] = spread(np.bitwise_xor.reduceat(c[order], begins))[match]
                    other = order[match & (first != last)]
                    across[other] = True
                    least[other], most[other] = np.minimum(least[other], first[match & (first != last)]), np.maximum(most[other], last[match & (first != last)])
            goes_on = (inside > 0) & (now == inside) & (own == classes)
            ends = np.flatnonzero((inside > 0) & ~goes_on)
            done.append((ends, began[ends], np.full(len(ends), a - 1, np.int32), own[ends], inside[ends] == 2))
            began[(now > 0) & ~goes_on] = a
            inside, own = now, classes
        context, near, far, classes, alone = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(context, kind="stable")
        counts = np.bincount(context, minlength=len(h))
        hit = counts > 0
        found = pa.StructArray.from_arrays([pa.array(near[order]), pa.array(far[order]), pa.array(classes[order]), pa.array(alone[order])], ["near", "far", "class", "own"])
        named = pa.array(~across[hit])
        ids = [pa.array(x[hit], mask=named.to_numpy(zero_copy_only=False)) for x in (least, most)]
        return pa.table({"c": c[hit], "low": ids[0], "high": ids[1], "stretches": lists(found, np.cumsum([0, *counts[hit]]))})

    grouped = contexts.withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups))).groupBy("g")
    return grouped.applyInArrow(run, f"c bigint, low {kind}, high {kind}, stretches {STRETCHES}")


def _dealt_matches(contexts: DataFrame, extra: int) -> DataFrame:
    """The same for shingles with very many surroundings: a row per window, counted by Spark."""
    kept = ["c", "low", "high", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, around = batch.column("h").to_numpy().view(np.uint64), _around(batch.column("around"), extra)
            for a in range(extra + 1):
                name, whole = _alignment(h, around, a, extra)
                picked = batch.select(kept).filter(pa.array(whole))
                yield picked.append_column("name", pa.array(name[whole].view(np.int64))).append_column("a", pa.array(np.full(picked.num_rows, a, np.int32)))

    windows = saved(contexts.mapInArrow(run, with_fields(contexts.select(*kept), "name bigint, a int")), "repeats-windows")
    shared = windows.groupBy("name").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.bit_xor("c").alias("class"), F.min("first").alias("begin"), F.max("last").alias("end"))
    shared = shared.where("begin != end").select("name", "least", "most", "class", (F.col("least") == F.col("most")).alias("own"))
    # The windows at both ends of a stretch hold all its words.
    stretches = windows.join(shared, "name").groupBy("c", "class", "own").agg(F.min("least").alias("low"), F.max("most").alias("high"), F.min("a").alias("near"), F.max("a").alias("far"))
    listed = F.collect_list(F.struct("near", "far", "class", "own")).cast(STRETCHES)
    others = [f(F.when(~F.col("own"), F.col(c))).alias(c) for f, c in ((F.min, "low"), (F.max, "high"))]
    return stretches.groupBy("c").agg(*others, listed.alias("stretches"))


def _united(start: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> list[list[dict]]:
    """By document the maximal runs of its stretches, which are sorted by their starts."""
    spans: list[list[dict]] = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if a == b:
            spans.append([])
            continue
        reach = np.maximum.accumulate(end[a:b])
        breaks = np.flatnonzero(start[a + 1 : b] > reach[:-1])
        firsts, lasts = start[a:b][np.append(0, breaks + 1)], reach[np.append(breaks, b - a - 1)]
        spans.append([{"start": int(x), "end": int(y)} for x, y in zip(firsts, lasts)])
    return spans


def find_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, shingle: int = SHINGLE, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: ``id, n_repeated, spans, others, shared, own_spans``.

    A word is what stands between blanks, with A-Z in lower case. ``spans`` are the maximal runs ``(start, end)``
    of words, end exclusive, covered by windows of ``least`` words that a document with another id has too;
    ``n_repeated`` counts their words. ``shared`` are stretches ``(start, end, class)`` of at least ``least`` words:
    all stretches of a class are the same words, and two documents share a window if and only if they have a
    class in common, so all partners follow from the classes. ``others`` only names examples of them, one or more
    for every matched place. ``own_spans`` are runs of windows that occur at several places, all under the same id: in
    one text, or in texts that share the id. Null and short texts have none; a null id is not compared.
    Rows that repeat id and text are one document. An empty table gives no rows; other columns are not read. Ids are
    numbers.
    """
    if not 0 < least - shingle < 60:
        raise ValueError("least - shingle is between 1 and 59")
    spark, extra = docs.sparkSession, least - shingle
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("d"), F.col(text).alias("text"))
    known = rows.where("id IS NOT NULL")
    repeated = _scan(known, least, shingle, False).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    repeated = saved(repeated, "repeats-shingles")
    suffixes = saved(_scan(known, least, shingle, True).join(small_enough(repeated, 4_000_000), "h"), "repeats-suffixes")
    place = F.struct("id", "d", "pos")
    ids = F.min("id").alias("low"), F.max("id").alias("high")
    contexts = suffixes.groupBy("c").agg(F.first("h").alias("h"), F.first("around").alias("around"), *ids, F.min(place).alias("first"), F.max(place).alias("last"))
    contexts = saved(contexts, "repeats-contexts")
    crowded = saved(contexts.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("h"), "repeats-crowded")
    matches = _sorted_matches(contexts.join(crowded, "h", "left_anti"), extra, max(64, contexts.count() // 10_000))
    if not crowded.isEmpty():
        matches = matches.unionByName(_dealt_matches(contexts.join(crowded, "h", "left_semi"), extra))
    hits = suffixes.select("id", "d", "pos", "c").join(saved(matches, "repeats-matches"), "c")
    other = F.when(F.col("low") == F.col("id"), F.col("high")).otherwise(F.col("low"))
    hits = hits.groupBy("id", "d").agg(F.collect_set(F.struct("pos", "stretches")).alias("places"), F.sort_array(F.collect_set(other)).alias("others"))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places")
            flat = places.flatten()
            stretches = flat.field("stretches")
            each = stretches.flatten()
            counts = stretches.value_lengths().to_numpy()
            pos = np.repeat(flat.field("pos").to_numpy(), counts)
            start, end = pos - each.field("far").to_numpy(), pos - each.field("near").to_numpy() + least
            doc = np.repeat(np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy()), counts)
            own = each.field("own").to_numpy(zero_copy_only=False)
            order = np.lexsort((each.field("class").to_numpy(), end, start, doc, own))
            start, end, classes, doc = start[order], end[order], each.field("class").to_numpy()[order], doc[order]
            cut = len(own) - int(own.sum())  # the places that only the id itself repeats come last
            bounds = np.searchsorted(doc[:cut], np.arange(batch.num_rows + 1))
            spans = _united(start[:cut], end[:cut], bounds)
            own_spans = _united(start[cut:], end[cut:], np.searchsorted(doc[cut:], np.arange(batch.num_rows + 1)))
            shared = pa.StructArray.from_arrays([pa.array(start[:cut], pa.int32()), pa.array(end[:cut], pa.int32()), pa.array(classes[:cut])], ["start", "end", "class"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("d"),
                    pa.array(spans, SPAN_TYPE),
                    batch.column("others"),
                    lists(shared, bounds),
                    pa.array(own_spans, SPAN_TYPE),
                ],
                ["id", "d", "spans", "others", "shared", "own_spans"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    found = hits.mapInArrow(unite, with_fields(rows.select("id", "d"), f"spans {SPANS}, others array<{kind}>, shared {SHARED}, own_spans {SPANS}"))
    spans = F.coalesce("spans", F.array().cast(SPANS))
    length = F.aggregate(spans, F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return (
        rows.select("id", "d")
        .join(found, ["id", "d"], "left")
        .select(
            F.col("id").alias(id),
            length.cast("bigint").alias("n_repeated"),
            spans.alias("spans"),
            F.coalesce("others", F.array().cast(f"array<{kind}>")).alias("others"),
            F.coalesce("shared", F.array().cast(SHARED)).alias("shared"),
            F.coalesce("own_spans", F.array().cast(SPANS)).alias("own_spans"),
        )
    )
