"""Spelling variants: words one edit apart, and the frequent form that each rare one stands for.

*Near* words differ by exactly one inserted, deleted or replaced code point. Two words of m and m or m + 1 code
points that are near share a prefix of P and a suffix of at least m - 1 - P code points, for some P from 0 to m. So
near words with P in ``[low, high)`` agree in their first ``low`` and their last ``m - high`` code points: the
words of a class m are dealt to groups by these, first for the two halves of 0..m. A group with more than
``GROUP_CHARS`` code points is dealt again by the halves of its own interval, if need be until one code point is
left free (a group then has two rows for each letter, and two for each pair of letters, at most).

A task sorts each group, by its words or, where the longer agreement is at the end, by the reversed words, and
every word of m code points scans the sorted list with a row of the edit matrix for each prefix length. Only the
band of three cells around the diagonal is kept. The next word reuses the rows of the prefix that it shares with
the word before (adjacent LCP); once all cells of a row exceed one edit, all words with that prefix are skipped.
The scans of many words advance side by side, as arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import small_enough
from brooklet.session import saved

GROUP_CHARS = 2_000_000  # code points of a group before it is dealt again
CHUNK_CHARS = 500_000  # of the groups that a task scans side by side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GROUP = ["size", "low", "high", "fixed"]


def word_counts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3, letters: str = "A-Za-zÀ-ÿ",
    change: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """``word, n``: the maximal runs of ``letters`` in all texts, A-Z in lower case, with at least ``least_length``
    code points and ``least_count`` occurrences. ``change(id, run)`` may map runs to words before they are counted,
    to words that are no longer than the run. Null texts have no words."""
    rows = docs.select(F.col(id).alias("id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{letters}]{{{least_length},}}"), F.lit(0))).alias("run"))
    run = F.translate("run", UPPER, LOWER)
    words = rows.select((run if change is None else change(F.col("id"), run)).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _dealt(words: DataFrame, group_chars: int) -> DataFrame:
    """``size, low, high, fixed, form, n``: every word in the groups in which its near words may be."""
    length = F.length("word")
    half = F.floor((F.col("size") + 1) / 2).cast("int")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size")).where("size > 0")
    intervals = F.array(F.struct(F.lit(0).alias("low"), half.alias("high")), F.struct(half.alias("low"), (F.col("size") + 1).alias("high")))
    rows = rows.select("word", "n", "size", F.inline(intervals))
    while True:
        keyed = rows.withColumn("fixed", F.expr("concat(substr(word, 1, low), right(word, greatest(size - high, 0)))"))
        large = keyed.groupBy(*_GROUP).agg(F.sum(F.length("word")).alias("chars")).where((F.col("chars") > group_chars) & (F.col("high") - F.col("low") > 1))
        large = saved(large.select(*_GROUP, F.lit(True).alias("large")), "spelling-large")
        if large.isEmpty():
            break
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
        whole = F.array(F.struct("low", "high"))
        marked = keyed.join(small_enough(large), _GROUP, "left")
        rows = marked.select("word", "n", "size", F.inline(F.when(F.col("large"), halves).otherwise(whole)))
    backward = F.col("low") < F.col("size") - F.col("high")
    return keyed.select(*_GROUP, F.when(backward, F.reverse("word")).otherwise(F.col("word")).alias("form"), "n")


class _Sorted:
    """Sorted words of some groups, one group after the other: code points, adjacent LCPs, ends of groups."""

    def __init__(self, forms: pa.Array, first: np.ndarray, head: np.ndarray):
        lengths = pc.utf8_length(forms).to_numpy(zero_copy_only=False).astype(np.int64)
        self.lengths, self.head = lengths, head
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.codes = np.frombuffer("".join(forms.to_pylist()).encode("utf-32-le"), np.uint32)
        n = len(lengths)
        starts = np.flatnonzero(first)
        number = np.cumsum(first) - 1
        self.begin, self.end = starts[number], np.append(starts[1:], n)[number]
        # Common prefix with the word before, -1 at the begin of a group and behind the last one.
        self.lcp = np.append(np.where(first, -1, head), -1)
        at = np.flatnonzero(~first)
        while len(at):
            d = self.lcp[at]
            inside = (d < lengths[at]) & (d < lengths[at - 1])
            at, d = at[inside], d[inside]
            at = at[self.codes[self.offsets[at] + d] == self.codes[self.offsets[at - 1] + d]]
            self.lcp[at] += 1
        # The next place with a shorter common prefix.
        shorter, stack = [0] * (n + 1), []
        for j, depth in enumerate(self.lcp.tolist()):
            while stack and stack[-1][1] > depth:
                shorter[stack.pop()[0]] = j
            stack.append((j, depth))
        self.shorter = np.array(shorter, dtype=np.int64)

    def after(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place behind ``at`` whose word shares fewer than ``depth`` code points with that at ``at``."""
        found = at + 1
        todo = np.flatnonzero(self.lcp[found] >= depth)
        while len(todo):
            found[todo] = self.shorter[found[todo]]
            todo = todo[self.lcp[found[todo]] >= depth[todo]]
        return found

    def scan(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query, word) of one group that are near, for queries no longer than the other words."""
        size = self.lengths[queries]
        rows = np.zeros((int((size + 2 - self.head[queries]).sum()), 3), dtype=np.int8)  # cells j = d - 1, d, d + 1
        base = np.cumsum(size + 2 - self.head[queries]) - (size + 2) # row of depth d is rows[base + d]
        depth = self.head[queries].copy()
        rows[base + depth] = (1, 0, 1)
        query, cursor = queries, self.begin[queries].copy()
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        while len(query):
            start = self.offsets[query]
            code = self.codes[self.offsets[cursor] + depth]
            before = rows[base + depth]
            # q[j] for j = d - 1, d, d + 1 at the new depth d; outside of the query a cell costs two at once.
            cells = []
            for k in (-1, 0, 1):
                j = depth + k  # from 0
                there = (j >= 0) & (j < size)
                same = there & (self.codes[start + np.clip(j, 0, size - 1)] == code)
                cells.append(np.where((j >= -1) & (j < size), before[:, k + 1] + ~same, 2))
            cells[0] = np.minimum(cells[0], before[:, 1] + 1)
            cells[1] = np.minimum(np.minimum(cells[1], before[:, 2] + 1), cells[0] + 1)
            cells[2] = np.where(depth + 1 < size, np.minimum(cells[2], cells[1] + 1), 2)
            depth = depth + 1
            rows[base + depth] = np.minimum(np.stack(cells, axis=1), 2)
            whole = self.lengths[cursor] == depth
            distance = np.where(depth == size, cells[1], cells[0])
            hit = whole & (distance == 1)
            if hit.any():
                pairs.append((query[hit], cursor[hit]))
            dead = np.minimum(np.minimum(cells[0], cells[1]), cells[2]) > 1
            move = np.flatnonzero(whole | dead)
            if len(move):
                target = np.where(dead[move], self.after(cursor[move], depth[move]), cursor[move] + 1)
                cursor[move] = target
                depth[move] = np.minimum(depth[move], self.lcp[target])
                done = cursor >= self.end[query]
                if done.any():
                    query, cursor, depth, size, base = (x[~done] for x in (query, cursor, depth, size, base))
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*pairs))


def _near_in(rows: pa.Table) -> pa.RecordBatch:
    """The near pairs, in both directions, of whole groups in their order."""
    rows = rows.combine_chunks()
    column = {name: rows.column(name).chunk(0) for name in rows.column_names}
    size, low, high = (column[c].to_numpy() for c in ("size", "low", "high"))
    first = np.ones(rows.num_rows, dtype=bool)
    first[1:] = (size[1:] != size[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    first[1:] |= pc.not_equal(column["fixed"].slice(1), column["fixed"].slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
    head = np.minimum(np.maximum(low, np.maximum(size - high, 0)), size - 1).astype(np.int64)
    words = _Sorted(column["form"], first, head)
    found, other = words.scan(np.flatnonzero(words.lengths == size))
    longer = words.lengths[other] > size[other]  # found from the shorter word only
    left, right = np.concatenate([found, other[longer]]), np.concatenate([other, found[longer]])
    pick = lambda name, at: column[name].take(pa.array(at))
    return pa.RecordBatch.from_arrays([pick("size", left), pick("low", left), pick("high", left), pick("form", left), pick("form", right), pick("n", right)], ["size", "low", "high", "word", "near", "near_n"])


def _near_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups, about ``CHUNK_CHARS`` code points at a time."""
    held: list[pa.RecordBatch] = []
    chars = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        chars += pc.sum(pc.utf8_length(batch.column("form"))).as_py()
        if chars < CHUNK_CHARS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        last = [rows.column(c)[-1].as_py() for c in _GROUP]
        same = pc.equal(rows.column("fixed"), last[3])
        for name, value in zip(_GROUP[:3], last[:3]):
            same = pc.and_(same, pc.equal(rows.column(name), value))
        cut = rows.num_rows - pc.sum(same).as_py()  # the last group may go on
        if cut:
            yield _near_in(rows.slice(0, cut))
        held = rows.slice(cut).to_batches()
        chars = pc.sum(pc.utf8_length(rows.column("form").slice(cut))).as_py()
    if held:
        yield _near_in(pa.Table.from_batches(held))


def near_words(words: DataFrame, group_chars: int = GROUP_CHARS) -> DataFrame:
    """``word, near, near_n``: every ordered pair of near words once, with the count of the second. ``words`` has
    distinct non-empty ``word`` and ``n``."""
    dealt = _dealt(words, group_chars).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "form")
    found = dealt.mapInArrow(_near_batches, "size int, low int, high int, word string, near string, near_n bigint")
    backward = F.col("low") < F.col("size") - F.col("high")
    pairs = found.select("high", *(F.when(backward, F.reverse(c)).otherwise(F.col(c)).alias(c) for c in ("word", "near")), "near_n")
    # A pair belongs to the interval that holds the length of its common prefix; others find it too.
    return pairs.where(F.expr("substr(word, 1, high) <> substr(near, 1, high)")).drop("high")


def group_variants(words: DataFrame, ratio: int = 2, group_chars: int = GROUP_CHARS) -> DataFrame:
    """One row per row of ``words`` (``word, n``, distinct non-empty words): ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of the largest n, of several the first in code-point order, if that n is at least
    ``ratio`` (above 1) times the word's own; else null. ``root`` is the last word on the way from form to form,
    the word itself without a form. An empty table gives no rows; further columns are not read.
    """
    words = saved(words.select("word", F.col("n").cast("bigint").alias("n")), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    near = near_words(words, group_chars).groupBy("word").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.minus")
    has_form = form_n >= ratio * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, form_n).alias("form_n")
    )
    rows = saved(rows, "spelling-forms")
    # Every step at least doubles n, so a way is short and never closes; its length doubles with every round.
    ways = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = saved(ways.join(on, "root", "left"), "spelling-ways")
        if longer.where("next IS NOT NULL").isEmpty():
            break
        ways = longer.select("word", F.coalesce("next", "root").alias("root"))
    ends = longer.select("word", "root")
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
