"""Near-duplicate detection: banded MinHash candidates, sequential Bayesian pruning, exact verification.

1. Texts with equal shingle sets are one class; its smallest id stands for it. Copies are never paired.
2. Each class has a signature of MinHash values and a key per band. Classes that share a band key are a bucket.
3. Star round: every member of a bucket is a candidate with the bucket's centre, the member that shares
   buckets with most others. The origin of a family of copies is in more and larger buckets than any copy, so
   it is the centre wherever it occurs and its copies are connected with one comparison each.
4. Candidates are compared batch by batch of the signature. After each batch the posterior of the similarity
   (uniform prior) is bounded: a pair whose probability to reach the threshold is below ``miss`` is pruned.
5. Survivors are verified on their full sets. Links are joined to components by star contraction.
6. Rest round: in buckets that still hold several components the remaining pairs of different components are
   compared in blocks of bounded size, pruned and verified where they are; only links come out. So every pair
   of a bucket is either compared or already connected, and a bucket of copies of one text costs one
   comparison per member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import NOT_BLANK, byte_slices, fresh, lists, mix, small_enough, with_fields, words
from brooklet.session import saved


BLOCK_ITEMS = 2_000_000  # shingles of the sets that are compared at a time


@dataclass(frozen=True)
class MinHash:
    """``bands`` x ``rows`` values. At similarity 0.8 a pair shares no band with probability 1.3e-7."""

    shingle: int = 2
    percent: int = 80  # link if 100 x intersection >= percent x union
    bands: int = 40
    rows: int = 5
    batch: int = 40
    miss: float = 1e-5
    block: int = 1024

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def needed(self) -> list[tuple[int, int, int]]:
        """For each batch (from, to, matches needed): with fewer matches the posterior probability that the
        similarity reaches the threshold, which is P(Binomial(n + 1, threshold) <= matches), is below ``miss``."""
        t, out = self.percent / 100, []
        for n in [*range(self.batch, self.size, self.batch), self.size]:
            total, m = 0.0, -1
            while total < self.miss:
                m += 1
                total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append((out[-1][1] if out else 0, n, m))
        return out

    def coefficients(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(7)
        a, b = rng.integers(0, 2**63, (2, self.size), dtype=np.uint64)
        return a * np.uint64(2) + np.uint64(1), b


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct k-word shingles; of all its words if it has fewer."""
    found = words(column, NOT_BLANK)
    by_length = {n: found.grams(n) for n in {int(c) for c in np.unique(np.minimum(found.counts, k))} if n}
    out = []
    for i, count in enumerate(found.counts.tolist()):
        if not count:
            out.append(np.zeros(0, np.uint64))
            continue
        at, hashes = by_length[min(count, k)]
        a, b = np.searchsorted(at, (found.offsets[i], found.offsets[i + 1]))
        out.append(np.unique(hashes[a:b]))
    return out


def _signatures(rows: DataFrame, how: MinHash) -> DataFrame:
    """``id, n, k1, k2, bands, sig``: set size, 128 bits that name the set, band keys and 16 bits of each value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = how.coefficients()
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                sets = shingle_sets(batch.column("text"), how.shingle)
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                begins = (np.cumsum(n) - n)[full]
                names = np.zeros((2, len(sets)), dtype=np.uint64)
                bands = np.zeros((len(sets), how.bands), dtype=np.uint64)
                sig = np.zeros((len(sets), how.size), dtype=np.uint16)
                if len(full):
                    names[0, full] = np.add.reduceat(mix(flat), begins)
                    names[1, full] = np.add.reduceat(mix(flat * np.uint64(0x9FB21C651E98DF25)), begins)
                    for j in range(how.size):
                        least = mix(np.minimum.reduceat(flat * a[j] + b[j], begins))
                        sig[full, j] = (least & np.uint64(0xFFFF)).astype(np.uint16)
                        bands[full, j // how.rows] = mix(bands[full, j // how.rows] * np.uint64(0xD6E8FEB86659FD93) + least + np.uint64(j))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        pa.array(n, pa.int64()),
                        pa.array(names[0].view(np.int64)),
                        pa.array(names[1].view(np.int64)),
                        lists(pa.array(bands.ravel().view(np.int64)), how.bands * np.arange(len(sets) + 1)),
                        pa.array([s.tobytes() for s in sig], pa.binary()),
                    ],
                    ["id", "n", "k1", "k2", "bands", "sig"],
                )

    return rows.mapInArrow(run, with_fields(rows.select("id"), "n bigint, k1 bigint, k2 bigint, bands array<bigint>, sig binary"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, size)


def _band_keys(table: pa.Table, how: MinHash) -> np.ndarray:
    return table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, how.bands)


def _prune(pairs: DataFrame, sigs: DataFrame, how: MinHash) -> DataFrame:
    """The pairs ``a, b`` that may reach the threshold, compared batch by batch of their signatures."""
    needed = how.needed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _matrix(batch.column("sa"), how.size), _matrix(batch.column("sb"), how.size)
            alive, matches = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
            for first, last, least in needed:
                matches[alive] += (left[alive, first:last] == right[alive, first:last]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    both = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a").join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, with_fields(pairs.select("a", "b")))


def _sets(rows: DataFrame, ids: DataFrame, how: MinHash) -> DataFrame:
    """``id, items``: the full sets of some documents, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                sets = shingle_sets(batch.column("text"), how.shingle)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), lists(pa.array(flat), np.cumsum([0, *map(len, sets)]))], ["id", "items"])

    return saved(rows.join(small_enough(ids), "id", "left_semi").mapInArrow(run, with_fields(rows.select("id"), "items array<bigint>")), "near-sets")


def _verify(rows: DataFrame, pairs: DataFrame, how: MinHash) -> DataFrame:
    """The pairs that are links by their full sets."""
    sets = _sets(rows, saved(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "near-ids"), how)
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("ia")), "a").join(sets.select(F.col("id").alias("b"), F.col("items").alias("ib")), "b")
    both = both.withColumn("inter", F.size(F.array_intersect("ia", "ib"))).withColumn("union", F.size("ia") + F.size("ib") - F.col("inter"))
    return both.where(100 * F.col("inter") >= how.percent * F.col("union")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id in ``links(a, b)``: the label is the smallest id connected to it.

    Large-star and small-star steps alternate until every link leads to the smallest id of its component. Each
    step is an aggregation of a minimum, merged before the shuffle, and a join that Spark can split.
    """
    edges = saved(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-edges")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = saved(joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct(), "near-edges")
        changed = small.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(small, ["u", "v"], "left_anti").isEmpty()
        edges = small
        if changed:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("label"))).distinct()


def _survivors(left: np.ndarray, right: np.ndarray, same: bool, label: np.ndarray, sig: np.ndarray, bands: np.ndarray, band: int, how: MinHash) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of two blocks of a bucket with different labels that the signatures do not rule out. A pair that
    shares several buckets is left to the first of them."""
    needed = how.needed()
    for part in np.array_split(left, len(left) // 64 + 1):
        differ = label[part][:, None] != label[right][None, :]
        if same:
            differ &= part[:, None] < right[None, :]
        x, y = np.nonzero(differ)
        x, y = part[x], right[y]
        matches = np.zeros(len(x), dtype=np.int64)
        for first, last, least in needed:
            matches += (sig[x, first:last] == sig[y, first:last]).sum(axis=1)
            alive = matches >= least
            x, y, matches = x[alive], y[alive], matches[alive]
        first_seen = (bands[x] == bands[y]).argmax(axis=1) == band
        yield x[first_seen], y[first_seen]


def _buckets(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, bool, int]]:
    """The two blocks of each bucket of a sorted table, as row numbers, whether they are one, and the band."""
    bucket, band, own = (table.column(c).to_numpy() for c in ("bucket", "band", "own"))
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    bounds = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
    for low, high in zip(bounds[:-1], bounds[1:]):
        rows = np.arange(low, high)
        yield rows[own[rows] == i], rows[own[rows] == j], i == j, int(band[low])


def _rest(rows: DataFrame, members: DataFrame, sigs: DataFrame, labels: DataFrame, how: MinHash) -> DataFrame:
    """Links between different components in the same bucket that the star round has not compared.

    A first pass over the signatures keeps the members with a pair that may be a link, a second one has their
    full sets and verifies. What either gives out is no more than the members, however many pairs there are.
    """
    label = F.coalesce("label", F.col("id"))
    labelled = members.join(labels, "id", "left").select("bucket", "band", "id", "n", label.alias("label"), "centre").where("id != centre")
    open_ = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"), F.sum("n").alias("items")).where("low != high")
    # A block is bounded by its members and by the size of their sets.
    blocks = F.ceil(F.greatest(F.col("size") / how.block, F.col("items") / BLOCK_ITEMS)).cast("int")
    there = labelled.join(saved(open_.select("bucket", blocks.alias("blocks")), "near-open"), "bucket")
    # A bucket of more than one block meets itself block by block.
    there = there.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    there = saved(there.select("bucket", "band", "id", "n", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")), "near-rest")
    kind = members.schema["id"].dataType.simpleString()
    plain = there.columns

    def keep(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bucket", "ascending")])
        label, sig, bands = table.column("label").to_numpy(), _matrix(table.column("sig"), how.size), _band_keys(table, how)
        used = np.zeros(len(label), dtype=bool)
        for left, right, same, band in _buckets(table):
            for x, y in _survivors(left, right, same, label, sig, bands, band, how):
                used[x] = used[y] = True
        return table.filter(pa.array(used)).select(plain)

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bucket", "ascending")])
        label, sig, bands = table.column("label").to_numpy(), _matrix(table.column("sig"), how.size), _band_keys(table, how)
        items, size_of = table.column("items").combine_chunks(), table.column("n").to_numpy()
        found_a, found_b = [], []
        for left, right, same, band in _buckets(table):
            pairs = list(_survivors(left, right, same, label, sig, bands, band, how))
            x, y = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            if not len(x):
                continue
            joined = {}

            def root(name):
                while joined.get(name, name) != name:
                    name = joined[name]
                return name

            # Some sets of the right block at a time as one array of numbers; a set on the left marks its own and is counted
            # in all.
            wanted = np.unique(y)
            reach = np.cumsum(size_of[wanted])
            at = 0
            while at < len(wanted):
                end = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + BLOCK_ITEMS, "right")))
                some, at = wanted[at:end], end
                many = items.take(pa.array(some))
                flat, begins, sizes = many.flatten().to_numpy(), many.offsets.to_numpy()[:-1] - many.offsets[0].as_py(), many.value_lengths().to_numpy()
                vocabulary, codes = np.unique(flat, return_inverse=True)
                mine = np.flatnonzero((y >= some[0]) & (y <= some[-1]))
                mine = mine[np.argsort(x[mine], kind="stable")]
                heads = np.flatnonzero(np.diff(x[mine], prepend=-1))
                for first, last in zip(heads.tolist(), [*heads[1:].tolist(), len(mine)]):
                    row, partners = int(x[mine[first]]), y[mine[first:last]]
                    own = items[row].values.to_numpy()
                    there_ = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
                    marked = np.zeros(len(vocabulary), dtype=np.int64)
                    marked[there_[vocabulary[there_] == own]] = 1
                    inter = np.add.reduceat(marked[codes], begins)
                    for partner, n in zip(partners.tolist(), np.searchsorted(some, partners).tolist()):
                        if 100 * inter[n] >= how.percent * (len(own) + sizes[n] - inter[n]):
                            a, b = root(label[row]), root(label[partner])
                            if a != b:  # one link is enough to join two components
                                joined[max(a, b)] = min(a, b)
                                found_a.append(row)
                                found_b.append(partner)
        ids = table.column("id").combine_chunks()
        return pa.table({"a": ids.take(pa.array(found_a, pa.int64())), "b": ids.take(pa.array(found_b, pa.int64()))})

    def grouped(df: DataFrame, size: int, *with_: DataFrame):
        n, held = df.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        groups = max(64, n // size, held // (2 * BLOCK_ITEMS) if with_[1:] else 0)  # those with sets by their sizes too
        for other in with_:
            df = df.join(other, "id")
        return df.withColumn("many", F.pmod("bucket", F.lit(groups))).groupBy("many", "i", "j")

    left_over = saved(grouped(there, 20_000, sigs).applyInArrow(keep, with_fields(there)), "near-left")
    sets = _sets(rows, saved(left_over.select("id").distinct(), "near-ids"), how)
    return grouped(left_over, 4_000, sigs, sets).applyInArrow(verify, f"a {kind}, b {kind}")


def link_near_copies(docs: DataFrame, how: MinHash = MinHash(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, n_shingles, component_id, kept``.

    Words are what stands between blanks, with A-Z in lower case. A document is linked to another if
    100 x intersection >= percent x union of their sets of shingles. ``component_id`` is the smallest id that
    links reach, its own included; ``kept`` tells whether that is its own. Null, empty and blank texts have no
    shingles and are linked with nothing. Rows that share an id are one document with several texts. A null
    id is linked with nothing and kept. An empty table gives no rows; other columns are not read. A link is
    missed with probability 1.3e-7 + 5 x ``miss`` at the threshold, less above it.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    table = saved(_signatures(rows, how), "near-signatures")
    small = table.select("id", "n", "k1", "k2")
    usable = small.where("n > 0 AND id IS NOT NULL")
    classes = saved(usable.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "near-classes")
    several = classes.where("copies > 1").select("k1", "k2", "rep")
    extra = saved(usable.join(several, ["k1", "k2"]).where("id != rep").select("id", "k1", "k2"), "near-copies")
    reps = table.where("n > 0 AND id IS NOT NULL").join(small_enough(extra), ["id", "k1", "k2"], "left_anti")
    sigs = reps.select("id", "sig")
    keyed = reps.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
    sizes = saved(keyed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "near-sizes")
    shared = saved(keyed.join(sizes, "bucket"), "near-shared")
    known = saved(shared.groupBy("id").agg(F.sum("size").alias("company")), "near-company")
    # Most company first, then the smallest id.
    first = F.min(F.struct((-F.col("company")).alias("company"), "id"))["id"].alias("centre")
    members = saved(shared.drop("size").join(saved(shared.join(known, "id").groupBy("bucket").agg(first), "near-centres"), "bucket"), "near-members")
    pairs = members.where("id != centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    links = saved(_verify(rows, saved(_prune(pairs, sigs, how), "near-pairs"), how), "near-links")
    labels = saved(components(links), "near-labels")
    rest = saved(_rest(rows, members, reps.select("id", "sig", "bands"), labels, how), "near-rest-links")
    if not rest.isEmpty():
        labels = saved(components(links.union(rest)), "near-labels")
    named = several.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("k1", "k2", F.coalesce("label", "rep").alias("by_class"))
    found = small.join(named, ["k1", "k2"], "left").join(labels, "id", "left")
    component = F.when(F.col("n") > 0, F.coalesce("by_class", "label", "id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, how: MinHash = MinHash(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; all columns stay."""
    name = fresh(docs, "gone")
    gone = saved(link_near_copies(docs, how, id, text).where("NOT kept").select(F.col(id).alias(name)).distinct(), "near-gone")
    return docs.join(small_enough(gone), docs[id] == F.col(name), "left_anti")
