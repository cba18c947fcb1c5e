"""N-gram Jaccard join as a metric-space join.

A document is the set of its distinct 4-word shingles; documents link at a Jaccard similarity
of at least 85/100, that is at a distance of at most E = 0.15, and Jaccard distance is a metric.
A distance of 1 to a pivot says nothing about a document, and most documents are at distance
1 from most others. So the space is first cut into neighbourhoods in which distances mean
something, and the pivots work there:

1. *Neighbourhoods.* Two linked documents share one of their first ``n - ceil(0.85 n) + 1``
   shingles in any common order. The order puts shingles of many documents last (found with a
   fixed-size counting sketch over all documents), then follows the hash. The documents with
   one shingle, cut wherever sizes leave a gap no link can bridge, are a neighbourhood.
2. *Contracted space.* A document's shingle counts in 128 hash classes (long documents: in 2,048)
   are its distances to as many pivot sets; their L1 distance never exceeds the symmetric difference, so the triangle
   inequality excludes unrelated texts without reading them again. Neighbourhoods of up to
   ``SMALL`` documents give their pairs to this test. Larger ones become the region of their
   pivot (smallest fingerprint); regions of frequent shingles whose pivots meet are merged, so
   that one group of near copies is one region. In a region each pivot in turn takes those it
   may link to into its ball; what is outside meets only the ball's window
   ``|d(x, p) - d(y, p)| <= bound`` and is joined recursively. A region yields at most two
   candidate links per document.
3. *Exact regions.* Documents connected by candidates form a region that is joined by the same
   recursion on exact distances: a pivot's ball is linked through it, a document outside meets
   the ball's window ``|d(x, p) - d(y, p)| <= E``, the outside is joined recursively. Every
   document's shingles move once.
4. *Large regions* (more than ``LEAF`` documents or ``LEAF_SHINGLES`` shingles) meet pivots in
   rounds, ``PIVOTS`` and more for larger ones. A document within E of pivots is linked to them and
   at home in the ball of the nearest. A ball is connected, so its documents need not meet each
   other: only those outside, at most 2E away and not connected with it yet, meet its window.
   Documents at home nowhere are the region of the next round. If a round leaves more than
   ``SHRINK`` of them, pivots do not divide the region and its blocks meet pair by pair: a
   document then moves about ``2 size / LEAF`` times, once, so this ends.

Equal sets (copies) are one class with a fingerprint, so a group of copies is one point.
Links are then reduced to components by alternating large-star and small-star steps.

Defined results: a null, empty or wordless text has 0 shingles and is its own component; a
text of 1 to 3 words is one shingle; repeated rows get equal results; a null id takes part, the
component's id is its smallest non-null one (for an unlinked wordless row its own id, which may
be null); an empty table gives no rows. Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import (bounded_batches, chunks, cut, give_back, mix, own_names, read_table,
                                shingle_hashes, word_hashes)

SHINGLE = 4
PERCENT = 85
SMALL, PIVOTS = 8, 8
LEAF, LEAF_SHINGLES = 8192, 2_000_000
SLAB = 500_000             # shingles compared with one set at once
CLASSES, FINE_CLASSES = 128, 2048      # pivot sets of the contracted space
FINE_FROM = 1500           # shingles from which a document has the finer counts too
SKETCH_BITS = 22           # counters of the sketch of shingle frequencies
SKETCH_PARTS = 64
FILTER_BITS = 26           # bits of the filter that spares unneeded sets
MOST_PIVOTS = 64
SEEN = 1 << 17             # sets a task remembers to emit copies once
BROADCAST_IDS = 1 << 17    # rows that go, up to which their keys are broadcast
SHRINK = 0.75
PAIR, RARE, FREQUENT = 0, 1, 2


# --- inside tasks -----------------------------------------------------------------------

def shingle_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    hashes, bounds = word_hashes(texts)
    for i in range(len(texts)):
        w = hashes[bounds[i]:bounds[i + 1]]
        if 0 < len(w) < n:
            yield shingle_hashes(w, len(w)) + np.uint64(len(w))
        else:
            yield np.unique(shingle_hashes(w, n))


def fingerprint(s: np.ndarray) -> int:
    """Of the set; 64 bits, as a signed long."""
    if not len(s):
        return 0
    total = np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(s))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def counts(s: np.ndarray) -> bytes:
    """Shingles per hash class, modulo 256."""
    bits = 11 if len(s) >= FINE_FROM else 7
    return np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint8).tobytes()


def similar(common, n_a, n_b, percent: int):
    return 100 * common >= percent * (n_a + n_b - common)


def _batch(schema: str, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays],
                                      names=schema.split())


# --- classes and the sketch -------------------------------------------------------------

def measure(docs: DataFrame, n: int) -> DataFrame:
    """Rows (part null, doc_id, mark, n, fp, blob = class counts) per document, and per task and
    part of the sketch (part, blob = counters)."""
    schema = "part int, doc_id long, mark long, n int, fp long, blob binary"
    names = "part doc_id mark n fp blob"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        held, size = [], 0

        def count():
            found, times = np.unique(np.concatenate(held), return_counts=True)
            sketch[found] += times.astype(np.uint32)

        for batch in batches:
            ns, fps, blobs = [], [], []
            for _, texts in chunks(batch.column(2)):
                for s in shingle_sets(texts, n):
                    ns.append(len(s))
                    fps.append(fingerprint(s))
                    blobs.append(counts(s))
                    held.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                    size += len(s)
                if size > SLAB:
                    count()
                    held, size = [], 0
            yield _batch(names, pa.nulls(len(ns), pa.int32()), batch.column(0), batch.column(1),
                         pa.array(ns, pa.int32()), pa.array(fps, pa.int64()), pa.array(blobs, pa.binary()))
        if held:
            count()
        if sketch.any():
            parts = np.minimum(sketch, 65535).astype(np.uint16).reshape(SKETCH_PARTS, -1)
            for k, part in enumerate(parts):
                yield _batch(names, pa.array([k], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                             pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
                             pa.array([zlib.compress(part.tobytes(), 1)], pa.binary()))

    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(give_back(run), schema)


def frequent(measured: DataFrame) -> np.ndarray:
    """Bit per counter: well above the usual load, so some shingle there is in many documents.
    It only decides the order of shingles; its size is fixed."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = np.frombuffer(zlib.decompress(blob), np.uint16).astype(np.int64)
                sums[part] = sums[part] + c if part in sums else c
        bits = []
        for c in sums.values():
            usual = float(np.median(c))
            bits.append(np.packbits(c > usual + 5 * usual ** 0.5 + 16).tobytes())
        yield _batch("part bits", pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary()))

    parts = (measured.filter("part IS NOT NULL").select("part", "blob").repartition(SKETCH_PARTS, "part")
                     .mapInArrow(add, "part int, bits binary").collect())
    out = np.zeros(1 << SKETCH_BITS, bool).reshape(SKETCH_PARTS, -1)
    for r in parts:
        out[r["part"]] = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    return np.packbits(out.reshape(-1))


# --- neighbourhoods ---------------------------------------------------------------------

def first_shingles(docs: DataFrame, many: np.ndarray, n: int, percent: int) -> DataFrame:
    """(shingle, fp, n, many): the shingles under which a document can meet those it links to.
    Copies within a task are emitted once."""
    shared = docs.sparkSession.sparkContext.broadcast(many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(shared.value).astype(bool)
        seen: set[int] = set()
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                out, fps, ns, flags = [], [], [], []
                for s in shingle_sets(texts, n):
                    fp = fingerprint(s)
                    if not len(s) or fp in seen:
                        continue
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(fp)
                    take = len(s) - (percent * len(s) + 99) // 100 + 1
                    m = often[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    light = s[~m][:take]
                    rest = s[m][:take - len(light)]
                    out += [light, rest]
                    flags.append(np.arange(take) >= len(light))
                    fps.append(np.full(take, fp, np.int64))
                    ns.append(np.full(take, len(s), np.int32))
                if out:
                    yield _batch("shingle fp n many", np.concatenate(out).view(np.int64), np.concatenate(fps),
                                 np.concatenate(ns), np.concatenate(flags))

    return docs.select("text").mapInArrow(give_back(run), "shingle long, fp long, n int, many boolean")


def _neighbours(shingle, fp, n, percent: int, small: int):
    """From complete neighbourhoods, sorted by (shingle, n, fp): pairs of the small ones and
    (document, pivot) of the large ones."""
    new = np.ones(len(fp), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (fp[1:] != fp[:-1])
    shingle, fp, n = shingle[new], fp[new], n[new].astype(np.int64)
    if not len(fp):
        return [(fp, fp, False)]
    edge = np.ones(len(fp), bool)
    edge[1:] = (shingle[1:] != shingle[:-1]) | (percent * n[1:] > 100 * n[:-1])
    start = np.flatnonzero(edge)
    size = np.diff(np.append(start, len(fp)))
    segment = np.repeat(np.arange(len(start)), size)
    big = (size > small)[segment]
    out = []
    for k in range(1, small):
        i = np.flatnonzero((segment[k:] == segment[:-k]) & ~big[k:])
        if not len(i):
            break
        i = i[percent * n[i + k] <= 100 * n[i]]
        a, b = np.minimum(fp[i], fp[i + k]), np.maximum(fp[i], fp[i + k])
        out.append((a, b, False))
    if big.any():
        pivot = np.minimum.reduceat(fp, start)[segment]
        out.append((fp[big], pivot[big], True))
    return out


def meetings(rows: DataFrame, percent: int, small: int) -> DataFrame:
    """(a, b, kind): pairs to test (``PAIR``), and members a of the region of pivot b, by a
    shingle of few (``RARE``) or of many (``FREQUENT``) documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)]

        def emit(part):
            for a, b, region in _neighbours(*part, percent, small):
                if len(a):
                    ab = np.unique(np.stack([a, b], 1), axis=0)
                    yield _batch("a b kind", ab[:, 0].copy(), ab[:, 1].copy(),
                                 np.full(len(ab), RARE if region else PAIR, np.int32))

        for batch in batches:
            cols = [np.concatenate([k, batch.column(i).to_numpy()]) for i, k in enumerate(keep)]
            if not len(cols[0]):
                continue
            end = int(np.searchsorted(cols[0], cols[0][-1]))     # the last shingle may go on
            yield from emit([c[:end] for c in cols])
            keep = [c[end:] for c in cols]
        yield from emit(keep)

    # a shingle of few documents: one task holds its neighbourhood
    light = (rows.filter("NOT many").select("shingle", "fp", "n").repartition("shingle")
                 .sortWithinPartitions("shingle", "n", "fp").mapInArrow(run, "a long, b long, kind int"))
    # of many documents: the pivot of each (shingle, size class) by aggregation and join; sizes
    # of linked documents are in the same or in adjacent classes
    width = float(np.log(100 / percent))
    cls = F.floor(F.log(F.col("n")) / width).cast("int")
    wide = (rows.filter("many").select("shingle", "fp", F.explode(F.array(cls, cls + 1)).alias("size"))
                .distinct())
    pivots = wide.groupBy("shingle", "size").agg(F.min("fp").alias("b"), F.max("fp").alias("last"))
    heavy = (wide.join(pivots.filter("b < last").drop("last"), ["shingle", "size"])
                 .select(F.col("fp").alias("a"), "b", F.lit(FREQUENT).alias("kind")))
    return light.unionByName(heavy).distinct()


# --- distances --------------------------------------------------------------------------

def _l1(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """L1 distance of counts, which are kept modulo 256: at most the symmetric difference."""
    gap = x - y                                    # wraps around
    return np.minimum(gap, -gap).sum(-1, dtype=np.int64)


class Vectors:
    """Points of the contracted space: coarse counts of all, fine counts of the long ones."""

    def __init__(self, blobs: list[bytes]):
        self.fine_at = np.full(len(blobs), -1)
        self.fine_at[[len(b) == FINE_CLASSES for b in blobs]] = range(sum(len(b) == FINE_CLASSES for b in blobs))
        self.fine = np.frombuffer(b"".join(b for b in blobs if len(b) == FINE_CLASSES), np.uint8).reshape(-1, FINE_CLASSES)
        self.coarse = np.empty((len(blobs), CLASSES), np.uint8)
        self.coarse[self.fine_at >= 0] = self.fine.reshape(len(self.fine), CLASSES, FINE_CLASSES // CLASSES).sum(2, dtype=np.uint8)
        self.coarse[self.fine_at < 0] = np.frombuffer(
            b"".join(b for b in blobs if len(b) == CLASSES), np.uint8).reshape(-1, CLASSES)

    def coarse_apart(self, many: np.ndarray, one) -> np.ndarray:
        return _l1(self.coarse[many], self.coarse[one])

    def refine(self, d: np.ndarray, many: np.ndarray, one: int) -> np.ndarray:
        """The larger of the coarse and the fine distance, where there is a fine one."""
        at = np.flatnonzero(self.fine_at[many] >= 0) if self.fine_at[one] >= 0 else np.empty(0, np.int64)
        if len(at):
            d = d.copy()
            d[at] = np.maximum(d[at], _l1(self.fine[self.fine_at[many[at]]], self.fine[self.fine_at[one]]))
        return d


def span_region(fps: np.ndarray, n: np.ndarray, vectors: Vectors, percent: int) -> list[tuple[int, int]]:
    """Candidate links that connect all pairs of a region which the contracted space does not
    exclude."""
    edges = []
    near = 100 - percent

    def able(d, many, one):
        ok = np.flatnonzero(d * (100 + percent) <= near * (n[many] + n[one]))
        out = np.zeros(len(many), bool)
        out[ok] = vectors.refine(d[ok], many[ok], one) * (100 + percent) <= near * (n[many[ok]] + n[one])
        return out

    rest = np.lexsort((fps, n))
    while len(rest) > 1:
        pivot, rest = rest[0], rest[1:]
        # sizes ascend: beyond this one, sizes alone exclude a link
        reach = int(np.searchsorted(percent * n[rest], 100 * n[pivot], side="right"))
        close, beyond = rest[:reach], rest[reach:]
        d = vectors.coarse_apart(close, pivot)
        ball = able(d, close, pivot)
        edges += [(int(fps[pivot]), int(fps[i])) for i in close[ball]]
        inside, d_in = close[ball], d[ball]
        outer = np.concatenate([close[~ball], beyond])
        if len(inside):
            d_out = vectors.coarse_apart(outer, pivot)
            most = near * (n[outer] + n[inside].max()) / (100 + percent)
            for i in np.flatnonzero(d_out - d_in.max() <= most):
                y = outer[i]
                window = inside[d_in >= d_out[i] - most[i]]
                ok = able(vectors.coarse_apart(window, y), window, y)
                if ok.any():               # one candidate joins it to the whole ball
                    edges.append((int(fps[y]), int(fps[window[ok.argmax()]])))
        rest = outer
    return edges


def span_regions(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """members (region, fp) of regions that fit a task → candidate links (a, b)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = span_region(rows["fp"].to_numpy(), rows["n"].to_numpy(np.int64), Vectors(rows["counts"].tolist()), percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (members.join(classes.select("fp", "n", "counts"), "fp").groupBy("region")
                   .applyInPandas(run, "a long, b long"))


def may_link(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the contracted space does not exclude."""
    c = classes.select("fp", "n", "counts")
    both = (pairs.join(c.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca")), "a")
                 .join(c.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb")), "b")
                 .select("a", "b", "na", "nb", "ca", "cb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            k = batch.num_rows
            v = Vectors(batch.column(4).to_pylist() + batch.column(5).to_pylist())
            sizes = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            d = _l1(v.coarse[:k], v.coarse[k:])
            at = np.flatnonzero((v.fine_at[:k] >= 0) & (v.fine_at[k:] >= 0))
            if len(at):
                d[at] = np.maximum(d[at], _l1(v.fine[v.fine_at[at]], v.fine[v.fine_at[k + at]]))
            ok = pa.array(d * (100 + percent) <= (100 - percent) * sizes)
            yield _batch("a b", batch.column(0).filter(ok), batch.column(1).filter(ok))

    return both.mapInArrow(give_back(run), "a long, b long")


def _spot(key):
    return F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS))


def _bit_filter(keys: DataFrame) -> np.ndarray:
    """Bits of the keys' spots: a table of fixed size, whatever the number of keys."""
    words = (keys.select(_spot(F.col(keys.columns[0])).alias("bit")).groupBy(F.shiftright("bit", 5).alias("word"))
                 .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                               (F.col("bit") % 32).cast("int"))).alias("bits"))).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return table


def _hits(table: np.ndarray, spots: pa.Array) -> np.ndarray:
    spot = spots.to_numpy()
    return ((table[spot >> 5] >> (spot & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)


def needed_sets(docs: DataFrame, classes: DataFrame, fps: DataFrame, n: int) -> DataFrame:
    """(fp, shingles) of the classes ``fps``. A bit filter of fixed size spares hashing most
    other texts; what it lets through in error is removed by the join."""
    table = _bit_filter(classes.join(fps, "fp", "left_semi").select("rep"))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    at = _spot(F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            ok = _hits(table, batch.column(0))
            for _, texts in chunks(batch.column(1).filter(pa.array(ok))):
                sets = list(shingle_sets(texts, n))
                yield _batch("fp shingles", pa.array([fingerprint(s) for s in sets], pa.int64()),
                             pa.array([s.tobytes() for s in sets], pa.binary()))

    sets = docs.select(at.alias("spot"), "text").mapInArrow(give_back(run), "fp long, shingles binary")
    return sets.join(fps, "fp", "left_semi").dropDuplicates(["fp"])


def _commons(one: np.ndarray, others: list[np.ndarray], n: np.ndarray) -> np.ndarray:
    """Shingles that ``one`` has in common with each of ``others`` (of sizes ``n``)."""
    out = np.empty(len(others), np.int64)
    ends = np.cumsum(n)
    a = 0
    while a < len(others):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - n[a] + SLAB)))
        pool = np.concatenate(others[a:b])
        at = np.searchsorted(one, pool)
        at[at == len(one)] = 0
        out[a:b] = np.add.reduceat((one[at] == pool).astype(np.int64), ends[a:b] - n[a:b] - (ends[a] - n[a]))
        a = b
    return out


def join_region(fps: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is linked within one region, by recursion on pivots."""
    links = []
    eps = 1 - percent / 100
    n = np.array([len(s) for s in sets])
    vectors = Vectors([counts(s) for s in sets])
    rest = np.argsort(fps, kind="stable")

    def common(p, others):
        return _commons(sets[p], [sets[i] for i in others], n[others])

    while len(rest) > 1:
        pivot, rest = rest[0], rest[1:]
        d = np.ones(len(rest))
        ball = np.zeros(len(rest), bool)
        # only those that may be within 2E need an exact distance
        able = np.flatnonzero(vectors.refine(vectors.coarse_apart(rest, pivot), rest, pivot) * (2 - 2 * eps)
                              <= (n[rest] + n[pivot]) * 2 * eps + 1e-6)
        if len(able):
            c = common(pivot, rest[able])
            ball[able] = similar(c, n[pivot], n[rest[able]], percent)
            d[able] = 1 - c / (n[pivot] + n[rest[able]] - c)
        links += [(int(fps[pivot]), int(fps[i])) for i in rest[ball]]
        inside, d_in = rest[ball], d[ball]
        for i in np.flatnonzero(~ball & (d <= 2 * eps + 1e-9)):
            window = inside[d_in >= d[i] - eps - 1e-9]
            if len(window):
                y = rest[i]
                ok = similar(common(y, window), n[y], n[window], percent)
                if ok.any():               # one link joins it to the whole ball
                    links.append((int(fps[y]), int(fps[window[ok.argmax()]])))
        rest = rest[~ball]
    return links


def join_leaves(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """members (region, fp) of regions that fit a task → links (a, b)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("fp")
        found = join_region(rows["fp"].to_numpy(), [np.frombuffer(x, np.uint64) for x in rows["shingles"]], percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return members.join(sets, "fp").groupBy("region").applyInPandas(run, "a long, b long")


def _sizes(members: DataFrame, sets: DataFrame, *keys: str) -> DataFrame:
    sized = members.join(sets.select("fp", (F.length("shingles") / 8).cast("long").alias("n")), "fp")
    return sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))


def _blocks(leaf: int):
    """Blocks of half a leaf."""
    return F.greatest(F.lit(1), F.least("size", F.ceil(F.greatest(
        2 * F.col("size") / leaf, 2 * F.col("shingles") / LEAF_SHINGLES)))).cast("int")


DIVIDED = "region long, fp long, cell int, home int, d double, b long"


def divide(members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, leaf: int) -> DataFrame:
    """One round for regions that are too large for a task: every member meets its region's pivots.
    Rows with ``b`` are links to the pivot ``b`` of the ball ``cell``; rows without are places of
    a member: in the ball where it is at home (``cell = home``), next to a ball ``cell`` that it
    may link into (``d`` from its pivot), or, with a null ``cell``, in the rest. Pivots have met
    everyone and have no place."""
    eps = 1 - percent / 100
    k = F.least(F.greatest(F.lit(PIVOTS), F.ceil(PIVOTS * F.col("size") / leaf)), F.lit(MOST_PIVOTS),
                F.ceil(LEAF_SHINGLES / 4 * F.col("size") / F.col("shingles")))
    plan = sizes.select("region", k.cast("int").alias("k"), (4 * _blocks(leaf)).alias("parts"))
    planned = members.join(plan, "region")
    picks = (planned.groupBy("region", "parts", F.pmod(F.xxhash64("fp"), "k").alias("slot")).agg(F.min("fp").alias("fp"))
                    .select("region", "fp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                            F.lit(True).alias("pivot")))
    rows = planned.select("region", "fp", F.pmod(F.xxhash64("fp", F.lit(1)), "parts").cast("int").alias("part"),
                          F.lit(False).alias("pivot")).unionByName(picks)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pivot", "fp"])
        fps, pivot = rows["fp"].to_numpy(), rows["pivot"].to_numpy(bool)
        hashes = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        n = np.array([len(x) for x in hashes])
        vectors = Vectors([counts(x) for x in hashes])
        who, heads = np.flatnonzero(~pivot), np.flatnonzero(pivot)
        d, ball = np.ones((len(who), len(heads))), np.zeros((len(who), len(heads)), bool)
        for i, p in enumerate(heads):
            able = np.flatnonzero(vectors.refine(vectors.coarse_apart(who, p), who, p) * (2 - 2 * eps)
                                  <= (n[who] + n[p]) * 2 * eps + 1e-6)
            if len(able):
                c = _commons(hashes[p], [hashes[x] for x in who[able]], n[who[able]])
                ball[able, i] = similar(c, n[p], n[who[able]], percent)
                d[able, i] = 1 - c / (n[p] + n[who[able]] - c)
        home = np.where(ball.any(1), np.where(ball, d, 2.0).argmin(1), -1)
        out = []                           # fp, cell, home, d, b; -1 where there is no cell or b
        for k, x in enumerate(who):
            fp, h = int(fps[x]), int(home[k])
            out += [(fp, int(i), h, 0.0, int(heads[i])) for i in np.flatnonzero(ball[k])]
            if (fps[heads] == fp).any():
                continue
            out.append((fp, h, h, float(d[k, h]) if h >= 0 else 1.0, -1))
            # two balls meet once: the documents of the later one next to the earlier one
            before = slice(h if h >= 0 else None)
            out += [(fp, int(i), h, float(d[k, i]), -1)
                    for i in np.flatnonzero(~ball[k, before] & (d[k, before] <= 2 * eps + 1e-9))]
        fp, cell, home, d, at = zip(*out) if out else [()] * 5
        at, cell = np.array(at, np.int64), np.array(cell, np.int32)
        return pd.DataFrame({
            "region": np.full(len(at), rows["region"].iloc[0]), "fp": np.array(fp, np.int64),
            "cell": pd.arrays.IntegerArray(cell, cell < 0), "home": np.array(home, np.int32),
            "d": np.array(d, np.float64), "b": pd.arrays.IntegerArray(fps[at], at < 0)})

    return rows.join(sets, "fp").groupBy("region", "part").applyInPandas(run, DIVIDED)


def windows(spark: SparkSession, step: DataFrame, percent: int) -> DataFrame:
    """(region, cell, fp, inside, d): the members of balls, and documents outside, that may link
    and are not connected through pivots yet."""
    def union(rows: pd.DataFrame) -> pd.DataFrame:
        root: dict = {}

        def top(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x
        for x, y in zip(rows["home"], rows["cell"]):
            root[max(top(x), top(y))] = min(top(x), top(y))
        return pd.DataFrame({"region": rows["region"].iloc[0], "cell": list(root), "team": [top(x) for x in root]})

    eps = 1 - percent / 100
    balls = step.filter("b IS NOT NULL").select("region", "home", "cell").distinct()
    teams = balls.groupBy("region").applyInPandas(union, "region long, cell int, team int")
    teams = cut(spark, teams, "jaccard-teams")
    placed = step.filter("b IS NULL AND cell IS NOT NULL")
    inside = placed.filter("cell = home").select("region", "cell", "fp", F.lit(True).alias("inside"), "d")
    outside = (placed.filter("cell != home").join(teams, ["region", "cell"])
                     .join(teams.select("region", F.col("cell").alias("home"), F.col("team").alias("own")), ["region", "home"], "left")
                     .filter("own IS NULL OR own != team")
                     .select("region", "cell", "fp", F.lit(False).alias("inside"), "d"))
    both = cut(spark, inside.unionByName(outside), "jaccard-places")
    ends = both.groupBy("region", "cell").agg(F.max(F.when(F.col("inside"), F.col("d"))).alias("reach"),
                                              F.min(F.when(~F.col("inside"), F.col("d"))).alias("first"))
    near = (F.col("inside") & (F.col("d") >= F.col("first") - eps - 1e-9)) | (
        ~F.col("inside") & (F.col("d") <= F.col("reach") + eps + 1e-9))
    return both.join(ends, ["region", "cell"]).filter(near).select(*both.columns)


def join_windows(met: DataFrame, sets: DataFrame, percent: int, leaf: int) -> DataFrame:
    """Rows of :func:`windows` → links (a, b) that connect documents outside with the ball. Both
    sides go in blocks, and every block of one side meets every block of the other."""
    eps = 1 - percent / 100
    sizes = _sizes(met, sets, "region", "cell", "inside").select("region", "cell", "inside", _blocks(leaf).alias("g"))
    sides = sizes.groupBy("region", "cell").agg(F.max(F.when(F.col("inside"), F.col("g"))).alias("g_in"),
                                                F.max(F.when(~F.col("inside"), F.col("g"))).alias("g_out"))
    own, other = (F.when(F.col("inside"), F.col(x)).otherwise(F.col(y)) for x, y in (("g_in", "g_out"), ("g_out", "g_in")))
    dealt = met.join(sides.filter("g_in IS NOT NULL AND g_out IS NOT NULL"), ["region", "cell"]).select(
        *met.columns, F.pmod(F.xxhash64("fp", F.lit(2)), own).cast("int").alias("mine"),
        F.explode(F.sequence(F.lit(0), other - 1)).alias("theirs"))
    dealt = dealt.select(*met.columns, F.when(F.col("inside"), F.col("mine")).otherwise(F.col("theirs")).alias("i"),
                         F.when(F.col("inside"), F.col("theirs")).otherwise(F.col("mine")).alias("o"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        fps, d, inside = rows["fp"].to_numpy(), rows["d"].to_numpy(), rows["inside"].to_numpy(bool)
        hashes = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        n = np.array([len(x) for x in hashes])
        vectors = Vectors([counts(x) for x in hashes])
        ball, links = np.flatnonzero(inside), []
        for y in np.flatnonzero(~inside):
            window = ball[d[ball] >= d[y] - eps - 1e-9]
            able = vectors.refine(vectors.coarse_apart(window, y), window, y)
            window = window[able * (100 + percent) <= (100 - percent) * (n[window] + n[y])]
            if len(window):
                ok = similar(_commons(hashes[y], [hashes[x] for x in window], n[window]), n[y], n[window], percent)
                if ok.any():               # one link joins it to the whole ball
                    links.append((int(fps[y]), int(fps[window[ok.argmax()]])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return dealt.join(sets, "fp").groupBy("region", "cell", "i", "o").applyInPandas(run, "a long, b long")


def pair_blocks(members: DataFrame, sizes: DataFrame, leaf: int) -> DataFrame:
    """(region, fp): regions cut into blocks; every two blocks of a region are a region."""
    g = members.join(sizes.select("region", F.greatest(F.lit(2), _blocks(leaf)).alias("g")), "region")
    g = g.withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(3)), "g").cast("int"))
    g = g.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1))).filter("mine != other")
    return g.select(F.xxhash64("region", F.least("mine", "other"), F.greatest("mine", "other")).alias("region"), "fp")


def region_links(spark: SparkSession, members: DataFrame, sets: DataFrame, percent: int, leaf: int) -> DataFrame:
    links, before = [], None
    while True:
        sizes = cut(spark, _sizes(members, sets, "region").filter("size > 1"), "jaccard-sizes")
        fits = (F.col("size") <= leaf) & (F.col("shingles") <= LEAF_SHINGLES)
        marked = cut(spark, members.join(sizes.select("region", fits.alias("fits")), "region"), "jaccard-regions")
        links.append(join_leaves(marked.filter("fits").select("region", "fp"), sets, percent))
        large = marked.filter("NOT fits").select("region", "fp")
        if large.isEmpty():
            break
        if before is not None:
            # where the last round left most documents, pivots do not divide the region
            stuck = (sizes.filter(~fits).join(before, "region").filter(F.col("size") > SHRINK * F.col("was"))
                          .select("region", "size", "shingles"))
            links.append(join_leaves(pair_blocks(large, stuck, leaf), sets, percent))
            large = large.join(stuck.select("region"), "region", "left_anti")
        step = cut(spark, divide(large, sizes.filter(~fits), sets, percent, leaf), "jaccard-cells")
        links.append(step.filter("b IS NOT NULL AND fp != b").select(F.col("fp").alias("a"), "b"))
        links.append(join_windows(cut(spark, windows(spark, step, percent), "jaccard-windows"), sets, percent, leaf))
        before = sizes.select("region", F.col("size").alias("was"))
        members = step.filter("b IS NULL AND cell IS NULL").select("region", "fp").distinct()
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def regions(spark: SparkSession, met: DataFrame, leaf: int) -> tuple[DataFrame, DataFrame]:
    """Members (region, fp) of regions that fit a task, and of those that do not. Regions of
    frequent shingles are merged where the pivot of one belongs to another, unless that makes
    a region too large for a task."""
    frequent_ = met.filter(F.col("kind") == FREQUENT).select("a", "b")
    pivots = frequent_.select(F.col("b").alias("a")).distinct()
    merged = components(spark, frequent_.join(pivots, "a", "left_semi")).select(F.col("node").alias("b"), "root")
    moved = frequent_.join(merged, "b", "left").select("a", "b", F.coalesce("root", "b").alias("root"))
    moved = cut(spark, moved, "jaccard-merged")
    sizes = moved.select("root", "a").distinct().groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    moved = moved.join(sizes, "root").select(
        F.when(F.col("size") < leaf, F.col("root")).otherwise(F.col("b")).alias("region"), F.col("a").alias("fp"))
    rare = met.filter(F.col("kind") == RARE).select(F.col("b").alias("region"), F.col("a").alias("fp"))
    # a region of either kind holds its pivot; the kinds are kept apart
    every = (moved.withColumn("kind", F.lit(FREQUENT)).unionByName(rare.withColumn("kind", F.lit(RARE))))
    every = every.unionByName(every.select("region", F.col("region").alias("fp"), "kind")).distinct()
    every = every.select(F.xxhash64("region", "kind").alias("region"), "fp")
    counted = cut(spark, every.join(every.groupBy("region").agg(F.count(F.lit(1)).alias("size")), "region"),
                  "jaccard-members")
    return (counted.filter(F.col("size") <= leaf).select("region", "fp"),
            counted.filter(F.col("size") > leaf).select("region", "fp"))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: alternating large-star and small-star steps
    until nothing changes. ``root`` is the component's smallest node."""
    edges = cut(spark, links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct(), "jaccard-links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .filter("u != v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
                     .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = cut(spark, small, "jaccard-stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state


def classes_of(spark: SparkSession, docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT,
               small: int = SMALL, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) → rows (doc_id, mark = hash of the text, n, fp), one per document, and the
    component of every non-empty set: (fp, root, component_id)."""
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = cut(spark, measure(docs, n), "jaccard-documents")
    rows = measured.filter("part IS NULL")
    classes = cut(spark, rows.filter("n > 0").groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.min("blob").alias("counts")), "jaccard-classes")
    firsts = cut(spark, first_shingles(docs, frequent(measured), n, percent), "jaccard-first")
    met = cut(spark, meetings(firsts, percent, small), "jaccard-meetings")
    pairs = may_link(met.filter(F.col("kind") == PAIR).select("a", "b"), classes, percent)
    fitting, large = regions(spark, met, leaf)
    candidates = components(spark, pairs.unionByName(span_regions(fitting, classes, percent)))
    candidates = cut(spark, candidates.select(F.col("root").alias("region"), F.col("node").alias("fp")),
                     "jaccard-candidates")
    wanted = cut(spark, candidates.select("fp").unionByName(large.select("fp")).distinct(), "jaccard-wanted")
    sets = cut(spark, needed_sets(docs, classes, wanted, n), "jaccard-sets")
    links = (region_links(spark, candidates, sets, percent, leaf)
             .unionByName(region_links(spark, large, sets, percent, leaf)))
    found = components(spark, links)
    roots = (classes.select("fp", "rep").join(found.withColumnRenamed("node", "fp"), "fp", "left")
                    .withColumn("root", F.coalesce("root", "fp")))
    ids = roots.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rows.select("doc_id", "mark", "n", "fp"), roots.select("fp", "root").join(ids, "root")


def join_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """(doc_id, text) → doc_id, n_shingles, component_id."""
    rows, found = classes_of(spark, docs, **options)
    own = rows.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"),
                                      F.col("doc_id").alias("component_id"))
    return (rows.filter("n > 0").join(found, "fp")
                .select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id").unionByName(own))


def one_of_each(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One document of each component: the one with the smallest id, without an id only where no
    other has one; of several texts under that id the one with the smallest hash; of several rows
    with that id and text the least in the order of their columns. Documents without a word are
    linked with nothing and stay, also where they repeat an id."""
    p = own_names(docs)
    rows, found = classes_of(spark, docs.select("doc_id", "text"), **options)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), "mark")
    rows = rows.filter("n > 0").join(found.select("fp", "root"), "fp").select("root", key.alias("key"))
    counted = cut(spark, rows.groupBy("root", "key").agg(F.count(F.lit(1)).alias("rows")), "jaccard-keys")
    chosen = cut(spark, counted.groupBy("root").agg(F.min("key").alias("key"), F.min_by("rows", "key").alias("rows")),
                 "jaccard-chosen")
    gone = cut(spark, counted.join(chosen.select("root", "key"), ["root", "key"], "left_anti").select("key"), "jaccard-gone")

    mine = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                    F.xxhash64("text").alias("mark"))
    marked = docs.withColumn(f"{p}key", mine)
    kept = _without(spark, marked, gone.withColumnRenamed("key", f"{p}key"), f"{p}key")
    repeated = cut(spark, chosen.filter("rows > 1").select(F.col("key").alias(f"{p}key")), "jaccard-repeated")
    if not repeated.isEmpty():
        once = (_only(spark, kept, repeated, f"{p}key").groupBy(f"{p}key")
                .agg(F.min(F.struct(*docs.columns)).alias(f"{p}row")).select(f"{p}row.*"))
        kept = _without(spark, kept, repeated, f"{p}key").select(*docs.columns).unionByName(once)
    return kept.select(*docs.columns)


def _without(spark: SparkSession, docs: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``docs`` whose key is not among ``keys``. Up to ``BROADCAST_IDS`` keys are broadcast; more
    of them meet only the documents that a filter of fixed size cannot pass, so that most texts
    are not moved."""
    if keys.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(keys), name, "left_anti")
    maybe = _maybe(spark, docs, keys, name)
    return docs.filter(~maybe).unionByName(docs.filter(maybe).join(keys, name, "left_anti"))


def _only(spark: SparkSession, docs: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``docs`` whose key is among ``keys``."""
    if keys.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(keys), name, "left_semi")
    return docs.filter(_maybe(spark, docs, keys, name)).join(keys, name, "left_semi")


def _maybe(spark: SparkSession, docs: DataFrame, keys: DataFrame, name: str):
    shared = spark.sparkContext.broadcast(_bit_filter(keys))

    @F.arrow_udf("boolean")
    def hit(spot: pa.Array) -> pa.Array:
        return pa.array(_hits(shared.value, spot))
    return hit(_spot(docs[name]))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(spark, read_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]
                             FOR i IN range(1, len(w) - 2)]) END AS g FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s),
r AS (SELECT doc_id, unnest(g) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM r a JOIN r b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(reach.b) AS component_id
FROM n JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n
"""
