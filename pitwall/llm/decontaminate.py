"""Benchmark decontamination with SimHash fingerprints of item-sized windows.

Words are compared in lower case without ASCII punctuation. For a benchmark item of ``m`` words
the windows are runs of ``m`` words of a document, at every offset; a shorter document is one
window. A window's fingerprint is
the 64-bit SimHash of its 5-word shingles, each weighted by its rarity among the items. The
fingerprint splits into 8 blocks of 8 bits; two fingerprints at most 23 bits apart agree in at
least one block up to two bits, so an index that lists each item under its block values and
their neighbours of one and two bits finds every item within ``RADIUS``. The index alone names
candidates; they are verified by the exact weighted Jaccard similarity of their shingles, at
least 0.8.

A window similar to an item has at least 0.8 of the item's shingle weight in common with it.
So only windows that hold that much of some item are fingerprinted, and a candidate is only
verified where the window holds that much of this item; both exclude exactly.

A similar window whose fingerprint is more than 23 bits away is lost. At a similarity of 0.8 the
expected distance is 10 bits with a deviation of 3; measured recall against brute force is 1.0
(``tests/llm``: planted edits down to 0.8).

The items are read in blocks of ``ITEM_BLOCK``; one block's index is broadcast at a time, so
its size is bounded, and every block meets all documents.

Defined results: a null or empty text, item, or an item without words matches nothing; items of
fewer than 5 words are one shingle; per document and item the best window counts, ties by
position; repeated rows give repeated results; items with equal text all match; an empty table
on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import bounded_batches, chunks, read_table, shingle_hashes, word_hashes

SHINGLE = 5
MIN_SIMILARITY = 0.8
RADIUS = 23
NEIGHBOUR_BITS = 2
BLOCKS, BLOCK_BITS = 8, 8
ITEM_BLOCK = 20_000

_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_BITS = np.arange(64, dtype=np.uint64)


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    return shingle_hashes(words, min(size, SHINGLE))


@dataclass(frozen=True)
class Items:
    """One block of benchmark items. Shingles are sorted; ``owner`` lists the items of each."""
    ids: list
    words: np.ndarray                 # words per item
    total: np.ndarray                 # shingle weight per item
    shingles: np.ndarray              # distinct shingles of all items
    weight: np.ndarray                # of each shingle
    new_weight: float                 # of a shingle that no item has
    first: np.ndarray                 # postings: owner[first[s]:first[s + 1]]
    owner: np.ndarray
    prints: np.ndarray                # fingerprint per item
    own_first: np.ndarray             # shingles of item i: own[own_first[i]:own_first[i + 1]], ascending
    own: np.ndarray
    tables: dict                      # (size, block) → (first, items): listed[first[v]:first[v + 1]]


def _simhash(shingles: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of all windows of ``size`` shingles."""
    signs = ((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.float64) * 2 - 1
    sums = np.zeros((len(shingles) + 1, 64))
    np.cumsum(signs * weight[:, None], axis=0, out=sums[1:])
    return ((sums[size:] - sums[:-size] > 1e-9).astype(np.uint64) << _BITS).sum(1, dtype=np.uint64)


def build(ids: list, texts: list[bytes]) -> Items | None:
    hashes, bounds = word_hashes([t.translate(_WORDS) for t in texts])
    runs = [hashes[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
    keep = [i for i, r in enumerate(runs) if len(r)]
    if not keep:
        return None
    ids, runs = [ids[i] for i in keep], [runs[i] for i in keep]
    lists = [_shingles(r, len(r)) for r in runs]
    sets = [np.unique(x) for x in lists]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    shingles, first, held = np.unique(flat[order], return_index=True, return_counts=True)
    weight = np.log(1 + len(sets) / held)
    total = np.array([weight[np.searchsorted(shingles, x)].sum() for x in sets])
    prints = np.array([_simhash(x, weight[np.searchsorted(shingles, x)], len(x))[0] for x in lists], np.uint64)
    words = np.array([len(r) for r in runs])
    tables = {(int(m), b): _listed(prints, np.flatnonzero(words == m), b) for m in np.unique(words) for b in range(BLOCKS)}
    own = [np.searchsorted(shingles, x) for x in sets]
    return Items(ids, words, total, shingles, weight, float(np.log(1 + len(sets))),
                 np.append(first, len(flat)), owner[order], prints,
                 np.concatenate([[0], np.cumsum([len(x) for x in own])]), np.concatenate(own), tables)


def _neighbours() -> np.ndarray:
    """Masks of up to ``NEIGHBOUR_BITS`` bits of a block."""
    masks = np.arange(1 << BLOCK_BITS)
    return masks[np.bitwise_count(masks.astype(np.uint64)) <= NEIGHBOUR_BITS]


def _block(prints: np.ndarray, b: int) -> np.ndarray:
    return ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


def _listed(prints: np.ndarray, which: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The items ``which`` under their value of block ``b`` and its neighbours."""
    masks = _neighbours()
    value = (_block(prints[which], b)[:, None] ^ masks).ravel()
    order = np.argsort(value, kind="stable")
    return (np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1)),
            np.repeat(which, len(masks))[order].astype(np.int32))


def _within(items: Items, size: int, prints: np.ndarray) -> dict[int, list[int]]:
    """item → windows whose fingerprint is within the radius."""
    found: dict[int, set] = {}
    for b in range(BLOCKS):
        if (size, b) not in items.tables:
            continue
        first, listed = items.tables[size, b]
        values = _block(prints, b)
        for v in np.unique(values):
            here, there = np.flatnonzero(values == v), listed[first[v]:first[v + 1]]
            w, i = np.nonzero(np.bitwise_count(prints[here][:, None] ^ items.prints[there]) <= RADIUS)
            for item, window in zip(there[i].tolist(), here[w].tolist()):
                found.setdefault(item, set()).add(window)
    return {i: sorted(w) for i, w in found.items()}


def matches(items: Items, words: np.ndarray, bitmap: np.ndarray) -> list[tuple]:
    """(item index, first word, distance, similarity, words): the best window of each item."""
    out = []
    by_size: dict[int, list] = {}
    for size in {min(int(m), SHINGLE) for m in np.unique(items.words)}:
        s = shingle_hashes(words, size)
        spots = np.flatnonzero(bitmap[(s >> np.uint64(44)).astype(np.int64)])
        if not len(spots):
            continue
        at = np.searchsorted(items.shingles, s[spots])
        at[at == len(items.shingles)] = 0
        ok = items.shingles[at] == s[spots]
        spots, at = spots[ok], at[ok]
        if not len(spots):
            continue
        distinct = np.unique(at)
        reps = items.first[distinct + 1] - items.first[distinct]
        owners = np.concatenate([items.owner[items.first[x]:items.first[x + 1]] for x in distinct])
        got = np.bincount(owners, np.repeat(items.weight[distinct], reps), len(items.ids))
        for i in np.flatnonzero(got >= MIN_SIMILARITY * items.total - 1e-9):
            if min(int(items.words[i]), SHINGLE) == size:
                own = _held_by(items, at, int(i))
                by_size.setdefault(int(items.words[i]), []).append((int(i), spots[own], items.weight[at[own]]))
    for m, wanted in by_size.items():
        size = min(m, SHINGLE)
        run = min(m, len(words))          # a shorter document is one window
        per_window = run - size + 1
        s = shingle_hashes(words, size)
        last = len(words) - run
        near = np.unique(np.concatenate([x for _, x, _ in wanted]))
        # windows that hold one of the spots, as runs of starts
        low = np.maximum(near - per_window + 1, 0)
        high = np.minimum(near, last)
        ok = low <= high
        low, high = low[ok], high[ok]
        if not len(low):
            continue
        cutoff = np.flatnonzero(low[1:] > np.maximum.accumulate(high)[:-1] + 1)
        begins = low[np.append(0, cutoff + 1)]
        ends = np.append(np.maximum.accumulate(high)[cutoff], high.max())
        best: dict[int, tuple] = {}
        for b, e in zip(begins, ends):
            part = s[b:e + per_window]
            # the weight that an item's shingles have in each window, repeats included
            able = {i: _window_sums(where - b, held, len(part), per_window) >= MIN_SIMILARITY * items.total[i] - 1e-9
                    for i, where, held in wanted}
            worth = np.flatnonzero(np.logical_or.reduce(list(able.values())))
            if not len(worth):
                continue
            at = np.searchsorted(items.shingles, part)
            at[at == len(items.shingles)] = 0
            known = items.shingles[at] == part
            weight = np.where(known, items.weight[at], items.new_weight)
            at[~known] = -1
            prints = _simhash(part, weight, per_window)[worth]
            for i, close in _within(items, m, prints).items():
                for k in close if i in able else ():
                    w = int(worth[k])
                    if not able[i][w]:
                        continue
                    _, where = np.unique(part[w:w + per_window], return_index=True)
                    wt = weight[w:w + per_window][where]
                    common = wt[_held_by(items, at[w:w + per_window][where], i)].sum()
                    sim = common / (wt.sum() + items.total[i] - common)
                    rank = (-sim, int(b + w))
                    if sim >= MIN_SIMILARITY - 1e-12 and (i not in best or rank < best[i][0]):
                        apart = int(np.bitwise_count(prints[k] ^ items.prints[i]))
                        best[i] = (rank, (i, int(b + w), apart, float(sim), run))
        out += [x for _, x in best.values()]
    return sorted(out)


def _window_sums(where: np.ndarray, weight: np.ndarray, length: int, size: int) -> np.ndarray:
    """Sums over all windows of ``size`` of ``length`` positions; ``where`` may lie outside."""
    ok = (where >= 0) & (where < length)
    sums = np.zeros(length + 1)
    np.cumsum(np.bincount(where[ok], weight[ok], length), out=sums[1:])
    return sums[size:] - sums[:-size]


def _held_by(items: Items, at: np.ndarray, item: int) -> np.ndarray:
    """Which of the shingles (by their place, -1 if no item has it) the item has."""
    own = items.own[items.own_first[item]:items.own_first[item + 1]]
    k = np.searchsorted(own, at)
    k[k == len(own)] = 0
    return own[k] == at


def _scan(column: pa.Array, items: Items, bitmap: np.ndarray) -> Iterator[list[tuple]]:
    for _, texts in chunks(column):
        hashes, bounds = word_hashes([t.translate(_WORDS) for t in texts])
        for i in range(len(texts)):
            yield matches(items, hashes[bounds[i]:bounds[i + 1]], bitmap)


def _bitmap(items: Items) -> np.ndarray:
    bits = np.zeros(1 << 20, bool)
    bits[(items.shingles >> np.uint64(44)).astype(np.int64)] = True
    return bits


def item_blocks(benchmark: DataFrame, size: int = ITEM_BLOCK) -> Iterator[Items]:
    """The benchmark in blocks of ``size`` items, each gathered on the driver in turn."""
    rows = benchmark.filter("text IS NOT NULL").select("item_id", F.lower("text").alias("text")).orderBy("item_id").toLocalIterator()
    ids, texts = [], []
    for r in rows:
        ids.append(r["item_id"])
        texts.append(r["text"].encode())
        if len(ids) == size:
            yield from filter(None, [build(ids, texts)])
            ids, texts = [], []
    if ids:
        yield from filter(None, [build(ids, texts)])


FOUND = "item_id long, first_word int, n_words int, hamming int, similarity double"


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text) → a row per document and item that it holds."""
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"doc_id {kind}, {FOUND}")
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, names = shared.value, "doc_id item_id first_word n_words hamming similarity".split()
            bits = _bitmap(items)
            for batch in batches:
                rows, found = [], []
                for k, hits in enumerate(_scan(batch.column(1), items, bits)):
                    rows += [k] * len(hits)
                    found += hits
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array([items.ids[h[0]] for h in found], pa.int64()),
                    pa.array([h[1] for h in found], pa.int32()),
                    pa.array([h[4] for h in found], pa.int32()),
                    pa.array([h[2] for h in found], pa.int32()),
                    pa.array([h[3] for h in found], pa.float64())], names=names)

        out = out.unionByName(docs.select("doc_id", F.lower("text")).mapInArrow(run, f"doc_id {kind}, {FOUND}"))
    return out


def _clean(shared):
    @F.arrow_udf("boolean")
    def clean(low: pa.Array) -> pa.Array:
        return pa.array([not hits for hits in _scan(low, shared.value, _bitmap(shared.value))], pa.bool_())
    return clean


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item. Only their lower-cased text goes to Python."""
    bounded_batches(spark)
    for items in item_blocks(benchmark):
        docs = docs.filter(_clean(spark.sparkContext.broadcast(items))(F.lower("text")))
    return docs


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(spark, docs, read_table(spark, sf_dir, "benchmark"))
