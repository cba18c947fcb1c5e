"""Language-model scoring with Katz backoff over bigrams.

Counts are exact over all training documents, discounted by Good-Turing up to a count of
``CUT``; each context's backoff weight makes its probabilities sum to exactly one over the
training vocabulary and one class for all other words.

Documents are encoded once into blocks of about ``BLOCK_BYTES`` of text: the block's distinct
words, and its tokens as positions in them. The n-gram tables are partitioned by hash range
("buckets" of a fixed size, so their number grows with the corpus). A block asks each bucket
for its own distinct n-grams and brings their counts in the block's training documents; the
bucket adds up all blocks and answers every block with the totals, in the order it asked. So a
frequent n-gram costs a bucket one entry per block, never one per occurrence, and no table has
to fit anywhere whole. Encoded blocks are stored bucketed by block, so they are never moved.

Passes: (1) words, (2) bigrams, (3) per context the discounted mass and the unigram mass of its
seen continuations, each distinct bigram being added by the one block that its bucket named;
(4) scores, token by token: a seen bigram's discounted probability, else its context's backoff
weight times the word's probability, which itself falls back to the class of unknown words.

Defined results: a null or empty text is just its end token; repeated rows count repeatedly;
a null id is a training row; counts too sparse for Good-Turing fall back to absolute
discounting of a half; with no training token at all, scores use a uniform unknown class; an
empty table gives no rows. Words and bigrams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import chunks, cut, mix, read_table, word_hashes
from pitwall.session import checkpoint_dir

FOLDS, HELD_FOLD = 7, 2
BLOCK_BYTES = 6 << 20
BUCKET_TOKENS = 1_500_000
CUT = 5                    # Good-Turing discounts counts up to here
TAIL = 0.05                # what larger counts lose, so that every context keeps some mass
END = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xD6E8FEB86659FD93)


# --- compact arrays ---------------------------------------------------------------------

def pack(a: np.ndarray) -> bytes:
    """Lossless: bytes of equal significance together, then deflated."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T
    return a.dtype.str.encode().ljust(4) + zlib.compress(planes.tobytes(), 1)


def unpack(b: bytes) -> np.ndarray:
    dtype = np.dtype(b[:4].decode().strip())
    raw = np.frombuffer(zlib.decompress(b[4:]), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending uint64, as differences."""
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


# --- encoding ---------------------------------------------------------------------------

BLOCK = ("block long, n_docs int, ids binary, id_known binary, held binary, lengths binary, words binary, "
         "codes binary, train_tokens long, tokens long")


def encode(docs: DataFrame) -> DataFrame:
    """(doc_id long, held boolean, text) → blocks. A text's tokens are its words and one end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, hashes, size = [], [], [], 0

        def block():
            lengths = np.array([len(h) for h in hashes], np.int32)
            words, codes = np.unique(np.concatenate(hashes), return_inverse=True)
            in_train = ~np.array(held, bool)
            known = np.array([i is not None for i in ids], bool)
            row = [uuid.uuid4().int >> 65, len(ids), pack(np.array([i or 0 for i in ids], np.int64)),
                   np.packbits(known).tobytes(), np.packbits(~in_train).tobytes(), pack(lengths),
                   pack_sorted(words), pack(codes.astype(np.uint32)),
                   int(lengths[in_train].sum()), int(lengths.sum())]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row[:1]] + [
                pa.array([row[1]], pa.int32()), *[pa.array([x], pa.binary()) for x in row[2:8]],
                *[pa.array([x], pa.int64()) for x in row[8:]]], names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            batch_ids, batch_held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, texts in chunks(batch.column(2)):
                h, bounds = word_hashes(texts)
                for i in range(len(texts)):
                    ids.append(batch_ids[first + i])
                    held.append(batch_held[first + i])
                    hashes.append(np.append(h[bounds[i]:bounds[i + 1]], END))
                    size += len(texts[i])
                if size >= BLOCK_BYTES:
                    yield block()
                    ids, held, hashes, size = [], [], [], 0
        if ids:
            yield block()

    return docs.mapInArrow(run, BLOCK)


class Block:
    """A decoded block: tokens with their words, previous words and bigrams."""

    def __init__(self, row: dict):
        n = row["n_docs"]
        self.id = row["block"]
        self.ids = unpack(row["ids"])
        self.known = np.unpackbits(np.frombuffer(row["id_known"], np.uint8))[:n].astype(bool)
        self.held = np.unpackbits(np.frombuffer(row["held"], np.uint8))[:n].astype(bool)
        self.lengths = unpack(row["lengths"]).astype(np.int64)
        self.words = unpack_sorted(row["words"])
        self.codes = unpack(row["codes"]).astype(np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(~self.held, self.lengths)

    def previous(self) -> np.ndarray:
        """Code of the word before each token; the end token stands before a text."""
        before = np.empty_like(self.codes)
        before[1:] = self.codes[:-1]
        before[self.first] = np.searchsorted(self.words, END)
        return before

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(distinct bigram hashes ascending, bigram of each token, context and word code of
        each distinct bigram)."""
        before = self.previous()
        key = mix(self.words[before] * _PAIR + self.words[self.codes])
        grams, at, of = np.unique(key, return_index=True, return_inverse=True)
        return grams, of, before[at], self.codes[at]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


# --- asking the buckets -----------------------------------------------------------------

def _ends(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the buckets' hash ranges in ascending keys."""
    limits = [min((b << 64) // buckets, 2**64 - 1) for b in range(1, buckets)]
    cuts = np.searchsorted(keys, np.array(limits, np.uint64)) if limits else np.empty(0, np.int64)
    return np.concatenate([[0], cuts, [len(keys)]])


def _asked(block: int, keys: np.ndarray, buckets: int, **columns: np.ndarray) -> pa.RecordBatch:
    ends = _ends(keys, buckets)
    rows = [b for b in range(buckets) if ends[b] < ends[b + 1]]
    out = {"bucket": pa.array(rows, pa.int32()), "block": pa.array([block] * len(rows), pa.int64()),
           "keys": pa.array([pack_sorted(keys[ends[b]:ends[b + 1]]) for b in rows], pa.binary())}
    for name, values in columns.items():
        out[name] = pa.array([pack(values[ends[b]:ends[b + 1]]) for b in rows], pa.binary())
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _count_words(buckets: int):
    def run(batches):
        for row in _blocks(batches):
            b = Block(row)
            yield _asked(b.id, b.words, buckets,
                         counts=np.bincount(b.codes[b.train], minlength=len(b.words)).astype(np.uint32))
    return run


def _count_bigrams(buckets: int):
    def run(batches):
        for row in _blocks(batches):
            b = Block(row)
            grams, of, _, _ = b.bigrams()
            yield _asked(b.id, grams, buckets,
                         counts=np.bincount(of[b.train], minlength=len(grams)).astype(np.uint32))
    return run


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: totals for every block, whether the block is the first of the key (it adds
    the key to its context), and how many keys have each count."""
    keys = [unpack_sorted(x) for x in rows["keys"]]
    counts = [unpack(x) for x in rows["counts"]]
    distinct, first, of = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(of, np.concatenate(counts), len(distinct)).astype(np.uint64)
    owner = np.zeros(len(of), bool)
    owner[first] = True
    seen = total[total > 0]
    of_counts = np.bincount(np.minimum(seen, CUT + 2).astype(np.int64), minlength=CUT + 3)
    ends = np.cumsum([len(k) for k in keys])
    out, a = [], 0
    dtype = np.uint32 if not len(total) or total.max() < 2**32 else np.uint64
    for i, (block, e) in enumerate(zip(rows["block"], ends)):
        out.append((rows["bucket"].iloc[0], block, pack(total[of[a:e]].astype(dtype)),
                    np.packbits(owner[a:e]).tobytes(), of_counts.tolist() if i == 0 else None,
                    int(seen.sum()) if i == 0 else 0))
        a = e
    return pd.DataFrame(out, columns=["bucket", "block", "totals", "owner", "of_counts", "tokens"])


ANSWER = "bucket int, block long, totals binary, owner binary, of_counts array<long>, tokens long"


def _answers(spark: SparkSession, codes: DataFrame, ask, name: str) -> tuple[DataFrame, list[int], int]:
    """(answers, number of keys by count, training tokens)."""
    asked = codes.mapInArrow(ask, "bucket int, block long, keys binary, counts binary")
    got = cut(spark, asked.groupBy("bucket").applyInPandas(_add_up, ANSWER), name)
    kinds = [F.sum(F.get("of_counts", F.lit(i))).alias(f"n{i}") for i in range(CUT + 3)]
    sums = got.agg(F.sum("tokens").alias("tokens"), *kinds).first()
    return got, [sums[f"n{i}"] or 0 for i in range(CUT + 3)], sums["tokens"] or 0


def _by_block(got: DataFrame, *columns: str) -> DataFrame:
    """A row per block with its answers in order of the buckets."""
    return got.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", *columns))).alias("parts"))


def discounts(of_counts: list[int]) -> np.ndarray:
    """Discounted count of r = 0..CUT + 1 (the last stands for all larger counts and holds what
    is taken off): Katz's Good-Turing estimate."""
    n = of_counts
    star = np.array([0.0] + [r - 0.5 for r in range(1, CUT + 1)] + [TAIL])
    if all(n[r] > 0 for r in range(1, CUT + 2)):
        common = (CUT + 1) * n[CUT + 1] / n[1]
        if common < 1:
            good = [((r + 1) * n[r + 1] / n[r] - r * common) / (1 - common) for r in range(1, CUT + 1)]
            if all(0 < g < r for r, g in enumerate(good, 1)):
                star[1:CUT + 1] = good
    return star


def discounted(counts: np.ndarray, star: np.ndarray) -> np.ndarray:
    c = counts.astype(np.float64)
    return np.where(counts <= CUT, star[np.minimum(counts, CUT).astype(np.int64)], c - star[CUT + 1])


# --- the model --------------------------------------------------------------------------

def _joined(parts, name: str) -> np.ndarray:
    return np.concatenate([unpack(p[name]) for p in parts])


def _flags(parts, sizes) -> np.ndarray:
    return np.concatenate([np.unpackbits(np.frombuffer(p["owner"], np.uint8))[:n] for p, n in zip(parts, sizes)]).astype(bool)


def _unigrams(counts: np.ndarray, star: np.ndarray, n: int) -> np.ndarray:
    """Probability of each word; nothing for unknown ones."""
    return np.where(counts > 0, discounted(counts, star) / max(n, 1), 0.0)


def _context_sums(buckets: int, star1: np.ndarray, star2: np.ndarray, n: int):
    """Per context word of a block: the discounted counts and the unigram mass of the seen
    bigrams that the block adds; ``ask`` marks contexts whose weight the block needs."""
    def run(batches):
        for row in _blocks(batches):
            b = Block(row)
            grams, _, context, word = b.bigrams()
            unigram = _unigrams(_joined(row["words1"], "totals"), star1, n)
            parts = [unpack(p["totals"]) for p in row["words2"]]
            counts = np.concatenate(parts)
            mine = _flags(row["words2"], [len(p) for p in parts]) & (counts > 0)
            size = len(b.words)
            mass = np.bincount(context[mine], discounted(counts[mine], star2), size)
            lower = np.bincount(context[mine], unigram[word[mine]], size)
            ask = np.zeros(size, np.uint8)
            ask[context[counts == 0]] = 1
            use = np.flatnonzero((mass > 0) | (ask > 0))
            yield _asked(b.id, b.words[use], buckets, mass=mass[use], lower=lower[use], ask=ask[use])
    return run


def _weigh(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket of contexts: (mass, lower) in all, for the blocks that asked."""
    keys = [unpack_sorted(x) for x in rows["keys"]]
    distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
    mass = np.bincount(of, np.concatenate([unpack(x) for x in rows["mass"]]), len(distinct))
    lower = np.bincount(of, np.concatenate([unpack(x) for x in rows["lower"]]), len(distinct))
    out, a = [], 0
    for block, k, ask in zip(rows["block"], keys, rows["ask"]):
        at = of[a:a + len(k)]
        wanted = unpack(ask).astype(bool)
        if wanted.any():
            out.append((rows["bucket"].iloc[0], block, pack(mass[at[wanted]]), pack(lower[at[wanted]])))
        a += len(k)
    return pd.DataFrame(out, columns=["bucket", "block", "mass", "lower"])


def _score(star1: np.ndarray, star2: np.ndarray, n: int, vocabulary: int, unknown: float):
    def run(batches):
        for row in _blocks(batches):
            b = Block(row)
            grams, of, context, word = b.bigrams()
            c1 = _joined(row["words1"], "totals")
            p1 = np.where(c1 > 0, _unigrams(c1, star1, n), unknown)
            c2 = _joined(row["words2"], "totals")
            mass, lower, asked = np.zeros(len(b.words)), np.zeros(len(b.words)), np.zeros(len(b.words), bool)
            asked[context[c2 == 0]] = True
            if row["contexts"]:
                at = np.flatnonzero(asked)
                mass[at], lower[at] = _joined(row["contexts"], "mass"), _joined(row["contexts"], "lower")
            total = np.maximum(c1, 1).astype(np.float64)
            weight = np.where(c1 > 0, (1 - mass / total) / np.maximum(1 - lower, 1e-300), 1.0)
            p2 = np.where(c2 > 0, discounted(c2, star2) / total[context], weight[context] * p1[word])
            log = np.log10(p2)[of]
            base = np.log10((c1 + 1.0) / (n + vocabulary + 1.0))[b.codes]
            known = (c1 > 0)[b.codes]
            add = lambda x: np.add.reduceat(x, b.first)
            ids = pa.array(b.ids, mask=~b.known)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(b.held), pa.array(b.lengths), pa.array(add(known.astype(np.int64))),
                 pa.array(np.full(len(b.ids), n, np.int64)), pa.array(add(base)), pa.array(add(log))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(spark: SparkSession, docs: DataFrame, held: Column) -> DataFrame:
    """(doc_id, text) → doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score;
    the model learns from rows that are not ``held``."""
    blocks = encode(docs.select(F.col("doc_id").cast("long"), held.alias("held"), "text"))
    # stored bucketed by block: joins with answers move the answers only
    name = f"katz_blocks_{uuid.uuid4().hex}"
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (blocks.write.bucketBy(width, "block").option("path", f"{checkpoint_dir(spark).rstrip('/')}/pitwall-llm/{name}")
           .saveAsTable(name))
    codes = spark.table(name)
    sizes = codes.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(1, -(-sizes // BUCKET_TOKENS))
    got1, of1, n = _answers(spark, codes, _count_words(buckets), "katz-words")
    got2, of2, _ = _answers(spark, codes, _count_bigrams(buckets), "katz-bigrams")
    star1, star2 = discounts(of1), discounts(of2)
    vocabulary = sum(of1[1:])
    larger = of1[CUT + 2] + of1[CUT + 1]
    taken_off = (sum((r - star1[r]) * of1[r] for r in range(1, CUT + 1)) + TAIL * larger)
    unknown = taken_off / n if n else 1.0
    full = (codes.join(_by_block(got1, "totals").withColumnRenamed("parts", "words1"), "block")
                 .join(_by_block(got2, "totals", "owner").withColumnRenamed("parts", "words2"), "block"))
    sums = full.mapInArrow(_context_sums(buckets, star1, star2, n),
                           "bucket int, block long, keys binary, mass binary, lower binary, ask binary")
    weights = cut(spark, sums.groupBy("bucket").applyInPandas(_weigh, "bucket int, block long, mass binary, lower binary"),
                  "katz-weights")
    ready = full.join(_by_block(weights, "mass", "lower").withColumnRenamed("parts", "contexts"), "block", "left")
    return ready.mapInArrow(_score(star1, star2, n, vocabulary, unknown),
                            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                            "base_score double, score double")


def op6_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(0))
    return score(spark, docs, remainder == HELD_FOLD)
