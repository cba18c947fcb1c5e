"""Language identification with a bit-sliced Bloom filter of byte n-grams.

One filter serves all languages: slot ``s`` holds a bitmask whose bit ``l`` says that some
n-gram of language ``l`` hashes to ``s``. The AND of an n-gram's slots is the set of all
languages that (may) contain it. Per document and language the set bits are counted, the
hits expected from false positives are taken off, and the language with most hits wins.

Fitting uses a bounded sample: about ``MAX_DOCS`` labelled documents per language, picked by
a hash of their id. The filter has ``2**SLOT_BITS`` slots whatever the corpus, so collecting
and broadcasting it is bounded. Prediction reads whole texts and nothing but the text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; a text whose
n-grams are all unknown gets the most frequent language with score 0; ties go to the first
language in order; rows with a null language are not learnt from, and a null id counts as held
out; repeated rows get equal results; without any labelled row all are ``und``; an empty
table gives no rows. At most 64 languages (the most frequent) are learnt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import bounded_batches, chunks, fold_of, give_back, mix, own_names, read_table

MAX_DOCS = 1500            # labelled documents per language, about
MAX_LANGS = 64
SLOT_BITS = 20
MIN_COUNT = 2              # times an n-gram is seen in a language
RIVAL = 0.1                # a language holds an n-gram if its rate is this share of the best
HASHES = 2
FOLDS = 5

_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass(frozen=True)
class Filter:
    langs: tuple[str, ...]
    masks: np.ndarray          # languages per slot, as bits
    false_rate: np.ndarray     # per language: chance that an absent n-gram seems present
    usual: int = 0             # the most frequent language, for texts without a known n-gram


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(4-byte windows whose second byte belongs to a word, their positions, text offsets).
    Three blanks between texts keep windows within one text."""
    parts = [t.translate(_LETTERS) for t in texts]
    buf = np.frombuffer(b"   " + b"   ".join(parts) + b"   ", np.uint8)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 3 for t in parts], out=offsets[1:])
    at = np.flatnonzero(buf[1:-2] != 32)
    b = buf.astype(np.uint32)
    grams = (b[:-3] | (b[1:-2] << 8) | (b[2:-1] << 16) | (b[3:] << 24))[at]
    return grams, at, offsets


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    h = mix(grams.astype(np.uint64) + np.uint64(1))
    return [((h >> np.uint64(k * 24)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)
            for k in range(HASHES)]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in sorted(set(langs)):
            rows = batch.column(1).filter(pa.array(langs == lang))
            found, counts = np.empty(0, np.uint32), np.empty(0, np.int64)
            for _, texts in chunks(rows):
                g, n = np.unique(_grams(texts)[0], return_counts=True)
                both = np.concatenate([found, g])
                weight = np.concatenate([counts, n])
                found, inverse = np.unique(both, return_inverse=True)
                counts = np.bincount(inverse, weight, len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found)), pa.array(found.astype(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"])


def fit(labelled: DataFrame, max_docs: int = MAX_DOCS) -> Filter:
    """``labelled`` has lang and text and doc_id. Counts per language choose the sample rate."""
    totals = labelled.filter("lang IS NOT NULL").groupBy("lang").count()
    totals = totals.orderBy(F.desc("count"), "lang").limit(MAX_LANGS)
    spark = labelled.sparkSession
    known = sorted((r["lang"], r["count"]) for r in totals.collect())
    langs = tuple(x for x, _ in known)
    slots = np.zeros(1 << SLOT_BITS, np.uint64)
    if not langs:
        return Filter((), slots, np.zeros(0))
    rates = spark.createDataFrame([(x, i, min(1.0, max_docs / n)) for i, (x, n) in enumerate(known)],
                                  "lang string, bit int, rate double")
    spot = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = (labelled.join(F.broadcast(rates.select("lang", "rate")), "lang").filter(spot < F.col("rate"))
                      .select("lang", F.lower("text").alias("text")))
    counts = (sample.mapInArrow(give_back(_count_grams), "lang string, gram long, n long")
                    .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    by_gram = (counts.filter(F.col("n") >= MIN_COUNT).join(F.broadcast(sums), "lang")
                     .join(F.broadcast(rates.select("lang", "bit")), "lang")
                     .withColumn("rate", F.col("n") / F.col("total"))
                     .groupBy("gram").agg(F.collect_list(F.struct("bit", "rate")).alias("held"),
                                          F.max("rate").alias("best")))
    kept = F.filter("held", lambda x: x["rate"] >= F.col("best") * RIVAL)
    held = F.aggregate(kept, F.lit(0).cast("long"),
                       lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["bit"])))
    masks = by_gram.select("gram", held.alias("mask"))

    def set_bits(batches):
        for batch in batches:
            grams = batch.column(0).to_numpy().astype(np.uint32)
            mask = batch.column(1)
            for s in _slots(grams):
                yield pa.RecordBatch.from_arrays([pa.array(s), mask], names=["slot", "mask"])

    table = (masks.mapInArrow(set_bits, "slot long, mask long")
                  .groupBy("slot").agg(F.bit_or("mask").alias("mask"))).toPandas()
    slots[table["slot"].to_numpy()] = table["mask"].to_numpy().astype(np.uint64)
    fill = np.array([((slots >> np.uint64(i)) & np.uint64(1)).mean() for i in range(len(langs))])
    dtype = np.uint8 if len(langs) <= 8 else np.uint64
    usual = max(range(len(known)), key=lambda i: (known[i][1], -i))
    return Filter(langs, slots.astype(dtype), np.minimum(fill ** HASHES, 0.999), usual)


def hits(f: Filter, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(corrected hits per text and language, n-grams per text)."""
    grams, at, offsets = _grams(texts)
    ends = np.searchsorted(at, offsets)
    mask = None
    for s in _slots(grams):
        mask = f.masks[s] if mask is None else mask & f.masks[s]
    total = np.diff(ends)
    out = np.zeros((len(texts), len(f.langs)))
    for i in range(len(f.langs)):
        bits = np.zeros(len(grams) + 1, np.int64)
        np.cumsum((mask >> mask.dtype.type(i)) & mask.dtype.type(1), out=bits[1:])
        seen = bits[ends[1:]] - bits[ends[:-1]]
        out[:, i] = (seen - total * f.false_rate[i]) / (1 - f.false_rate[i])
    return np.maximum(out, 0), total


def identify(spark: SparkSession, docs: DataFrame, f: Filter) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (share of the text's n-grams that the chosen
    language holds) under the names ``p + "lang"`` and ``p + "score"``, ``p`` from own_names.
    Only the lower-cased text goes to Python, and two short columns come back."""
    bounded_batches(spark)
    p = own_names(docs)
    shared = spark.sparkContext.broadcast(f)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    @F.arrow_udf("lang string, score double")
    def found(low: pa.Array) -> pa.Array:
        f = shared.value
        langs, scores = ["und"] * len(low), np.zeros(len(low))
        for first, texts in chunks(low) if f.langs else ():
            got, total = hits(f, texts)
            best = np.where(got.max(1) > 0, got.argmax(1), f.usual)
            for i in range(len(texts)):
                if low[first + i].is_valid:
                    langs[first + i] = f.langs[best[i]]
                    scores[first + i] = min(1.0, got[i, best[i]] / max(total[i], 1))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], names=["lang", "score"])

    both = docs.withColumn(f"{p}both", found(F.when(letters, F.lower("text"))))
    return both.select(*docs.columns, F.col(f"{p}both.lang").alias(f"{p}lang"), F.col(f"{p}both.score").alias(f"{p}score"))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(fold_of(F.col("doc_id"), FOLDS) != 0).select("doc_id", "lang", "text")


MIN_SCORE = 0.2


def keep_known(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents in a language the filter knows: rejected are ``und`` and texts of whose
    n-grams less than ``MIN_SCORE`` belong to the chosen language."""
    p = own_names(docs)
    found = identify(spark, docs, fit(training_rows(docs)))
    return found.filter((F.col(f"{p}lang") != "und") & (F.col(f"{p}score") >= MIN_SCORE)).select(*docs.columns)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    f = fit(training_rows(docs))
    found = identify(spark, docs.select("doc_id", "text"), f)
    return found.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
                        F.col("_wlang").alias("lang_pred"), F.col("_wscore").alias("score"))
