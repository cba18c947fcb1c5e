"""Toxicity by FTRL-proximal logistic regression over hashed words, bigrams and skip-grams.

Each coordinate has its own learning rate, and the L1 term keeps most weights at exactly zero,
so the model is a short list of (feature, weight) that every task gets by broadcast. It has at
most ``2**BITS`` entries whatever the corpus.

The classifier is fitted on a bounded sample: at most ``MAX_ROWS`` labelled documents, those
with the smallest hash of their id, each with its whole text, as far as their feature lists take
``MAX_FEATURE_BYTES``. Scoring covers whole texts of
all documents.

Defined results: a null or empty text has no feature and scores the bias alone; a document
with several labels is toxic if one of them says so; null labels are not learnt from; repeated
rows get equal scores; without any label every score is next to 0 (nothing was learnt); an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import chunks, cut, fold_of, mix, read_table, word_hashes

BITS = 20
MAX_ROWS = 8000
MAX_FEATURE_BYTES = 1 << 28      # of the fitted documents' feature lists, 4 bytes a feature
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 1.0
FOLDS = 5

_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_MULT = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Model:
    index: np.ndarray      # features with a weight, ascending
    weight: np.ndarray
    bias: float


def features(words: np.ndarray) -> np.ndarray:
    """Distinct hashed features of one text: words, adjacent pairs, and pairs one apart."""
    parts = [mix(words * _MULT[0])]
    for gap in (1, 2):
        if len(words) > gap:
            parts.append(mix(words[:-gap] * _MULT[gap] + words[gap:]))
    return np.unique(np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


def text_features(column: pa.Array) -> Iterator[np.ndarray]:
    for _, texts in chunks(column):
        hashes, bounds = word_hashes([t.translate(_WORDS) for t in texts])
        for i in range(len(texts)):
            yield features(hashes[bounds[i]:bounds[i + 1]])


def ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """The last coordinate is the bias, free of L1."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    l1 = np.full((1 << BITS) + 1, L1)
    l1[-1] = 0.0

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= l1[i], 0.0, w)

    for _ in range(epochs):
        for x, y in zip(rows, labels):
            i = np.append(x, 1 << BITS)
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    every = weights(np.arange((1 << BITS) + 1))
    index = np.flatnonzero(every[:-1])
    return Model(index, every[index], float(every[-1]))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs = [x.astype(np.uint32).tobytes() for x in text_features(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())],
                                         names=["spot", "toxic", "x"])


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.assign(raw=rows["x"].map(bytes)).sort_values(["spot", "toxic", "raw"])
    x = [np.frombuffer(b, np.uint32).astype(np.int64) for b in rows["raw"]]
    m = ftrl(x, rows["toxic"].to_numpy(np.float64))
    return pd.DataFrame({"i": np.append(m.index, -1), "w": np.append(m.weight, m.bias)})


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on the documents whose id is outside the held-out fold. One task trains: it holds at
    most ``max_rows`` feature lists and ``MAX_FEATURE_BYTES`` of them, in the order of the ids'
    hashes. Of several texts under one id the one with the smallest hash is learnt from."""
    wanted = (labels.filter((fold_of(F.col("doc_id"), FOLDS) != 0) & F.col("toxic").isNotNull())
                    .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
                    .withColumn("spot", F.xxhash64(F.lit("toxicity"), "doc_id"))
                    .orderBy("spot", "doc_id").limit(max_rows))
    sample = (docs.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "spot", "toxic")
                  .agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
                  .select("spot", "toxic", "text"))
    encoded = cut(docs.sparkSession, sample.mapInArrow(_encode, "spot long, toxic int, x binary"), "toxicity-sample")
    sizes = encoded.select("spot", "toxic", F.length("x").alias("size")).withColumn(
        "so_far", F.sum("size").over(Window.orderBy("spot", "toxic")))                 # max_rows rows
    held = sizes.filter(F.col("so_far") <= MAX_FEATURE_BYTES).select("spot", "toxic").distinct()
    table = (encoded.join(held, ["spot", "toxic"], "left_semi").withColumn("one", F.lit(0)).groupBy("one").applyInPandas(_train, "i long, w double")).toPandas()
    table = table.sort_values("i")
    bias = float(table.loc[table["i"] < 0, "w"].sum()) if len(table) else -np.inf
    table = table[table["i"] >= 0]
    return Model(table["i"].to_numpy(np.int64), table["w"].to_numpy(np.float64), bias)


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) → (doc_id, score)."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        dense = np.zeros(1 << BITS)
        dense[m.index] = m.weight
        for batch in batches:
            sums = np.array([dense[x].sum() + m.bias for x in text_features(batch.column(1))])
            out = 1.0 / (1.0 + np.exp(-np.clip(sums, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def op5_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = score(spark, docs, fit(docs, labels))
    return scored.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
