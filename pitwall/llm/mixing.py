"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is ``-ln(u) / weight``: ``u`` in (0, 1) comes from a hash of its id and text,
the weight from its quality, so ascending keys are a weighted sample without replacement.
Each source has a budget of words. Complete epochs of the source come first; what remains of
the budget is filled in key order up to the prefix sum that reaches it.

No source is ever sorted as a whole. Keys map monotonically onto 65,536 bins; word counts per
bin, pre-aggregated, give the bin in which the prefix sum crosses the budget. Bins before it
are taken, bins after it are not, and only the documents of that one bin are sorted.

Defined results: a null or wordless text has size 0 and gives 0 words; a null source is a
source of its own, last in order; repeated rows are separate documents; ties in the key are
ordered by id, checksum and size; an empty table gives no rows. The table of sources has a
row per mixture component (a configured list, small by definition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import WORD, cut, own_names, read_table

WEIGHTS = (3, 1, 2)
SHARE = 1.5            # of all words
MAX_EPOCHS = 2
SEED = "mix-1"
BINS, COARSE = 65536, 256


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for plain prose, less for texts with many digits and symbols, at least 0.1."""
    odd = F.length(F.regexp_replace(text, r"[^0-9#*$%&|<>{}=_]+", ""))
    share = odd / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.1), F.coalesce(1.0 - 4.0 * share, F.lit(0.1)))


def sample_key(doc_id: Column, text: Column, weight: Column, seed: str = SEED) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string"), F.md5(text)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(2**52)
    return -F.log(u) / weight


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) → with ``target``: shares of the total by weight, none above
    ``max_epochs`` times its source; what is cut off is shared again by weight. The common
    factor λ solves Σ min(cap, λ·weight) = total: sources are ordered by cap / weight, and λ
    is taken at the first that λ does not fill."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    every = Window.partitionBy()
    t = (sizes.withColumn("weight", weight)
              .withColumn("cap", F.col("source_size").cast("double") * max_epochs)
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * share
    t = t.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
    open_ = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))
    level = F.min(open_).over(every)["level"]
    return t.select("source", "source_size",
                    F.least(F.col("cap"), level * F.col("weight")).alias("target"))


def _crossing(bins: DataFrame, bin_col: str, budget: str, out: str) -> DataFrame:
    """Per source the first bin whose prefix sum exceeds the budget, and what the bins before
    it leave of the budget. ``bins`` has at most ``COARSE`` rows per source."""
    w = Window.partitionBy("source").orderBy(bin_col).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(w), F.lit(0))
    left = F.col(budget) - before
    return (bins.withColumn("left", left)
                .filter((F.col("left") >= 0) & (F.col("left") < F.col("words")))
                .select("source", F.col(bin_col).alias(out), F.col("left").alias(f"{out}_left")))


def mix(spark: SparkSession, docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, whole: bool = False, keep: bool = False) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, epochs (complete ones), taken
    (words the mix takes, repeats counted).

    The document in which the budget ends gives only the words that remain; with ``whole`` it
    is taken whole or not at all, whichever ends nearer to the target. ``keep`` returns the
    input's columns with ``p + "taken"`` and ``p + "size"`` (``p`` from ``own_names``).
    """
    p = own_names(docs)
    text = F.col("text")
    measured = docs.select(
        *(docs.columns if keep else ["doc_id", "source"]),
        n_words(text).alias(f"{p}size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias(f"{p}crc"),
        sample_key(F.col("doc_id"), text, quality_weight(text)).alias(f"{p}key"))
    position = F.col(f"{p}key") / (1.0 + F.col(f"{p}key"))      # monotone, in [0, 1)
    measured = measured.withColumn(
        f"{p}bin", F.least(F.floor(position * BINS), F.lit(BINS - 1)).cast("int"))
    measured = cut(spark, measured, "mix-documents")

    coarse = measured.groupBy("source", F.shiftright(f"{p}bin", 8).alias("b1")).agg(
        F.sum(f"{p}size").alias("words"))
    coarse = cut(spark, coarse, "mix-coarse")
    aims = targets(coarse.groupBy("source").agg(F.sum("words").alias("source_size")),
                   weights, share, max_epochs)
    size = F.greatest(F.col("source_size"), F.lit(1))
    aims = (aims.withColumn("epochs", F.floor(F.col("target") / size))
                .withColumn("budget", F.round("target").cast("long")
                            - F.col("epochs") * F.col("source_size"))
                .withColumnRenamed("source", "key_source"))
    same = F.col("source").eqNullSafe(F.col("key_source"))
    aims = cut(spark, aims, "mix-targets")
    c1 = _crossing(coarse.join(aims.select("key_source", "budget"), same).drop("key_source"),
                   "b1", "budget", "b1_end").withColumnRenamed("source", "c_source")
    aims = aims.join(c1, F.col("key_source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
    plain = measured.select("source", f"{p}bin", f"{p}size")
    fine = (plain.join(aims.select("key_source", "b1_end", "b1_end_left"),
                          same & (F.shiftright(f"{p}bin", 8) == F.col("b1_end")))
                    .groupBy("source", f"{p}bin").agg(F.sum(f"{p}size").alias("words"),
                                                      F.max("b1_end_left").alias("budget")))
    c2 = _crossing(fine, f"{p}bin", "budget", "bin_end").withColumnRenamed("source", "c_source")
    aims = aims.join(c2, F.col("key_source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
    aims = cut(spark, aims, "mix-ends").withColumnsRenamed(
        {c: f"{p}{c}" for c in ("key_source", "source_size", "target", "epochs", "budget",
                                "b1_end", "b1_end_left", "bin_end", "bin_end_left")})

    j = measured.join(aims, F.col("source").eqNullSafe(F.col(f"{p}key_source")))
    end, bin_ = F.col(f"{p}bin_end"), F.col(f"{p}bin")
    # without an end the budget is a whole number of epochs, or beyond all documents
    no_end = F.when(F.col(f"{p}budget") > 0, F.col(f"{p}size")).otherwise(0)
    sure = (F.when(end.isNull(), no_end).when(bin_ < end, F.col(f"{p}size")).otherwise(0))
    last = j.filter(end.isNotNull() & (bin_ == end))
    w = Window.partitionBy("source").orderBy(f"{p}key", F.col("doc_id").asc_nulls_last(), f"{p}crc", f"{p}size")
    before = F.coalesce(F.sum(f"{p}size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.greatest(F.col(f"{p}bin_end_left") - before, F.lit(0))
    part = F.least(F.col(f"{p}size"), left)
    if whole:
        part = F.when(2 * part >= F.col(f"{p}size"), F.col(f"{p}size")).otherwise(0)
    out = (j.filter(end.isNull() | (bin_ != end)).withColumn(f"{p}part", sure)
            .unionByName(last.withColumn(f"{p}part", part)))
    out = out.withColumn(f"{p}taken", (F.col(f"{p}epochs") * F.col(f"{p}size") + F.col(f"{p}part")).cast("long"))
    if keep:
        return out.select(*docs.columns, f"{p}size", f"{p}taken")
    return out.select("doc_id", "source", F.col(f"{p}size").alias("size"),
                      F.col(f"{p}source_size").alias("source_size"),
                      F.col(f"{p}target").alias("target"),
                      F.col(f"{p}epochs").alias("epochs"), F.col(f"{p}taken").alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: each document as often as the mix takes it, whole."""
    p = own_names(docs)
    m = mix(spark, docs, whole=True, keep=True, **options)
    times = F.when(F.col(f"{p}size") > 0, (F.col(f"{p}taken") / F.col(f"{p}size")).cast("int")).otherwise(0)
    copies = m.withColumn(f"{p}copy", F.explode(F.array_repeat(F.lit(1), times)))
    return copies.select(*docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(spark, docs)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text,
         CASE WHEN text IS NULL THEN 0
              ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         greatest(0.1, coalesce(1.0::DOUBLE - 4.0::DOUBLE * (length(regexp_replace(text,
           '[^0-9#*$%&|<>{}=_]+', '', 'g'))::DOUBLE / greatest(length(text), 1)), 0.1)) AS weight,
         md5(concat_ws(':', 'mix-1', doc_id::VARCHAR, md5(text))) AS digest
  FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(digest, 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE) / weight AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS w
  FROM k GROUP BY source),
levels AS (
  SELECT a.source, a.w, a.source_size, 2.0 * a.source_size AS cap,
         ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE
          - coalesce((SELECT sum(2.0 * b.source_size) FROM s b
                      WHERE 2.0 * b.source_size / b.w < 2.0 * a.source_size / a.w), 0)::DOUBLE)
         / (SELECT sum(b.w) FROM s b
            WHERE 2.0 * b.source_size / b.w >= 2.0 * a.source_size / a.w)::DOUBLE AS lv
  FROM s a),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, w * (SELECT arg_min(lv, cap / w) FROM levels WHERE lv <= cap / w)) AS target
  FROM levels),
p AS (
  SELECT k.doc_id, k.source, k.size::BIGINT AS size, t.source_size, t.target,
         floor(t.target / greatest(t.source_size, 1))::BIGINT AS epochs,
         round(t.target)::BIGINT AS goal,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target, epochs,
       (epochs * size + least(size, greatest(goal - epochs * source_size - before, 0)))::BIGINT AS taken
FROM p
"""
