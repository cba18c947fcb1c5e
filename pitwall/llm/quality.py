"""Quality rules by distribution divergence, with DataFrame functions only.

Each text has two histograms: character classes (upper- and lower-case letters, digits,
sentence marks, symbols, blanks and the rest) and the common words of its language (the most
frequent words, each with its share, and all others together). Both are compared with the
language's reference, learnt from all documents, by the Jensen-Shannon distance (base 2,
0 to 1). Short texts have noisy histograms, so below a minimum of words only the base rules
hold, and the word histogram is judged only from a higher minimum on.

References: per language (the ``MAX_LANGS`` most frequent), and pooled over all documents for
a null or rarer language. Their size is fixed: ``MAX_LANGS`` x ``COMMON`` words.

Defined results: a null or wordless text has counts 0, ``base_failed`` and is not kept;
repeated rows get equal results; a tie in word counts is ordered by the word; an empty table
gives no rows. Windows of five words are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import SPACE, WORD, cut, read_table

COMMON = 20                # common words per language
MAX_LANGS = 64
MIN_WORDS_CLASS = 20       # below: character classes are not judged
MIN_WORDS_COMMON = 100     # below: common words are not judged
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45
WINDOW = 5
POOLED = "*"

BLANK = "blank"
CLASSES = {                # disjoint runs, the usual ones first: each is taken out of what the others left
    "lower": r"\p{Ll}+",
    BLANK: SPACE,
    "mark": r"""[.,;:!?'"()-]+""",
    "upper": r"\p{Lu}+",
    "digit": r"[0-9]+",
    "symbol": r"[#*$%&|<>]+",
}


def class_counts(d: DataFrame, text: str) -> DataFrame:
    """Characters of ``text`` per class, and ``rest`` for all others. After the first passes little
    of the text is left to search."""
    left = text
    for i, (name, pattern) in enumerate(CLASSES.items()):
        after = f"left{i}"
        d = d.withColumn(after, F.regexp_replace(left, pattern, ""))
        d = d.withColumn(name, (F.length(left) - F.length(after)).cast("long"))
        left = after
    return d.withColumn("rest", F.length(left).cast("long"))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _covered(starts: Column) -> Column:
    """Words covered by windows starting at the (ascending) positions."""
    steps = F.transform(starts, lambda x, i: F.least(
        F.coalesce(F.get(starts, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, hashes of the words, class counts and the base rule's figures."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = class_counts(docs.select("doc_id", "lang", text.alias("text")), "text")
    d = d.withColumn("hash", F.transform(words_of(F.col("text")), lambda x: F.xxhash64(x)))
    d = d.withColumn("n_words", F.size("hash").cast("long"))
    h = F.col("hash")
    d = d.withColumn("windows", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.slice(h, F.lit(1), F.greatest(F.col("n_words").cast("int") - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn("sorted", F.when(again, F.sort_array(
        F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    s = F.col("sorted")
    d = d.withColumn("found", F.sort_array(F.transform(
        F.filter(s, lambda x, i: (x["x"] == F.when(i > 0, F.get(s, i - 1)["x"])).eqNullSafe(True)
                 | (x["x"] == F.get(s, i + 1)["x"]).eqNullSafe(True)), lambda x: x["i"])))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    d = d.withColumn("lines", lines)
    return d.select(
        "doc_id", "lang", "hash", "n_words", (F.length("text") - F.col(BLANK)).cast("long").alias("word_chars"),
        *CLASSES, "rest",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("found")), F.lit(0)).cast("long").alias("n_repeat_words"))


def common_words(docs: DataFrame) -> DataFrame:
    """(lang, common: array<struct<word, share>>) over all documents, and ``POOLED``."""
    words = docs.select("lang", F.explode(words_of(F.col("text"))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = cut(docs.sparkSession, counts, "quality-words")
    pooled = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(POOLED).alias("lang"), "word", "n")
    every = counts.filter("lang IS NOT NULL").unionByName(pooled)
    sums = every.groupBy("lang").agg(F.sum("n").alias("total"))
    sums = (sums.filter(F.col("lang") != POOLED).orderBy(F.desc("total"), "lang").limit(MAX_LANGS)
                .unionByName(sums.filter(F.col("lang") == POOLED)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = every.withColumn("rank", rank).filter(F.col("rank") <= COMMON)
    top = top.join(F.broadcast(sums), "lang")
    return top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct(
        "word", (F.col("n") / F.col("total")).alias("share")))).alias("common"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two equally long arrays of shares. ``p`` and ``q`` are
    referenced once, so that they are computed once."""
    def part(a, m):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x,
                       lambda s: F.round(F.sqrt(F.greatest(s / 2, F.lit(0.0))), 6))


FIGURES = ("upper", "lower", "digit", "mark", "symbol", BLANK, "rest")


def times_of(hashes: str, word: Column) -> Column:
    """How often a word's hash is among the hashes; null for a null word."""
    return (F.size(hashes) - F.size(F.array_remove(hashes, word))).cast("long")


def judge(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, lang, text) → the base figures, base_failed, kept, js_class, js_words (null
    where the text is too short to be judged)."""
    refs = common_words(docs).select(F.col("lang").alias("ref"), "common")
    refs = F.broadcast(cut(spark, refs, "quality-common"))
    named = refs.select("ref", "common")
    pooled = refs.filter(F.col("ref") == POOLED).select(F.col("common").alias("pooled"))
    m = base_measures(docs)
    joined = m.join(named, m["lang"] == named["ref"], "left").join(pooled, F.lit(True), "left")
    common = F.coalesce("common", "pooled")
    joined = joined.select(*m.columns, F.coalesce("ref", F.lit(POOLED)).alias("ref"), common.alias("common"))
    joined = joined.withColumn("marks", F.transform("common", lambda c: F.xxhash64(c["word"])))
    hits = F.slice(F.array(*[times_of("hash", F.get("marks", F.lit(i))) for i in range(COMMON)]), F.lit(1), F.size("marks"))
    narrow = joined.select(
        "doc_id", "ref", "n_words", "word_chars", F.col("symbol").alias("n_symbols"), "n_dup_lines",
        "n_repeat_words", F.array(*FIGURES).alias("classes"),
        F.when(F.col("n_words") >= MIN_WORDS_COMMON, hits).alias("hits"),
        F.transform("common", lambda c: c["share"]).alias("shares"))
    narrow = cut(spark, narrow, "quality-figures")

    n = len(FIGURES)
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(n)]
    every = narrow.groupBy("ref").agg(*sums)
    total = sum((F.col(f"c{i}") for i in range(1, n)), F.col("c0"))
    shares = F.array(*[F.col(f"c{i}") / total for i in range(n)])
    class_refs = every.filter(total > 0).select("ref", shares.alias("class_shares"))
    j = narrow.join(F.broadcast(class_refs), "ref", "left")
    length = F.aggregate("classes", F.lit(0).cast("long"), lambda s, x: s + x)
    j = j.withColumn("class_p", F.when(F.col("n_words") >= MIN_WORDS_CLASS,
                                       F.transform("classes", lambda x: x / length)))
    in_common = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x)
    j = j.withColumn("word_p", F.concat(F.transform("hits", lambda x: x / F.col("n_words")),
                                        F.array((F.col("n_words") - in_common) / F.col("n_words"))))
    rest = 1.0 - F.aggregate("shares", F.lit(0.0), lambda s, x: s + x)
    j = j.withColumn("word_q", F.concat("shares", F.array(F.greatest(rest, F.lit(0.0)))))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    j = j.withColumns({"base_failed": failed,
                       "js_class": js_distance(F.col("class_p"), F.col("class_shares")),
                       "js_words": js_distance(F.col("word_p"), F.col("word_q"))})
    near = (F.coalesce(F.col("js_class") <= MAX_CLASS_DISTANCE, F.lit(True))
            & F.coalesce(F.col("js_words") <= MAX_WORD_DISTANCE, F.lit(True)))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (~F.col("base_failed") & near).alias("kept"), "js_class", "js_words")


def op7_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d))),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win WHERE times > 1) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, d.lang, d.w, len(d.w) AS n_words, length(array_to_string(d.w, '')) AS word_chars,
         length(text) AS chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS symbol,
         length(regexp_replace(text, '\P{Lu}', '', 'g')) AS upper,
         length(regexp_replace(text, '\P{Ll}', '', 'g')) AS lower,
         length(regexp_replace(text, '[^0-9]', '', 'g')) AS digit,
         length(regexp_replace(text, '[^.,;:!?''"()-]', '', 'g')) AS mark,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)),
tok AS (SELECT doc_id, lang, unnest(w) AS word FROM d),
counts AS (
  SELECT lang, word, count(*) AS n FROM tok WHERE lang IS NOT NULL GROUP BY ALL
  UNION ALL SELECT '*', word, count(*) FROM tok GROUP BY word),
top AS (
  SELECT lang, word, n / (sum(n) OVER (PARTITION BY lang))::DOUBLE AS share,
         row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM counts
  QUALIFY rank <= 20),
named AS (SELECT b.*, coalesce(l.lang, '*') AS ref FROM base b LEFT JOIN (SELECT DISTINCT lang FROM top) l ON l.lang = b.lang),
cls AS (
  SELECT doc_id, ref, n_words, unnest(['upper', 'lower', 'digit', 'mark', 'symbol', 'blank', 'rest']) AS c,
         unnest([upper, lower, digit, mark, symbol, chars - word_chars,
                 word_chars - upper - lower - digit - mark - symbol])::DOUBLE AS n FROM named),
cp AS (SELECT *, n / nullif(sum(n) OVER (PARTITION BY doc_id), 0) AS p FROM cls),
cq AS (SELECT ref, c, sum(n) / nullif(sum(sum(n)) OVER (PARTITION BY ref), 0) AS q FROM cls GROUP BY ref, c),
jc AS (
  SELECT doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                               + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS js
  FROM cp JOIN cq USING (ref, c) WHERE n_words >= 20 GROUP BY doc_id),
hit AS (SELECT t.doc_id, t.word, count(*) AS n FROM tok t GROUP BY ALL),
wp AS (
  SELECT nd.doc_id, t.share AS q, coalesce(h.n, 0) / nd.n_words::DOUBLE AS p
  FROM named nd JOIN top t ON t.lang = nd.ref LEFT JOIN hit h ON h.doc_id = nd.doc_id AND h.word = t.word
  WHERE nd.n_words >= 100),
wpr AS (SELECT * FROM wp UNION ALL SELECT doc_id, 1 - sum(q), 1 - sum(p) FROM wp GROUP BY doc_id),
jw AS (
  SELECT doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                               + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS js
  FROM wpr GROUP BY doc_id)
SELECT b.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, symbol::BIGINT AS n_symbols,
       (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND coalesce(round(jc.js, 6) <= 0.25, true) AND coalesce(round(jw.js, 6) <= 0.45, true) AS kept,
       round(jc.js, 6) AS js_class, round(jw.js, 6) AS js_words
FROM base b LEFT JOIN jc ON jc.doc_id = b.doc_id LEFT JOIN jw ON jw.doc_id = b.doc_id
"""
