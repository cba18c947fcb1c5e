"""Fill-in-the-middle transformation by repeated-capture matching.

A text is a run of units (by default code points). One ``fullmatch`` of ``(unit)*`` with the
``regex`` library keeps every repetition of the group, so ``match.ends(1)`` is the list of all
unit ends: its length is n, and the two cuts are two look-ups in it. No loop walks the text.
The repetitions are held in atomic runs of ``RUN`` units: units are taken from left to right and
never given back, and the matcher keeps no way back into a run, which is what bounds its memory
(about 75 bytes a unit). Texts of more than ``LONG`` characters keep the ends of whole runs only,
and a second match inside the run of a cut finds its place: the same cuts in a few bytes a unit.

The cuts and the form come from a digest of the document id alone, so reruns agree and equal
texts under different ids are cut differently. Three forms: ``psm`` (prefix, suffix, middle),
``spm`` (suffix, prefix, middle) and ``plain`` (the text as it is).

Defined results: a null text is empty; an empty text, one that contains a marker and one that is
not wholly made of units stay plain, with null ``prefix_chars`` and ``middle_chars``; a null id is
digested as an empty string; repeated rows each get their (equal) row; equal cuts give an empty
middle; an empty table gives no rows. Only the id and the text are read, so other columns cannot
clash.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import read_table

POINT = r"(?s:.)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
KEEP_PERCENT = 10              # share of documents that stay plain
SPM_PERCENT = 20               # share of the others that go suffix first

RUN = 4096
LONG = 1 << 22

FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


class Units:
    """Ends of the units of a text."""

    def __init__(self, unit: str = POINT):
        self._unit = regex.compile(rf"(?>({unit}){{1,{RUN}}})*+")
        self._run = regex.compile(rf"((?>{unit}){{1,{RUN}}}+)*+")

    def cuts(self, text: str, at) -> tuple[int, list[int]] | None:
        """(n, character offsets after the units that ``at(n)`` names); None if the text is not
        a run of units."""
        if len(text) > LONG:
            return self._cuts_by_runs(text, at)
        match = self._unit.fullmatch(text)
        if match is None:
            return None
        ends = match.ends(1)
        return len(ends), [ends[i - 1] if i else 0 for i in at(len(ends))]

    def _cuts_by_runs(self, text: str, at) -> tuple[int, list[int]] | None:
        match = self._run.fullmatch(text)
        if match is None:
            return None
        bounds = [0, *match.ends(1)]

        def ends(run: int) -> list[int]:
            return self._unit.fullmatch(text, bounds[run], bounds[run + 1]).ends(1)
        last = len(bounds) - 2
        n = last * RUN + len(ends(last)) if last >= 0 else 0
        return n, [ends((i - 1) // RUN)[(i - 1) % RUN] if i else 0 for i in at(n)]


class Cut(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def transform(units: Units, text: str, h: tuple[int, int, int, int], keep: int = KEEP_PERCENT,
              spm: int = SPM_PERCENT) -> Cut:
    """One text, cut as the four numbers ``h`` say."""
    found = units.cuts(text, lambda n: sorted((h[0] % (n + 1), h[1] % (n + 1))))
    n, (a, b) = found or (0, (0, 0))
    if not n or h[2] % 100 >= 100 - keep or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return Cut(n, "plain", None, None, text)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return Cut(n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
    return Cut(n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")


def numbers(doc_id: Column, seed: str = "1") -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = POINT, keep: int = KEEP_PERCENT, spm: int = SPM_PERCENT,
                   seed: str = "1") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), a row per row of ``docs``."""
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                      ("middle_chars", pa.int64()), ("output", pa.string())])

    @F.arrow_udf(FIELDS)
    def cut(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        units = Units(unit)
        columns = ([], [], [], [], [])
        for t, *h in zip(text, h1.to_pylist(), h2.to_pylist(), h3.to_pylist(), h4.to_pylist(), strict=True):
            for column, value in zip(columns, transform(units, t.as_py() or "", tuple(h), keep, spm), strict=True):
                column.append(value)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)],
                                          fields=list(kind))

    out = docs.select("doc_id", cut(F.col("text"), *numbers(F.col("doc_id"), seed)).alias("cut"))
    return out.select("doc_id", "cut.*")


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form: a marker occurs once each, because texts that
    contain one stay plain and a marker cannot arise where two parts meet."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, cut in code points; the output and the text rebuilt from it by digest."""
    cut = fill_in_middle(read_table(spark, sf_dir, "documents"))
    digest = {name: F.sha2(text.cast("binary"), 256) for name, text in (
        ("output_sha256", F.col("output")), ("restored_sha256", restored(F.col("output"), F.col("form"))))}
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      *(c.alias(name) for name, c in digest.items()))


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
g AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4
  FROM d),
f AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR h3 >= 90 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM g),
p AS (SELECT *, substr(text, 1, a) AS pre, substr(text, a + 1, b - a) AS mid, substr(text, b + 1) AS suf FROM f)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
