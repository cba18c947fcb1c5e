"""Licence scan: Dice coefficient over word bigrams, with DataFrame functions only.

A text's units are its lines, its paragraphs of several lines, and windows for notices that share
their line with other text. Each unit and each template
is normalised alike: lower case, numbers as ``0``, everything else that is not a letter as a
blank. With ``a`` and ``b`` distinct bigrams the Dice coefficient is ``2c / (a + b)`` and
``c <= min(a, b)``, so a template can only match a unit whose number of bigrams lies between
``b·t / (2 - t)`` and ``b·(2 - t) / t``. These bounds prune units before any bigram is made
(a unit of ``w`` words has at most ``w - 1``) and templates per unit afterwards.

A window of a template has as many words as the template and is laid so that one of the template's
anchors, a bigram, is where the template has it. With a Dice coefficient of at least ``t`` a window
holds at least ``b·t / (2 - t)`` of the template's bigrams, so it holds one of any ``b - b·t / (2 - t)
+ 1`` of them: these are the anchors. Per document and template the best window counts, if no line or
paragraph of the document matches that template. Words are rarely those of notices, so only texts, and
of these only lines and paragraphs, that contain a keyword are taken apart; keywords touch so many
bigrams of each template that no match is without one. A notice with words missing or added before its first anchor and
between all others is judged by shifted windows and may fall below ``t``.

Templates are a fixed list, so they travel as literals. Nothing is shuffled.

Defined results: a null, empty or licence-free text gives no rows; a unit that matches several
templates gives one row for the best, ties by template name; repeated lines and rows each give
their row; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import own_names, read_table

MIN_DICE = 0.7
LETTER = "[a-zß-ɏ]"        # of normal words

# Names and wording of public licence notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:"),
    "bsd-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."),
    "isc-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:"),
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}


def normal_words(text: str) -> list[str]:
    """The templates' normal form; the same steps as :func:`words`."""
    text = re.sub(r"[0-9]+(\.[0-9]+)*", " 0 ", text.lower())
    return re.sub(r"[^a-z0ß-ɏ]+", " ", text).strip().split(" ")


@dataclass(frozen=True)
class Notice:
    """A template's words, its distinct bigrams, and its anchors with their places."""
    words: int
    grams: tuple[str, ...]
    anchors: tuple[tuple[str, int], ...]


def fewest_shared(bigrams: int, dice: float) -> int:
    """Bigrams that a unit shares at least with a template of ``bigrams`` that it matches."""
    return math.ceil(bigrams * dice / (2 - dice) - 1e-9)


def notices(templates: dict[str, str], dice: float) -> dict[str, Notice]:
    """Anchors are the bigrams with the longest words, as often as they occur."""
    out = {}
    for name, text in sorted(templates.items()):
        w = normal_words(text)
        run = [f"{a} {b}" for a, b in zip(w, w[1:])]
        grams = sorted(set(run))
        first = sorted(grams, key=lambda g: (-len(g), g))[:len(grams) - fewest_shared(len(grams), dice) + 1]
        out[name] = Notice(len(w), tuple(grams), tuple((g, q) for q, g in enumerate(run) if g in first))
    return out


# Words of any English text, which are poor keywords.
FUNCTION_WORDS = frozenset("a an and any are as at be by can for from if in is it not of on or that the this to use with you".split())


def keywords(every: dict[str, Notice], dice: float) -> list[str]:
    """Words of which every unit that matches a template holds one: the longest words, function
    words last, until more bigrams hold one than a match can lack."""
    chosen: set[str] = set()
    for notice in every.values():
        names = sorted({x for g in notice.grams for x in g.split(" ")}, key=lambda x: (x in FUNCTION_WORDS, -len(x), x))
        lacking = len(notice.grams) - fewest_shared(len(notice.grams), dice)
        for name in [None, *names]:
            chosen |= {name} - {None, "0"}
            if sum(any(x in chosen for x in g.split(" ")) for g in notice.grams) > lacking:
                break
    return sorted(chosen)


def holds_keyword(text: Column, every: dict[str, Notice], dice: float) -> Column:
    """True of every text that holds a match; of all texts if a template has too few words for keywords."""
    keys = keywords(every, dice)
    for notice in every.values():
        touched = sum(any(x in keys for x in g.split(" ")) for g in notice.grams)
        if touched <= len(notice.grams) - fewest_shared(len(notice.grams), dice):
            return F.lit(True)
    return F.lower(text).rlike(rf"(?<!{LETTER})(?:{'|'.join(keys)})(?!{LETTER})")


def words(text: Column) -> Column:
    text = F.regexp_replace(F.lower(text), r"[0-9]+(\.[0-9]+)*", " 0 ")
    return F.array_remove(F.split(text, r"[^a-z0ß-ɏ]+"), "")


def bounds(bigrams: int, dice: float) -> tuple[float, float]:
    return bigrams * dice / (2 - dice), bigrams * (2 - dice) / dice


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """(doc_id, text) → doc_id, unit ('line', 'paragraph' or 'window'), unit_no (from 0; of a window
    its first word), template, dice."""
    every_notice = notices(TEMPLATES if templates is None else templates, min_dice)
    grams = {name: n.grams for name, n in every_notice.items()}
    fewest = min(bounds(len(g), min_dice)[0] for g in grams.values())
    most = max(bounds(len(g), min_dice)[1] for g in grams.values())
    low, high = min_dice / (2 - min_dice), (2 - min_dice) / min_dice
    # names ascend, so the first of the best wins ties
    listed = F.array(*[F.struct(F.lit(name).alias("template"), F.lit(len(g)).alias("size"),
                                F.array(*[F.lit(x) for x in g]).alias("grams")) for name, g in grams.items()])
    nothing = F.struct(F.lit(-1.0).alias("dice"), F.lit("").alias("template"))

    def best(unit):
        n = F.size(unit)
        fits = F.filter(listed, lambda t: n.between(t["size"] * low, t["size"] * high))
        scored = F.transform(fits, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(unit, t["grams"])) / (n + t["size"])).alias("dice"),
            t["template"].alias("template")))
        return F.aggregate(scored, nothing, lambda a, x: F.when(x["dice"] > a["dice"], x).otherwise(a))

    def bigrams(w):
        return F.array_distinct(F.transform(F.slice(w, F.lit(1), F.size(w) - 1),
                                            lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1))))

    def matched(piece):
        # distinct bigrams <= words - 1; the upper bound is checked once they are known
        return F.when(holds_keyword(piece, every_notice, min_dice), _let(words(piece), lambda w: F.when(
            F.size(w) - 1 >= fewest, _let(bigrams(w), lambda g: F.when(F.size(g).between(fewest, most), best(g))))))

    def units(kind, pieces):
        return F.transform(pieces, lambda x, i: F.struct(
            F.lit(kind).alias("unit"), i.alias("unit_no"), matched(x).alias("best")))

    def windows(text):
        noted = F.array(*[F.struct(F.lit(name).alias("template"), F.lit(n.words).alias("words"), F.array(*map(F.lit, n.grams)).alias("grams"),
                                   F.array(*[F.struct(F.lit(g).alias("g"), F.lit(q).alias("q")) for g, q in n.anchors]).alias("anchors"))
                          for name, n in every_notice.items()])
        anchors = F.array(*map(F.lit, sorted({g for n in every_notice.values() for g, _ in n.anchors})))

        def best_of(run, hits, t):
            last = F.size(run) + 1 - t["words"]
            starts = F.array_sort(F.array_distinct(F.flatten(F.transform(t["anchors"], lambda a: F.transform(
                F.filter(hits, lambda h: h["g"] == a["g"]), lambda h: F.greatest(F.lit(0), F.least(h["i"] - a["q"], last)))))))
            scored = F.transform(starts, lambda s: _let(
                F.array_distinct(F.slice(run, s + 1, t["words"] - 1)), lambda u: F.struct(
                    (2.0 * F.size(F.array_intersect(u, t["grams"])) / (F.size(u) + F.size(t["grams"]))).alias("dice"),
                    s.alias("start"))))
            none = F.struct(F.lit(-1.0).alias("dice"), F.lit(0).alias("start"))
            top = F.when(last >= 0, F.aggregate(scored, none, lambda a, x: F.when(x["dice"] > a["dice"], x).otherwise(a)))
            return _let(top, lambda x: F.struct(F.lit("window").alias("unit"), x["start"].alias("unit_no"),
                                                F.struct(x["dice"].alias("dice"), t["template"].alias("template")).alias("best")))

        def of_run(run):
            hits = F.filter(F.transform(run, lambda g, i: F.struct(g.alias("g"), i.alias("i"))),
                            lambda h: F.array_contains(anchors, h["g"]))
            return F.when(F.arrays_overlap(run, anchors), _let(hits, lambda h: F.transform(noted, lambda t: best_of(run, h, t))))

        run = _let(words(text), lambda w: F.when(F.size(w) > 1, F.transform(
            F.slice(w, F.lit(1), F.size(w) - 1), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1)))))
        return _let(run, of_run)

    def found(units):
        return F.filter(units, lambda x: x["best"]["dice"] >= min_dice)

    text = F.col("text")
    paragraphs = F.transform(F.split(text, r"\n[\x20\x09\r]*\n\s*"),
                             lambda x: F.when(F.contains(F.trim(x), F.lit("\n")), x))
    p = own_names(docs)
    d = docs.filter(holds_keyword(text, every_notice, min_dice)).select("doc_id", F.concat(found(units("line", F.split(text, "\n"))), found(units("paragraph", paragraphs)))
                    .alias(f"{p}units"), found(windows(text)).alias(f"{p}windows"))
    alone = F.filter(f"{p}windows", lambda x: ~F.exists(f"{p}units", lambda y: y["best"]["template"] == x["best"]["template"]))
    every = F.concat(f"{p}units", F.coalesce(alone, F.slice(f"{p}units", 1, 0)))
    u = d.select("doc_id", F.explode(every).alias("u"))
    return u.select("doc_id", "u.unit", F.col("u.unit_no").cast("int").alias("unit_no"),
                    F.col("u.best.template").alias("template"), F.round("u.best.dice", 6).alias("dice"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql() -> str:
    """Lines, paragraphs and anchored windows against every template, without the size bounds and
    without keywords."""
    every = notices(TEMPLATES, MIN_DICE)
    rows = ",\n  ".join(f"('{name}', {n.words}, {[*n.grams]!r})" for name, n in every.items())
    anchors = ",\n  ".join(f"('{name}', '{g}', {q})" for name, n in every.items() for g, q in n.anchors)
    normal = """list_filter(string_split_regex(regexp_replace(lower({0}),
         '[0-9]+(\\.[0-9]+)*', ' 0 ', 'g'), '[^a-z0\\x{{df}}-\\x{{24f}}]+'), lambda x: x <> '')"""
    return f"""
WITH templates(template, m, g) AS (VALUES
  {rows}),
anchors(template, a, q) AS (VALUES
  {anchors}),
pieces AS (
  SELECT doc_id, 'line' AS unit, unnest(string_split(text, chr(10))) AS piece,
         unnest(range(len(string_split(text, chr(10))))) AS unit_no FROM documents
  UNION ALL
  SELECT * FROM (
    SELECT doc_id, 'paragraph' AS unit,
           unnest(string_split_regex(text, '\\n[\\x20\\x09\\r]*\\n\\s*')) AS piece,
           unnest(range(len(string_split_regex(text, '\\n[\\x20\\x09\\r]*\\n\\s*')))) AS unit_no FROM documents)
  WHERE contains(trim(piece), chr(10))),
w AS (SELECT doc_id, unit, unit_no, {normal.format("piece")} AS w FROM pieces),
b AS (
  SELECT doc_id, unit, unit_no,
         list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM w WHERE len(w) > 1),
d AS (
  SELECT doc_id, unit, unit_no, t.template,
         2.0::DOUBLE * len(list_intersect(b.g, t.g)) / (len(b.g) + len(t.g)) AS dice
  FROM b, templates t WHERE len(b.g) <= 4 * len(t.g)),
pieced AS (
  SELECT doc_id, unit, unit_no::INTEGER AS unit_no, template, round(dice, 6) AS dice
  FROM d WHERE dice >= {MIN_DICE}
  QUALIFY row_number() OVER (PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, template) = 1),
t AS (SELECT doc_id, row_number() OVER () AS r, {normal.format("text")} AS w FROM documents),
v AS (SELECT doc_id, r, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS run FROM t WHERE len(w) > 1),
o AS (SELECT r, unnest(run) AS a, unnest(range(len(run))) AS i FROM v),
starts AS (
  SELECT DISTINCT o.r, template, greatest(0, least(o.i - q, len(v.run) + 1 - m)) AS s
  FROM o JOIN anchors USING (a) JOIN templates USING (template) JOIN v ON v.r = o.r WHERE len(v.run) + 1 >= m),
cut AS (
  SELECT v.doc_id, s.r, s.template, s.s, t.g, list_distinct(v.run[s.s + 1:s.s + t.m - 1]) AS u
  FROM starts s JOIN v ON v.r = s.r JOIN templates t ON t.template = s.template),
windows AS (
  SELECT doc_id, r, template, s, 2.0::DOUBLE * len(list_intersect(u, g)) / (len(u) + len(g)) AS dice FROM cut
  QUALIFY row_number() OVER (PARTITION BY r, template ORDER BY dice DESC, s) = 1)
SELECT * FROM pieced
UNION ALL
SELECT doc_id, 'window', s::INTEGER, template, round(dice, 6) FROM windows x
WHERE dice >= {MIN_DICE} AND NOT EXISTS (SELECT 1 FROM pieced y WHERE y.doc_id = x.doc_id AND y.template = x.template)
"""


OP8_SQL = _sql()
