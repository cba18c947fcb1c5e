"""Fill-in-the-middle: cuts, forms, exact round trip, units other than code points."""

import hashlib

import pytest
import regex

from pitwall.llm import fim


def plain_cut(doc_id, text):
    """The stated result, with slices only."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}")


def test_matches_plain_cut_and_restores(spark, table, odd_rows):
    from pyspark.sql import functions as F
    rows = odd_rows + [(i, f"té\U0001f600<{i} ab\n" * (i % 7), "en", "a") for i in range(20, 120)]
    rows += [(200, "has <P> inside", "en", "a"), (201, "<S>", "en", "a"), (202, "x<M", "en", "a"), (203, "<", "en", "a")]
    out = fim.fill_in_middle(table(rows)).withColumn("text", fim.restored(F.col("output"), F.col("form"))).collect()
    got = sorted((tuple(r)[:6] for r in out), key=repr)
    assert got == sorted((plain_cut(i, t) for i, t, *_ in rows), key=repr)
    assert sorted(r.text for r in out) == sorted(t or "" for _, t, *_ in rows)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_empty_table(table):
    assert fim.fill_in_middle(table([])).collect() == []


@pytest.mark.parametrize("unit", [fim.POINT, r"\X", r"\S+\s*|\s+"])
def test_units(unit):
    text = "één é \U0001f468‍\U0001f469 woord\n\nlast" * 50
    ends = [m.end() for m in regex.finditer(unit, text)]
    n, cuts = fim.Units(unit).cuts(text, lambda n: range(n + 1))
    assert (n, cuts) == (len(ends), [0, *ends])


def test_text_that_is_not_made_of_units():
    assert fim.Units("ab").cuts("ababa", lambda n: [0]) is None
    assert fim.transform(fim.Units("ab"), "aba", (0, 0, 0, 0)) == (0, "plain", None, None, "aba")


def test_long_texts_are_cut_alike(monkeypatch):
    text = "añ\n" * 30_001
    units = fim.Units()
    n = len(text)
    at = [0, 1, fim.RUN - 1, fim.RUN, fim.RUN + 1, n - 1, n]
    whole = units.cuts(text, lambda n: at)
    monkeypatch.setattr(fim, "LONG", 10)
    assert units.cuts(text, lambda n: at) == whole == (n, at)
    assert units.cuts("", lambda n: [0]) == (0, [0])
    exact = "x" * (2 * fim.RUN)
    assert units.cuts(exact, lambda n: [n]) == (2 * fim.RUN, [2 * fim.RUN])


def test_shares_are_parameters(spark, table):
    rows = [(i, "some text", "en", "a") for i in range(300)]
    assert {r.form for r in fim.fill_in_middle(table(rows), keep=0, spm=100).collect()} == {"spm"}
    assert {r.form for r in fim.fill_in_middle(table(rows), keep=100).collect()} == {"plain"}
    a = fim.fill_in_middle(table(rows), seed="a").collect()
    assert a == fim.fill_in_middle(table(rows), seed="a").collect() != fim.fill_in_middle(table(rows), seed="b").collect()
