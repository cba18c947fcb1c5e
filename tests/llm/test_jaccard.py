import random

import pytest

from pitwall.llm import jaccard


def brute(rows, n, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, text in rows:
        w = (text or "").translate(low).split()
        sets.append({tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(zip([r[0] for r in rows], sets))), key=repr)


def near_copies(seed):
    """Groups of edited copies, chains of edits, texts that share a passage."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    passage = [rng.choice(vocab) for _ in range(60)]
    texts = []
    for _ in range(6):
        base = [rng.choice(vocab) for _ in range(rng.randint(20, 150))]
        for _ in range(rng.randint(1, 14)):
            base = list(base) if rng.random() < 0.5 else base
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy))
            if rng.random() < 0.5:
                base = copy                       # a chain
    for _ in range(12):
        texts.append(" ".join(passage + [rng.choice(vocab) for _ in range(rng.randint(5, 60))]))
    return [(k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed,small,leaf", [(1, 32, 1024), (2, 2, 1024), (3, 2, 3)])
def test_components_equal_brute_force(spark, seed, small, leaf):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.join_documents(spark, docs, small=small, leaf=leaf)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 4, 85)


def test_odd_rows(spark, table, odd_rows):
    docs = table(odd_rows)
    got = sorted((tuple(r) for r in jaccard.join_documents(spark, docs).collect()), key=repr)
    assert got == brute([(r[0], r[1]) for r in odd_rows], 4, 85)
    kept = jaccard.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == [1, 10, 11, 4, 5, 6, 7, 9, None]


@pytest.mark.parametrize("broadcast_ids", [1 << 17, 0])
def test_rows_that_repeat_an_id(spark, table, monkeypatch, broadcast_ids):
    """Texts count, not ids: a clean text under a repeated id stays, reruns choose the same row."""
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", broadcast_ids)
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a, "en", "s2"), (1, a, "en", "s1"), (1, b, "en", "s1"), (2, a, "en", "s0"), (3, b + " end", "en", "s3"),
            (None, c, "en", "s1"), (None, c, "en", "s0"), (None, c + " end", "en", "s0"), (4, "", "en", "s"), (4, None, "en", "s")]
    for order in (rows, rows[::-1]):
        kept = jaccard.one_of_each(spark, table(order).repartition(3)).select("doc_id", "text", "source").collect()
        got = [tuple(r) for r in kept]
        assert got.count((1, a, "s1")) == 1 and got.count((1, b, "s1")) == 1
        assert len([r for r in got if r[0] is None]) == 1 and len(got) == 5
        assert sorted(got, key=repr) == sorted(set(got), key=repr)
    assert {(4, "", "s"), (4, None, "s")} <= set(got)


def test_empty_table(spark, table, odd_rows):
    docs = table(odd_rows).limit(0)
    assert jaccard.join_documents(spark, docs).collect() == []
    assert jaccard.one_of_each(spark, docs).collect() == []


@pytest.mark.parametrize("edits", [3, 9, 14])
def test_large_region_shrinks(spark, monkeypatch, edits):
    """A group of near copies above the leaf: from all within E of each other to hardly any. Few
    rounds are needed, and documents that are all linked have no more than two places."""
    rng = random.Random(edits)
    vocab = [f"w{k}" for k in range(2000)]
    base, rows = [rng.choice(vocab) for _ in range(400)], []
    for k in range(300):
        copy = list(base)
        for at in rng.sample(range(400), rng.randint(edits - 2, edits)):
            copy[at] = rng.choice(vocab)
        rows.append((k, " ".join(copy)))
    placed, cut = [], jaccard.cut

    def counted(spark, df, name):
        out = cut(spark, df, name)
        if name == "jaccard-cells":
            placed.append(out.filter("b IS NULL").count())
            assert len(placed) < 6 and (edits > 3 or placed[-1] <= 2 * 300)
        return out

    monkeypatch.setattr(jaccard, "cut", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.join_documents(spark, docs, small=2, leaf=100)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 4, 85)
    assert placed or edits == 14
