"""The pipeline on planted copies, benchmark passages and unknown text."""

import random
from collections import Counter, defaultdict

import corpus_pipeline


def planted(n=160):
    rng = random.Random(11)
    vocab = {"aa": ["ban", "ori", "tel", "mug", "ped"], "zz": ["süx", "kvö", "prz", "wyk", "jth"]}
    word = lambda lang: "".join(rng.choices(vocab[lang], k=rng.randint(1, 4)))
    rows, items = [], [(k, " ".join(word("aa") for _ in range(25))) for k in range(5)]
    for i in range(n):
        lang = ("aa", "zz")[i % 2]
        rows.append([i, " ".join(word(lang) for _ in range(rng.randint(60, 160))), lang, f"s{i % 3}"])
    copies, near, bad, none = set(), set(), set(), set()
    for i in range(10):
        rows.append([1000 + i, rows[3][1], "zz", "s1"])
        copies.add(1000 + i)
        w = rows[4][1].split()
        w[i] = "edited"
        rows.append([2000 + i, " ".join(w), "aa", "s2"])
        near.add(2000 + i)
    for i in range(6):
        w = [word("aa") for _ in range(70)]
        w[30:30] = items[i % 5][1].split()
        rows.append([3000 + i, " ".join(w), "aa", "s0"])
        bad.add(3000 + i)
        rows.append([4000 + i, "123 -- ..." if i else None, None, None])
        none.add(4000 + i)
    return [tuple(r) for r in rows], items, copies, near, bad, none


def test_stages(spark, tmp_path):
    rows, items, copies, near, bad, none = planted()
    docs = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontaminate", "mix_sources", "shard"]
    kept, clean = {r[0] for r in rows}, set(range(160))
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:3], (none, copies | near, bad)):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        kept -= gone
        assert sorted(ids) == sorted(kept), name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert kept == clean
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = {r[0]: r[1] for r in rows}
    assert all(texts[r.doc_id] == r.text and 0 <= r.shard < 24 for r in final)
    count = Counter(r.doc_id for r in final)
    assert set(count) <= clean and max(count.values()) <= 2
    words = {i: len(texts[i].split()) for i in clean}
    size, taken = defaultdict(int), defaultdict(int)
    for i in clean:
        size[f"s{i % 3}"] += words[i]
        taken[f"s{i % 3}"] += words[i] * count[i]
    total = 1.5 * sum(size.values())
    assert abs(sum(taken.values()) - total) < 3 * max(words.values())
    slots = defaultdict(list)
    for r in final:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_documents(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
