"""Language id, toxicity, Katz scoring, secrets, decontamination, licences, quality rules."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitwall.llm import decontaminate, katz, language_id, licenses, quality, secrets, toxicity
from pitwall.llm.common import chunks, fold_of, word_hashes

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_word_hashes_split_like_the_pattern():
    texts = ["", " ", "a", "A b\tc\x0bd\x0ce\rf\ng ", " x  y", "é" * 5000 + " é", "w" * 9000 + "x"]
    hashes, bounds = word_hashes([t.encode() for t in texts])
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in words]
    flat = [w.translate(LOW) for ws in words for w in ws]
    by_word = {}
    for w, h in zip(flat, hashes.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    assert [len(t) for _, t in chunks(pa.array(texts + [None]), 10)] and sum(len(t) for _, t in chunks(pa.array(texts), 10)) == 7


# --- language ---------------------------------------------------------------------------

def test_languages(spark, table, odd_rows):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        lang, parts = (("aa", ["ban", "ori", "tel"]), ("zz", ["süx", "kvö", "prz"]))[i % 2]
        rows.append((i, " ".join("".join(rng.choices(parts, k=3)) for _ in range(40)), lang, "s"))
    docs = table(rows + [(100, "..,, 12", "aa", "s"), (101, None, None, "s"), (102, "", "zz", None),
                         (103, "Ж", None, None)])
    f = language_id.fit(language_id.training_rows(docs))
    got = {r.doc_id: (r["_w_lang"], r["_w_score"]) for r in language_id.identify(spark, docs, f).collect()}
    assert all(got[i][0] == lang for i, _, lang, _ in rows)
    assert [got[i] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[103] == ("aa", 0.0)                        # letters, but no known n-gram
    kept = language_id.keep_known(spark, docs)
    assert kept.columns == docs.columns and kept.count() == 60
    odd = table(odd_rows)
    assert language_id.identify(spark, odd, f).count() == len(odd_rows)
    assert language_id.identify(spark, docs.limit(0), f).collect() == []
    nothing = language_id.fit(language_id.training_rows(docs).limit(0))
    assert {r["_w_lang"] for r in language_id.identify(spark, docs, nothing).collect()} == {"und"}


def test_filter_holds_every_gram():
    """No false negatives: every slot of an n-gram that was set answers with its language."""
    grams, _, _ = language_id._grams([b"alpha beta gamma"])
    masks = np.zeros(1 << language_id.SLOT_BITS, np.uint8)
    for s in language_id._slots(grams):
        masks[s] |= 2
    f = language_id.Filter(("x", "y"), masks, np.zeros(2))
    hit, total = language_id.hits(f, [b"alpha beta gamma", b"", b"qqqq"])
    assert hit[0, 1] == total[0] > 0 and hit[0, 0] == 0
    assert total[1] == 0 and hit[2].sum() == 0


def test_hits_are_popcounts_less_false_positives():
    """The bit-sliced counts against one n-gram, one slot and one language at a time."""
    rng = np.random.default_rng(5)
    for langs in (3, 20):
        masks = rng.integers(0, 2**min(langs, 8), 1 << language_id.SLOT_BITS, dtype=np.uint64)
        masks = (masks.astype(np.uint8) if langs <= 8 else masks | (masks << np.uint64(12)))
        rate = rng.random(langs) * 0.5
        f = language_id.Filter(tuple(f"l{i:02}" for i in range(langs)), masks, rate)
        texts = [b"", b"a", "größe und äpfel".encode(), b"12 ab34cd,  x", b"word " * 300, b"\n\t .."]
        hit, total = language_id.hits(f, texts)
        for t, got, n in zip(texts, hit, total):
            low = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in t)
            padded = b"   " + low + b"   "
            grams = [padded[i:i + 4] for i in range(len(padded) - 3) if padded[i + 1] != 32]
            assert n == len(grams)
            for lang in range(langs):
                seen = 0
                for g in grams:
                    slots = language_id._slots(np.array([int.from_bytes(g, "little")], np.uint32))
                    seen += all(int(masks[int(s[0])]) >> lang & 1 for s in slots)
                want = max(0.0, (seen - len(grams) * rate[lang]) / (1 - rate[lang]))
                assert abs(got[lang] - want) < 1e-9


# --- toxicity ---------------------------------------------------------------------------

def plain_ftrl(rows, labels, epochs):
    """FTRL-proximal with dictionaries, one coordinate at a time."""
    a, b, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        limit = 0.0 if i == "bias" else l1
        if abs(z[i]) <= limit:
            return 0.0
        return -(z[i] - math.copysign(limit, z[i])) / ((b + math.sqrt(n[i])) / a + l2)
    for _ in range(epochs):
        for x, y in zip(rows, labels):
            on = [*x, "bias"]
            w = {i: weight(i) for i in on}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in on:
                step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a
                z[i] += g - step * w[i]
                n[i] += g * g
    return {i: weight(i) for i in list(z)}


def test_ftrl_equals_the_plain_one():
    rng = random.Random(9)
    rows = [sorted(rng.sample(range(60), 8)) + ([70] if i % 3 == 0 else []) for i in range(200)]
    labels = [float(i % 3 == 0) for i in range(200)]
    want = plain_ftrl(rows, labels, toxicity.EPOCHS)
    got = toxicity.ftrl([np.array(r) for r in rows], np.array(labels))
    assert abs(got.bias - want.pop("bias")) < 1e-9
    assert got.index.tolist() == sorted(i for i, w in want.items() if w)
    assert all(abs(w - want[i]) < 1e-9 for i, w in zip(got.index.tolist(), got.weight))


def test_repeated_ids_are_learnt_the_same_way(spark, table):
    rows = [(i, f"{'bad' if i % 2 else 'good'} text {i}", None, None) for i in range(80)]
    rows += [(i, f"other text {i}", None, None) for i in range(0, 80, 3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    models = [toxicity.fit(table(order).repartition(n), labels) for order, n in ((rows, 1), (rows[::-1], 5))]
    assert models[0].index.tolist() == models[1].index.tolist() and models[0].bias == models[1].bias

def test_toxicity(spark, table, odd_rows):
    rng = random.Random(2)
    words = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(400):
        w = rng.choices(words, k=50)
        if i % 4 == 0:
            w[rng.randrange(50)] = rng.choice(["Nasty!", "vile,"])
        rows.append((i, " ".join(w), None, None))
        labels.append((i, int(i % 4 == 0)))
    docs = table(rows + [(900, None, None, None), (901, "", None, None)])
    lab = spark.createDataFrame(labels + [(1, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, lab)
    assert 0 < len(model.index) < 500                   # sparse
    got = {r.doc_id: r.score for r in toxicity.score(spark, docs, model).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert 0 <= got[900] < 0.5 and got[900] == got[901]
    unlearnt = toxicity.fit(docs, lab.limit(0))
    assert all(r.score < 1e-9 for r in toxicity.score(spark, table(odd_rows), unlearnt).collect())
    assert toxicity.score(spark, docs.limit(0), model).collect() == []


# --- Katz -------------------------------------------------------------------------------

def brute_katz(rows, held):
    tok = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None] for _, t in rows]
    c1, c2 = Counter(), Counter()
    for t, h in zip(tok, held):
        if not h:
            c1.update(t)
            c2.update(zip([None] + t[:-1], t))
    n, v = sum(c1.values()), len(c1)

    def star(c):
        of = Counter(c.values())
        return katz.discounts([0] + [of[r] for r in range(1, 7)] + [sum(k for r, k in of.items() if r > 6)])
    s1, s2 = star(c1), star(c2)

    def d(r, s):
        return s[r] if r <= 5 else r - s[6]
    p1 = {w: d(k, s1) / n for w, k in c1.items()}
    unknown = 1 - sum(p1.values())
    mass, lower = defaultdict(float), defaultdict(float)
    for (a, b), k in c2.items():
        mass[a] += d(k, s2)
        lower[a] += p1[b]

    def p(a, b):
        if (a, b) in c2:
            return d(c2[a, b], s2) / c1[a]
        low = p1.get(b, unknown)
        return (1 - mass[a] / c1[a]) / (1 - lower[a]) * low if a in c1 else low
    out = []
    for (i, _), t, h in zip(rows, tok, held):
        out.append((i, h, len(t), sum(w in c1 for w in t), n, sum(math.log10((c1[w] + 1) / (n + v + 1)) for w in t),
                    sum(math.log10(p(a, b)) for a, b in zip([None] + t[:-1], t))))
    return out, p, c1, unknown


@pytest.mark.parametrize("bucket", [katz.BUCKET_TOKENS, 400])
def test_katz_equals_brute_force(spark, table, odd_rows, bucket, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket)
    rng = random.Random(3)
    vocab = [f"W{min(int(rng.expovariate(0.05)), 90)}" for _ in range(400)]
    rows = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for k in range(150)]
    rows += [(r[0], r[1]) for r in odd_rows if r[0] != 9]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    docs = table([(i, t, None, None) for i, t in rows]).repartition(3)
    flag = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7, F.lit(0)) == 2
    got = sorted((tuple(r) for r in katz.score(spark, docs, flag).collect()), key=repr)
    want, p, c1, unknown = brute_katz(rows, held)
    assert len(got) == len(want)
    key = lambda r: (repr(r[:5]), round(r[6], 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-7)
    for context in [None, "w0", "w3", "never seen"]:    # exactly normalised
        assert sum(p(context, w) for w in c1) + p(context, "not a word") == pytest.approx(1, abs=1e-9)


def test_katz_on_nothing(spark, table, odd_rows):
    assert katz.score(spark, table(odd_rows).limit(0), F.lit(False)).collect() == []
    all_held = katz.score(spark, table(odd_rows[:3]), F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score <= 0 for r in all_held)


def test_packing():
    rng = np.random.default_rng(0)
    for a in (rng.integers(0, 2**64, 1000, dtype=np.uint64), np.empty(0, np.uint64)):
        assert (katz.unpack(katz.pack(a)) == a).all()
        assert (katz.unpack_sorted(katz.pack_sorted(np.sort(a))) == np.sort(a)).all()


# --- secrets ----------------------------------------------------------------------------

def brute_spans(text):
    t = text or ""
    spans = []
    pattern = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pat, least, group in ((0, pattern, 8, 1), (1, r"AKIA[A-Z0-9]+", 16, 0), (2, r"[0-9a-f]+", 32, 0)):
        at = 0
        while m := re.compile(pat).search(t, at):
            at = m.end()
            if len(m[group]) >= least:
                spans.append((m.start(), kind, m.end()))
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans)]


def plain_score(automaton, text):
    """Mean log-probability per symbol, the end included, one symbol at a time."""
    kinds = {**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ABCDEF", "A")}
    state, logs = 0, []
    for c in text:
        c = kinds.get(c) or ("g" if "g" <= c <= "z" else "G" if "G" <= c <= "Z" else c)
        if state is None or c not in automaton.moves[state]:
            state = None
            logs.append(automaton.miss)
        else:
            state, p = automaton.moves[state][c]
            logs.append(p)
    return (sum(logs) + (automaton.miss if state is None else automaton.ends[state])) / (len(text) + 1)


def test_samples_and_background_of_any_size():
    keep = secrets.Smallest(5)
    values = [f"s{i % 40}" for i in range(500)]
    for v in values:
        keep.add(v)
    assert [v for _, v in keep.trim()] == sorted(set(values), key=lambda v: (zlib.crc32(v.encode()), v))[:5]
    none, one = secrets.infer([]), secrets.infer(["00000000"])
    assert none.mean_log("0a0a") == none.mean_log("gggg") < one.mean_log("00000000")


def test_secrets(spark, table, odd_rows, tmp_path):
    rng = random.Random(4)
    hexed = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    upper = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=n))
    rows = []
    for i in range(150):
        rows.append((i, f"é some words password={hexed(18)} and AKIA{upper(16)} token = \"{hexed(40)}\" end", None, None))
    rows += [
        (500, "secret: token: abcdefghij api-key=12345678 API_KEY='ABC.def-12' passwd=short", None, None),
        (501, "AKIASHORT AKIA" + "A" * 12 + " xAKIA1234567890ABCD " + "a" * 31 + " " + "f" * 32, None, None),
        (502, f"the key {hexed(30)} was printed", None, None),              # like the labelled ones
        (503, "see release-notes-2024-part-one or chapter-12-of-the-manual", None, None),
        (504, None, None, None), (505, "", None, None), (505, "", None, None),
        (506, f"rotated to ASIA{upper(16)}, not {hexed(18)}.", None, None),     # an unlabelled one of two kinds
        (507, f"only {hexed(9)} and {'1' * 40} and {hexed(60)} remain", None, None),
    ]
    odd_rows = [(None if i is None else i + 1000, *rest) for i, *rest in odd_rows]
    docs = table(rows + odd_rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [r for r in secrets.op10_secret_scan(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows) + len(odd_rows)
    texts = defaultdict(list)
    for i, t, _, _ in rows + odd_rows:
        texts[i].append(t)
    for r in got:
        spans = brute_spans(texts[r.doc_id][0])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("like_")] == spans
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex"))
    by = {r.doc_id: r.spans for r in got}
    assert "like_" in by[502] and "8:38" in by[502]
    assert "like_access:11:31" in by[506] and ":37:55" in by[506]
    # learned spans are those of a plain scorer over every run of the character set
    formats = secrets.fit(docs)
    for i, t, _, _ in rows + odd_rows:
        base = [tuple(map(int, s.split(":")[1:])) for s in brute_spans(t)]
        want = set()
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]{7,}[A-Za-z0-9+/_=-]", t or ""):
            if all(m.end() <= a or b <= m.start() for a, b in base):
                p = [None if a is None else plain_score(a, m[0]) for a in (*formats.kinds, formats.plain)]
                able = [k for k in range(3) if p[k] is not None and p[k] >= formats.kinds[k].floor - secrets.SLACK
                        and p[k] - p[3] >= secrets.MIN_GAIN]
                if able:
                    kind = secrets.KINDS[max(able, key=lambda k: (p[k], -k))]
                    want.add(f"like_{kind}:{m.start()}:{m.end()}")
        assert {s for s in by[i].split(",") if s.startswith("like_")} == want
    assert by[503] == "" and by[504] == ""
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert secrets.op10_secret_scan(spark, f"{tmp_path}/none").collect() == []


def test_inferred_automaton_generalises():
    rng = random.Random(6)
    a = secrets.infer(["AKIA" + "".join(rng.choices("AG0", k=16)) for _ in range(300)])
    seen = "AKIA" + "".join(rng.choices("AG0", k=16))
    assert a.mean_log(seen) >= a.floor - secrets.SLACK
    assert a.mean_log("gggggggggggggggggggg") < a.floor - secrets.SLACK
    assert len(a.moves) < 60                              # states were merged


# --- decontamination --------------------------------------------------------------------

def weighted(items, run):
    held = Counter(s for x in items.values() for s in x)
    w = lambda s: math.log(1 + len(items) / held[s]) if held[s] else math.log(1 + len(items))
    out = {}
    for k, x in items.items():
        both = sum(w(s) for s in x & run)
        out[k] = both / (sum(map(w, x)) + sum(map(w, run)) - both)
    return out


def clean_words(text):
    return re.sub(r"[\x00-\x2f:-@\[-`{-\x7f]+", " ", text.lower()).split()


def test_decontamination_equals_brute_force(spark, table, odd_rows):
    rng = random.Random(7)
    vocab = [f"v{k}" for k in range(80)] + ["Élan"]
    item = {k: [rng.choice(vocab) for _ in range(rng.randint(4, 50))] for k in range(30)}
    rows = []
    for i in range(120):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 120))]
        if i % 2:
            part = list(item[rng.randrange(30)])
            if i % 4 == 3:
                part[rng.choice([0, -1])] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = part
        rows.append((i, (", " if i % 3 else "\n").join(w if i % 5 else [x.upper() for x in w]), None, None))
    rows += [(None if i is None else i + 1000, *rest) for i, *rest in odd_rows]
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in item.items()] + [(90, None), (91, ""), (92, "?!")],
                                  "item_id long, text string")
    docs = table(rows)
    sets = {}
    for k, x in item.items():
        x = clean_words(" ".join(x))
        n = min(5, len(x))
        sets[k] = {tuple(x[j:j + n]) for j in range(len(x) - n + 1)}
    want = set()
    for i, t, _, _ in rows:
        w = clean_words(t or "")
        for k, x in item.items():
            m, n = len(x), min(5, len(x))
            m = min(m, len(w))           # a shorter document is one window
            for a in range(len(w) - m + 1):
                run = {tuple(w[j:j + n]) for j in range(a, a + m - n + 1)}
                if run & sets[k] and weighted(sets, run)[k] >= 0.8 - 1e-9:
                    want.add((i, k))
    found = decontaminate.find(spark, docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == want == similar_windows([(i, clean_words(t or "")) for i, t, _, _ in rows],
                                          {k: clean_words(" ".join(x)) for k, x in item.items()}) and len(want) > 40
    assert {(r.doc_id, r.item_id) for r in found if r.similarity == 1.0}
    assert all(r.hamming <= decontaminate.RADIUS for r in found)
    clean = decontaminate.keep_clean(spark, docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum((i not in {g[0] for g in got}) for i, *_ in rows)
    assert decontaminate.find(spark, docs, bench.limit(0)).collect() == []
    assert decontaminate.find(spark, docs.limit(0), bench).collect() == []


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(8)
    prints = rng.integers(0, 2**64, 400, dtype=np.uint64)
    items = decontaminate.build(list(range(50)), [f"a{k} b{k} c{k} d{k} e{k}".encode() for k in range(50)])
    flips = [rng.choice(64, rng.integers(0, 22), replace=False) for _ in range(400)]
    prints = np.array([int(items.prints[k % 50]) ^ sum(1 << int(b) for b in f) for k, f in enumerate(flips)], np.uint64)
    found = decontaminate._within(items, 5, prints)
    for i, p in enumerate(items.prints):
        near = np.flatnonzero(np.bitwise_count(prints ^ p) <= decontaminate.RADIUS).tolist()
        assert found.get(i, []) == near


def similar_windows(texts, item):
    """Brute force over all windows; a document shorter than an item is one window."""
    sets = {}
    for k, x in item.items():
        n = min(5, len(x))
        sets[k] = {tuple(x[j:j + n]) for j in range(len(x) - n + 1)}
    want = set()
    for i, w in texts:
        for k, x in item.items():
            n, m = min(5, len(x)), min(len(x), len(w))
            for a in range(len(w) - m + 1):
                run = {tuple(w[j:j + n]) for j in range(a, a + m - n + 1)}
                if run & sets[k] and weighted(sets, run)[k] >= 0.8 - 1e-9:
                    want.add((i, k))
    return want


def test_edits_down_to_the_threshold_are_found(spark, monkeypatch):
    rng = random.Random(12)
    item = {k: [f"i{k}w{rng.randrange(500)}" for _ in range(38)] for k in range(20)}
    texts = []
    for i in range(600):                     # one to two edits each: similarities down to 0.8
        w = list(item[i % 20])
        w[rng.choice([2, 3, 35, -1])] = f"new{i}"
        texts.append((i, [f"x{i}a{j}" for j in range(5)] + w + [f"y{i}a{j}" for j in range(5)]))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in item.items()], "item_id long, text string")
    found = decontaminate.find(spark, docs, bench).collect()
    want = similar_windows(texts, item)
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) > 300
    assert 15 < max(r.hamming for r in found) <= decontaminate.RADIUS
    # the index is what names candidates: without its entries nothing is found
    monkeypatch.setattr(decontaminate, "_listed", lambda prints, which, b: (np.zeros(257, np.int64), np.empty(0, np.int32)))
    assert decontaminate.find(spark, docs, bench).collect() == []


def test_documents_shorter_than_the_item(spark):
    item = {k: [f"i{k}w{j}" for j in range(n)] for k, n in enumerate((38, 15, 6, 5, 3))}
    texts = []
    for k, x in item.items():
        for gone in range(len(x) + 1):
            texts.append((len(texts), x[:len(x) - gone]))
            texts.append((len(texts), x[gone:]))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in item.items()], "item_id long, text string")
    found = decontaminate.find(spark, docs, bench).collect()
    want = similar_windows(texts, item)
    assert {(r.doc_id, r.item_id) for r in found} == want
    words = {i: len(w) for i, w in texts}
    assert sum(words[i] < len(item[k]) for i, k in want) >= 14
    assert all(r.first_word == 0 and r.n_words == words[r.doc_id] for r in found)
    assert {r.doc_id for r in decontaminate.keep_clean(spark, docs, bench).collect()} == words.keys() - {i for i, _ in want}


# --- licences and quality ---------------------------------------------------------------

def test_licenses(spark, table, odd_rows):
    mit = licenses.TEMPLATES["mit-notice"]
    rows = [(1, "Intro text.\nReleased under the MIT Licence!\nReleased under the MIT License.", None, None),
            (2, "x\n\n" + mit.replace(", to any person", ",\nto any person") + "\n\ny", None, None),
            (3, "LICENSED UNDER THE APACHE LICENSE, VERSION 3.1", None, None),
            (4, "This is a sentence about licenses, nothing else, released under no terms.", None, None)]
    got = [(r.doc_id, r.unit, r.unit_no, r.template) for r in licenses.scan(table(rows + odd_rows)).collect()]
    assert (1, "line", 2, "mit") in got and (2, "paragraph", 1, "mit-notice") in got and (3, "line", 0, "apache-2.0") in got
    assert not [g for g in got if g[0] not in (1, 2, 3)]
    assert licenses.scan(table(odd_rows).limit(0)).collect() == []


def test_inline_notices(spark, table, odd_rows):
    """Notices that share their line with other text; every planted one of each template is found."""
    rng = random.Random(3)
    other = lambda n: " ".join(f"{rng.choice('bdfgkm')}o{rng.choice('xyz')}{rng.randrange(9)}a" for _ in range(n))
    rows, want = [(1, "Copyright (c) 2020 John Doe. Released under the MIT License.", None, None)], {(1, "mit")}
    for k, (name, text) in enumerate(licenses.TEMPLATES.items()):
        rows.append((100 + k, f"{other(30)} {text} {other(40)}", None, None))
        edited = text.split(" ")
        edited[-1] = "changed"
        rows.append((200 + k, f"{other(60)}, {' '.join(edited)} {other(200)}\n{other(5)}", None, None))
        want |= {(100 + k, name), (200 + k, name)}
    rows += [(300, "the license of this software is not known, and no permission is granted by anyone", None, None)]
    got = licenses.scan(table(rows + odd_rows)).collect()
    found = {(r.doc_id, r.template) for r in got if r.unit == "window"}
    lines = {(r.doc_id, r.template) for r in got if r.unit != "window"}
    every = licenses.notices(licenses.TEMPLATES, licenses.MIN_DICE)
    short = {n for n, x in every.items() if len(x.grams) < 6}               # one edit may take them below 0.7
    assert {w for w in want if w[0] < 200 or w[1] not in short} <= found | lines
    assert not found & lines and 300 not in {i for i, _ in found | lines}
    keys = set(licenses.keywords(every, licenses.MIN_DICE))
    for x in every.values():                                                # no match is without a keyword
        without = sum(not keys & set(g.split(" ")) for g in x.grams)
        assert without < licenses.fewest_shared(len(x.grams), licenses.MIN_DICE)


def test_only_texts_with_a_keyword_are_taken_apart(spark, table, odd_rows):
    rows = [(1, "no notice here\n" * 9 + "RELEASED under the MIT License.", None, None), (2, "plain words " * 50, None, None),
            (3, "lines of prose\n\nLicensed under CC\nBY-NC 4.0.", None, None)]
    scanned = licenses.scan(table(rows + odd_rows))
    got = {(r.doc_id, r.unit, r.unit_no, r.template) for r in scanned.collect()}
    assert {(1, "line", 9, "mit"), (3, "paragraph", 1, "cc-by-nc")} <= got and 2 not in {g[0] for g in got}
    plan = scanned._jdf.queryExecution().optimizedPlan().toString()
    assert any("Filter" in line and "RLIKE" in line for line in plan.splitlines())
    # a template without words that could be keywords: all texts are looked at
    numbers = {"numbers": "1 2 3 4 5 6"}
    got = licenses.scan(table([(1, "x y\n9 8 7 6", None, None), (2, "x y z", None, None)]), numbers).collect()
    assert [(r.doc_id, r.unit, r.unit_no) for r in got] == [(1, "line", 1)]


def test_quality_rules(spark, table, odd_rows):
    rng = random.Random(9)
    common, rare = ["the", "of", "and", "to"], [f"wo{chr(97 + k % 26)}{chr(97 + k // 26)}rd" for k in range(300)]
    prose = lambda n: " ".join(rng.choice(common) if rng.random() < .4 else rng.choice(rare) for _ in range(n)) + "."
    rows = [(i, prose(200), "qq", "s") for i in range(60)]
    rows += [(100, " ".join(w + "$$$ ***" for w in prose(100).split()), "qq", "s"),
             (101, " | ".join(rng.choice(rare) for _ in range(150)), "qq", "s"),
             (102, "a b c d e a b c d e x\na b c\na b c\n \n \n", None, "s"),
             (103, "spam ham eggs toast jam " * 20, "xx", "s")]
    got = {}
    for r in quality.judge(spark, table(rows + odd_rows)).collect():
        got.setdefault(r.doc_id, r)
    assert all(got[i].kept for i in range(20, 60))
    assert not got[100].kept and not got[100].base_failed and got[100].n_symbols == 600
    assert not got[101].kept and not got[101].base_failed
    assert got[102].n_dup_lines == 1 and got[102].n_repeat_words == 10
    assert got[103].base_failed and got[103].n_repeat_words == 100 and not got[103].kept
    assert got[None] is not None
    assert quality.judge(spark, table(odd_rows).limit(0)).collect() == []


def test_folds(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long").select(
        "doc_id", fold_of(F.col("doc_id"), 5).alias("f")).collect()
    assert all(r.f == (zlib.crc32(str(r.doc_id).encode()) % 5 if r.doc_id is not None else 0) for r in rows)
