import random
import zlib
from collections import Counter, defaultdict

import pytest

from pitwall.llm import mixing, sharding


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        rest = total - sum(out.values())
        over = [s for s in open_ if rest * w[s] / sum(w[x] for x in open_) > most * sizes[s]]
        if not over:
            out.update({s: rest * w[s] / sum(w[x] for x in open_) for s in open_})
            break
        for s in over:
            out[s] = most * sizes[s]
            open_.discard(s)
    return out


def test_mix_meets_targets(spark, table, odd_rows):
    docs = table(odd_rows)
    rows = mixing.mix(spark, docs).collect()
    assert len(rows) == len(odd_rows)
    sizes = defaultdict(int)
    for _, t, _, s in odd_rows:
        sizes[s] += len((t or "").split())
    aims = brute_targets(dict(sizes))
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
        assert abs(r.target - aims[r.source]) < 1e-6 and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - aims[s]) <= 1 for s in aims)
    again = mixing.mix(spark, docs.repartition(3)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_mixed_documents_are_whole(spark, table, odd_rows):
    docs = table(odd_rows)
    out = mixing.mixed_documents(spark, docs)
    assert out.columns == docs.columns
    texts = {r[1] for r in odd_rows}
    counts = Counter((r.doc_id, r.text) for r in out.collect())
    assert all(t in texts for _, t in counts)
    given = Counter((r[0], r[1]) for r in odd_rows)
    assert all(n <= 2 * given[k] for k, n in counts.items())


def test_mix_of_nothing(spark, table, odd_rows):
    assert mixing.mix(spark, table(odd_rows).limit(0)).collect() == []
    wordless = [r for r in odd_rows if not (r[1] or "").split()]
    assert {r.taken for r in mixing.mix(spark, table(wordless)).collect()} == {0}


def test_places(spark, table, odd_rows):
    rows = sharding.place(spark, table(odd_rows), shards=3).collect()
    assert len(rows) == len(odd_rows)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _, _ in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 3
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    docs = table(odd_rows)
    kept = sharding.place(spark, docs, keep=True)
    # the result's names hold the result; the input's columns of such names are kept beside them
    clash = {"size", "slot", "shard"}
    assert kept.columns[:len(docs.columns)] == [f"input_{c}" if c in clash else c for c in docs.columns]
    for r in kept.collect():
        assert r.input_shard == "shard" and isinstance(r.shard, int) and r["size"] == len((r.text or "").encode()) + 8
    assert kept.count() == len(odd_rows)
    assert sharding.place(spark, docs.limit(0)).collect() == []


def test_shards_are_level(spark, small_dir):
    rows = sharding.op3_shard_slots(spark, small_dir).collect()
    load = Counter()
    for r in rows:
        load[r.shard] += r["size"]
    largest = max(r["size"] for r in rows)
    mean = sum(load.values()) / sharding.SHARDS
    assert max(load.values()) <= max(mean * 1.02, largest + 8)


def test_map_is_edited_not_remade():
    sizes = {i: 10 + i % 7 for i in range(sharding.SLOTS)}
    m = sharding.first_map(sizes, 24)
    grown = sharding.edit_map(m, sizes, 25)
    assert grown.version == 2
    moved = [i for i in sizes if grown.shard_of[i] != m.shard_of[i]]
    assert 0 < len(moved) < 2 * len(sizes) / 25
    load = grown.loads(sizes, 25)
    assert max(load) - min(load) <= 0.02 * sum(load) / 25
    fewer = sharding.edit_map(m, sizes, 23)
    assert set(fewer.shard_of) == set(range(23))
    assert all(fewer.shard_of[i] == m.shard_of[i] for i in sizes if m.shard_of[i] < 23)


def test_map_is_stored_and_edited(spark, table, odd_rows, tmp_path):
    path, docs = f"file://{tmp_path}/map", table([r for r in odd_rows if r[0] != 9] + [(100 + i, "x" * i, "en", "a") for i in range(200)])
    assert sharding.load_map(spark, path) is None
    first = sharding.rebalance(spark, docs, path, shards=4, slots=64)
    assert first.version == 1 and sharding.load_map(spark, path) == first
    second = sharding.rebalance(spark, docs, path, shards=5, slots=64)
    assert second.version == 2 and sharding.load_map(spark, path) == second
    assert sharding.load_map(spark, path, 1) == first                     # old versions stay
    assert set(second.shard_of) == set(range(5))
    with pytest.raises(Exception, match="(?i)exist"):
        sharding.save_map(spark, second, path)
    before, after = (sharding.place(spark, docs, slots=64, slot_map=m).collect() for m in (first, second))
    for rows, m in ((before, first), (after, second)):
        # the assignment: each record in the shard that the map names for its slot
        assert all(r.shard == m.shard_of[r.virtual_slot] and r.map_version == m.version for r in rows)
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    key = lambda rows: Counter((r.doc_id, r.text_crc32, r.virtual_slot) for r in rows)
    assert key(before) == key(after)                                      # records never hash anew


def test_first_map_is_the_plain_greedy_one():
    rng = random.Random(3)
    sizes = {i: rng.randint(0, 900) for i in range(200) if i % 3}
    shard_of, load = [i % 7 for i in range(256)], [0] * 7
    for slot in sorted(sizes, key=lambda i: (-sizes[i], i)):
        least = min(range(7), key=lambda s: (load[s], s))
        shard_of[slot] = least
        load[least] += sizes[slot]
    assert sharding.first_map(sizes, 7, 256).shard_of == tuple(shard_of)
