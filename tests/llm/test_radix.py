"""Conversation trie against a plain dictionary of prefixes, and the tree's layouts."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pitwall.llm import radix

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_id(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]


def plain_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn), turn_id(role, text), (role or "", text or "")))
    turns = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    conv = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        conv[c] = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in conv.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = kids[path]
        leaves[path] = sum(leaves[k] for k in below) or 1
        saved[path] = sum(saved[k] for k in below) + (
            (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if conv[c] == p))).encode()).hexdigest())
                  for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(row):
    return [(x is not None, x) for x in row]


def check(spark, rows, bucket_bytes):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "1 AS depth", "2 AS bucket")
    out = radix.prefix_trie(spark, radix.rebuilt(spark, radix.conversations_as_ids(df)), bucket_bytes)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=key)
    assert got == sorted(plain_trie(rows), key=key)


@pytest.mark.parametrize("bucket_bytes", [400, 1 << 20])
def test_random_conversations(spark, bucket_bytes):
    rng = random.Random(3)
    said = [("user", f"t{i}é" * (i % 4)) for i in range(6)] + [(None, None), ("user", None), ("a", "")]
    rows = [(c, t, *rng.choice(said[:3] if t < 3 else said)) for c in range(150) for t in range(rng.randint(1, 12))]
    rows += [(1000 + c, t, "user", f"hot {t}") for c in range(200) for t in range(9)]       # one large group
    rows += [(c, t, "user", f"hot {t}") for c in range(5000, 5040) for t in range(9 + c % 3)]
    rng.shuffle(rows)
    check(spark, rows, bucket_bytes)


def test_odd_input(spark):
    rows = [(None, 0, "a", "b"), (1, None, "a", "first"), (1, 0, "a", "x"), (1, 0, "a", "x"), (1, 0, "b", "y"),
            (7, 5, None, None), (7, 5, "", ""), (7, 9, "u", "z" * 200_000), (23, 0, "u", "only"), (0, 3, "a", "b")]
    check(spark, rows, 1 << 20)
    check(spark, rows, 64)


def test_empty_table(spark):
    check(spark, [], 1 << 20)


def test_long_conversation(spark):
    rows = [(c, t, "u", f"{t}") for c in (100, 105) for t in range(1500)] + [(105, 1500, "u", "end")]
    check(spark, rows, 1 << 14)


@pytest.mark.parametrize("count, layout", [(3, radix.Sparse), (16, radix.Sparse), (17, radix.Indexed),
                                           (48, radix.Indexed), (49, radix.Direct), (256, radix.Direct)])
def test_layouts(count, layout):
    order = random.Random(count).sample(range(256), count)
    tree = radix.RadixTree()
    for i in order:
        tree.insert(b"common" + bytes((i, 1, 2)), i)
    assert tree.root.prefix == b"common"
    assert type(tree.root.kids) is layout
    found = [node.ends for _, node, enter in tree.walk() if enter and node.ends]
    assert found == [[i] for i in sorted(order)]
    assert all(tree.root.child(i).ends == [i] for i in order)


def test_path_compression():
    rng = random.Random(1)
    keys = {bytes(rng.choices(range(3), k=rng.randint(0, 12))) for _ in range(500)}
    tree = radix.RadixTree()
    for k in rng.sample(sorted(keys), len(keys)):
        tree.insert(k, 1)
    path, found = [], []
    for step, node, enter in tree.walk():
        if enter:
            path.append(step)
            if node.ends:
                found.append(b"".join(path))
            kids = 0 if node.kids is None else len(list(node.kids))
            assert kids != 1 or node.ends        # a chain is one node
        else:
            path.pop()
    assert found == sorted(keys)
