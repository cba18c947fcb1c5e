"""Conversation prefix trie, built as adaptive radix trees over turn ids.

A turn (role, text) has a fixed-width id: the first 16 bytes, big-endian, of the SHA-256 of both.
A conversation is then one byte string, and conversations that begin alike share a prefix. An
adaptive radix tree holds these strings: inner nodes grow through four layouts (4, 16, 48, 256
children) and chains without a branch are compressed into the node below. A tree branches at any
byte; only turn-aligned depths are nodes of the trie, so the walk opens a trie node each time
another 16 bytes of the path are complete, also inside a compressed prefix.

Work. The strings are split by range of (string, conversation id) into buckets of about
``BUCKET_BYTES``; a conversation that many ids share is split too. Each bucket builds its own tree
and reports its trie nodes with all figures of their subtrees. The figures add up across buckets:
a node that several buckets hold (it lies on the path where two buckets meet) is owned by the first
for its text and its place among its parent's children, and by the last for being a leaf. A bucket
knows this from the last string before it and the first string after it, one row per bucket. So one
aggregation by node, whose rows the trees have reduced, gives the result, and no iteration over
depths is needed. Member ids of an end are hashed in the tree's task unless they reach into another
bucket; those few are hashed from pieces of text in order, never held together.

Defined results: turns without a ``conv_id`` belong to no conversation and make no node; a null
``turn`` comes first; turns of a conversation with the same number follow in order of their id
(repeated rows are repeated turns); null role or text is empty; a negative id's base rounds towards
zero; no conversations, no rows. Only the four named columns are read, so others cannot clash. A
conversation's ids (16 bytes a turn) are held in one row; texts are not moved at all.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import cut, read_table

WIDTH = 16                     # bytes of a turn id
BUCKET_BYTES = 1 << 20         # of strings and ids, per tree
BASE, HEAD = 5, 8              # conversation c-c%BASE lends its first 0 to HEAD turns

NODE = ("node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, bucket long, ends string")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# --- adaptive radix tree ----------------------------------------------------------------

class Sparse:
    """Up to 4, then up to 16 children: their bytes in order, and the children alike."""

    __slots__ = ("keys", "kids", "size")

    def __init__(self):
        self.keys, self.kids, self.size = bytearray(), [], 4

    def get(self, byte: int) -> Node | None:
        at = bisect_left(self.keys, byte)
        return self.kids[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, kid: Node):
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.keys) == self.size:
            if self.size == 16:
                return Indexed(self).put(byte, kid)
            self.size = 16
        self.keys.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return zip(self.keys, self.kids, strict=True)


class Indexed:
    """Up to 48 children: a table of 256 places into a list of them."""

    __slots__ = ("place", "kids")

    def __init__(self, smaller: Sparse):
        self.place, self.kids = bytearray(256), list(smaller.kids)
        for i, byte in enumerate(smaller.keys):
            self.place[byte] = i + 1

    def get(self, byte: int) -> Node | None:
        at = self.place[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid: Node):
        if at := self.place[byte]:
            self.kids[at - 1] = kid
        elif len(self.kids) == 48:
            return Direct(self).put(byte, kid)
        else:
            self.kids.append(kid)
            self.place[byte] = len(self.kids)
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.kids[at - 1]) for byte, at in enumerate(self.place) if at)


class Direct:
    """Up to 256 children, each at its byte."""

    __slots__ = ("kids",)

    def __init__(self, smaller: Indexed):
        self.kids: list[Node | None] = [None] * 256
        for byte, kid in smaller:
            self.kids[byte] = kid

    def get(self, byte: int) -> Node | None:
        return self.kids[byte]

    def put(self, byte: int, kid: Node):
        self.kids[byte] = kid
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


class Node:
    """``prefix``: the bytes every string below shares after the branch byte; ``ends``: the
    values of the string that ends here."""

    __slots__ = ("prefix", "ends", "kids")

    def __init__(self, prefix: bytes = b""):
        self.prefix, self.ends, self.kids = prefix, [], None

    def child(self, byte: int) -> Node | None:
        return self.kids.get(byte) if self.kids is not None else None

    def adopt(self, byte: int, kid: Node) -> None:
        self.kids = (Sparse() if self.kids is None else self.kids).put(byte, kid)


def shared_length(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


class RadixTree:
    """Byte strings with lists of values."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value: int) -> Node:
        """Adds the value at the string; the node where the string ends."""
        if self.root is None:
            self.root = Node(key)
            self.root.ends.append(value)
            return self.root
        above, node, at = None, self.root, 0
        while True:
            if not key.startswith(node.prefix, at):
                same = shared_length(node.prefix, key[at:at + len(node.prefix)])
                upper = Node(node.prefix[:same])
                if above is None:
                    self.root = upper
                else:
                    above.adopt(key[at - 1], upper)
                upper.adopt(node.prefix[same], node)
                node.prefix, node = node.prefix[same + 1:], upper
            at += len(node.prefix)
            if at == len(key):
                node.ends.append(value)
                return node
            below = node.child(key[at])
            if below is None:
                below = Node(key[at + 1:])
                node.adopt(key[at], below)
                below.ends.append(value)
                return below
            above, node, at = node, below, at + 1

    def walk(self) -> Iterator[tuple[bytes, Node, bool]]:
        """(bytes on the way into a node, node, True) in order of strings, and again with False
        when all below it is done."""
        if self.root is None:
            return
        stack = [(self.root, iter(() if self.root.kids is None else self.root.kids))]
        yield self.root.prefix, self.root, True
        while stack:
            node, kids = stack[-1]
            step = next(kids, None)
            if step is None:
                yield b"", node, False
                stack.pop()
            else:
                byte, kid = step
                stack.append((kid, iter(() if kid.kids is None else kid.kids)))
                yield bytes((byte,)) + kid.prefix, kid, True


# --- trie nodes of one bucket -----------------------------------------------------------

class Open:
    """A trie node on the current path. ``before``, ``after``: whether the last string of the
    buckets before, the first of those after, runs through it."""

    __slots__ = ("name", "depth", "size", "before", "after", "ends", "n", "first", "seen", "children", "leaves",
                 "total", "own")

    def __init__(self, name: bytes, depth: int, size: int, before: bool, after: bool):
        self.name, self.depth, self.size, self.before, self.after = name, depth, size, before, after
        self.ends, self.n, self.first = [], 0, None
        self.seen = self.children = self.leaves = self.total = self.own = 0


def trie_nodes(tree: RadixTree, sizes: dict[bytes, int], before: bytes | None, after: bytes | None,
               bucket: int) -> Iterator[tuple]:
    """Rows of ``NODE``: every turn-aligned depth on the paths of the tree."""
    path: list[Open] = []
    opened, rests, rest = [], [], b""

    def follows(key: bytes | None, turn: bytes, top: Open, shared: bool) -> bool:
        return shared and key.startswith(turn, WIDTH * top.depth)

    for step, node, enter in tree.walk():
        if enter:
            known = len(path)
            if not path:
                path.append(Open(hashlib.blake2b(digest_size=16).digest(), 0, 0, before is not None, after is not None))
            rests.append(rest)
            rest += step
            while len(rest) >= WIDTH:
                turn, rest, top = rest[:WIDTH], rest[WIDTH:], path[-1]
                path.append(Open(hashlib.blake2b(top.name + turn, digest_size=16).digest(), top.depth + 1, sizes[turn],
                                 follows(before, turn, top, top.before), follows(after, turn, top, top.after)))
            if node.ends:
                path[-1].ends = node.ends
            opened.append(len(path) - known)
        else:
            rest = rests.pop()
            for _ in range(opened.pop()):
                yield _close(path, before, after, bucket)


def _close(path: list[Open], before: bytes | None, after: bytes | None, bucket: int) -> tuple:
    top = path.pop()
    top.n += len(top.ends)
    if top.ends and (top.first is None or top.ends[0] < top.first):
        top.first = top.ends[0]
    top.total += top.n * top.size
    top.own += 0 if top.before else top.size
    if not top.seen and not top.after:
        top.leaves += 1
    if path:
        up = path[-1]
        up.n, up.seen, up.children = up.n + top.n, up.seen + 1, up.children + (not top.before)
        up.leaves, up.total, up.own = up.leaves + top.leaves, up.total + top.total, up.own + top.own
        up.first = top.first if up.first is None else min(up.first, top.first)
    ends, digest = None, None
    if top.ends:
        text, length = ",".join(map(str, top.ends)), WIDTH * top.depth
        if top.before and len(before) == length or top.after and len(after) == length:
            ends = text            # the same string ends in a neighbouring bucket too
        else:
            digest = hashlib.sha256(text.encode()).hexdigest()
    return (top.name, path[-1].name if path else None, top.depth, top.first, top.n, top.children, top.leaves,
            top.total - top.own, digest, bucket, ends)


KINDS = (pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.string())


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], kinds, names: list[str], size: int = 8192) -> Iterator[pa.RecordBatch]:
    held = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)],
                                          names=names)
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, kind, key, conv_id, sizes, other) in order: of each bucket first the strings
    around it (kind 0), then its own in order."""
    def nodes() -> Iterator[tuple]:
        now, tree, sizes, before, after, last, end = None, None, {}, None, None, None, None
        for bucket, kind, key, conv_id, lengths, other in _rows_of(batches):
            if bucket != now:
                if now is not None:
                    yield from trie_nodes(tree, sizes, before, after, now)
                now, tree, sizes, before, after, last = bucket, RadixTree(), {}, None, None, None
            if not kind:
                before, after = key, other
            elif key == last:
                end.ends.append(conv_id)
            else:
                last, end = key, tree.insert(key, conv_id)
                sizes.update((key[WIDTH * i:WIDTH * (i + 1)], size) for i, size in enumerate(lengths))
        if now is not None:
            yield from trie_nodes(tree, sizes, before, after, now)
    yield from _batches(nodes(), KINDS, [f.split()[0] for f in NODE.split(", ")])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends) in order, pieces of a node together -> (node, digest)."""
    def rows() -> Iterator[tuple]:
        now, digest = None, None
        for node, ends in _rows_of(batches):
            if node == now:
                digest.update(b",")
            else:
                if now is not None:
                    yield now, digest.hexdigest()
                now, digest = node, hashlib.sha256()
            digest.update(ends.encode())
        if now is not None:
            yield now, digest.hexdigest()
    yield from _batches(rows(), (pa.binary(), pa.string()), ["node", "pieces_sha256"])


# --- on tables --------------------------------------------------------------------------

def conversations_as_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (turn, id, size)), in order; size in UTF-8 bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.unhex(F.substring(digest, 1, 2 * WIDTH)).alias("id"),
                    F.octet_length(text).cast("long").alias("size"))
    return (turns.filter(F.col("conv_id").isNotNull())
            .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
            .agg(F.sort_array(F.collect_list(turn)).alias("turns")))


def rebuilt(spark: SparkSession, conversations: DataFrame, base: int = BASE, head: int = HEAD) -> DataFrame:
    """Every conversation with its first turns replaced by those of its base conversation."""
    ids = cut(spark, conversations, "conversation-ids")
    c = F.col("conv_id")
    heads = ids.filter(c % base == 0).select(c.alias("base"), F.slice("turns", 1, head).alias("head"))
    h = (F.crc32(c.cast("string").cast("binary")) % (head + 1)).cast("int")
    own = ids.withColumns({"base": c - c % base, "h": h})
    none = F.slice("turns", 1, 0)
    return own.join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def prefix_trie(spark: SparkSession, conversations: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Trie nodes of conversations (conv_id, turns): node, conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    keys = cut(spark, conversations.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("key"),
        F.transform("turns", lambda t: t["size"]).alias("sizes")), "conversation-keys")
    total = keys.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    ranged = cut(spark, keys.repartitionByRange(n, "key", "conv_id").withColumn("bucket", F.spark_partition_id()),
                 "conversation-buckets")
    around = Window.orderBy("bucket")                   # one row a bucket
    bounds = (ranged.groupBy("bucket").agg(F.min("key").alias("first"), F.max("key").alias("last"))
              .select("bucket", F.lit(0).alias("kind"), F.lag("last").over(around).alias("key"),
                      F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("array<long>").alias("sizes"),
                      F.lead("first").over(around).alias("other")))
    rows = ranged.select("bucket", F.lit(1).alias("kind"), "key", "conv_id", "sizes",
                         F.lit(None).cast("binary").alias("other")).unionByName(bounds)
    parts = cut(spark, rows.repartition(n, "bucket").sortWithinPartitions("bucket", "kind", "key", "conv_id")
                .mapInArrow(_buckets, NODE), "conversation-nodes")

    nodes = parts.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends_sha256").alias("ends_sha256"))
    parents = (parts.groupBy(F.col("node").alias("parent"))
               .agg(F.min("conv_id").alias("parent_conv_id"), F.sum("n_children").alias("kids"))
               .filter("kids > 0").drop("kids"))
    pieces = (parts.filter(F.col("ends").isNotNull()).select("node", "bucket", "ends").repartition("node")
              .sortWithinPartitions("node", "bucket").select("node", "ends")
              .mapInArrow(_digests, "node binary, pieces_sha256 string"))
    return (nodes.join(parents, "parent", "left").join(pieces, "node", "left")
            .select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("pieces_sha256", "ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each begun by the turns of its base conversation."""
    turns = conversations_as_ids(read_table(spark, sf_dir, "conversations"))
    return prefix_trie(spark, rebuilt(spark, turns)).drop("node")


# Conversations as texts of 64 hexadecimal digits a turn; ancestors are prefixes of that text. The
# CRC-32 is folded over the digits of the id, one step a bit.
OP12_SQL = """
WITH t AS (
  SELECT conv_id AS c, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         strlen(coalesce(text, '')) AS size, turn
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, id) AS pos FROM t),
c AS (
  SELECT c, c - c % 5 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
               lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                               ELSE xor(a >> 1, CAST(3988292384 AS BIGINT) * (a & 1)) END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT c.c, p.pos, p.id, p.size FROM c JOIN p ON p.c = c.base AND p.pos <= c.h
  UNION ALL
  SELECT c.c, p.pos, p.id, p.size FROM c JOIN p ON p.c = c.c AND p.pos > c.h),
q AS (
  SELECT c, size, row_number() OVER w AS depth, string_agg(id, '') OVER w AS path FROM r
  WINDOW w AS (PARTITION BY c ORDER BY pos)),
m AS (SELECT c, 0 AS size, 0 AS depth, '' AS path FROM c UNION ALL SELECT c, size, depth, path FROM q),
e AS (SELECT c, max(depth) AS depth FROM m GROUP BY c),
n AS (
  SELECT path, m.depth, min(m.c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved,
         coalesce(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) FILTER (WHERE e.depth = m.depth), '') AS ends
  FROM m JOIN e USING (c) GROUP BY path, m.depth),
k AS (SELECT substr(path, 1, 64 * (depth - 1)) AS path, count(*) AS kids FROM n WHERE depth > 0 GROUP BY 1),
s AS (
  SELECT substr(u.path, 1, 64 * a) AS path, sum(u.saved) AS saved, sum(CASE WHEN k.kids IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT path, depth, saved, unnest(range(0, depth + 1)) AS a FROM n) u LEFT JOIN k ON k.path = u.path GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.kids, 0) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN k USING (path)
LEFT JOIN n up ON n.depth > 0 AND up.path = substr(n.path, 1, 64 * (n.depth - 1))
"""
