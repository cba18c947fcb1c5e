"""Sharding by fixed virtual slots.

Every record hashes into one of ``SLOTS`` virtual slots, whatever the number of shards. Bytes
and rows are summed per slot, and a versioned map says which shard holds which slot. To
rebalance or grow, the map is edited: slots move, records never hash anew. Versions of the map are
stored beside each other (``save_map``); readers take the newest (``load_map``), and ``rebalance``
edits it and stores the next.

The map has a fixed number of entries (8,192), so building it on the driver and broadcasting
it are bounded whatever the corpus. The law is ``bytes``: shards have nearly equal bytes.

Defined results: a null text has size 8 and checksum 0; a null doc_id hashes like any value;
repeated rows share a slot and get different positions; an empty table gives no rows. Columns
of the input with clashing names are kept by :func:`place` as ``input_<name>``.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import cut, own_names, read_table
from pitwall.session import checkpoint_dir

SLOTS = 8192
SHARDS = 24


@dataclass(frozen=True)
class SlotMap:
    """Version of the map, and the shard of every slot (a tuple of ``SLOTS`` shard numbers)."""
    version: int
    shard_of: tuple[int, ...]

    def loads(self, sizes: dict[int, int], shards: int) -> list[int]:
        out = [0] * shards
        for slot, size in sizes.items():
            out[self.shard_of[slot]] += size
        return out


def first_map(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> SlotMap:
    """Largest slot first, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    shard_of = [i % shards for i in range(slots)]
    for slot in sorted(sizes, key=lambda i: (-sizes[i], i)):
        load, s = heapq.heappop(heap)
        shard_of[slot] = s
        heapq.heappush(heap, (load + sizes[slot], s))
    return SlotMap(1, tuple(shard_of))


def edit_map(old: SlotMap, sizes: dict[int, int], shards: int) -> SlotMap:
    """The next version: slots leave shards that no longer exist and shards above the mean,
    largest that fits first, for the shard with the fewest bytes. Other slots stay."""
    shard_of = list(old.shard_of)
    slots_of: dict[int, list[int]] = {s: [] for s in range(shards)}
    homeless = []
    for slot, s in enumerate(shard_of):
        (slots_of[s] if s < shards else homeless).append(slot)
    load = {s: sum(sizes.get(i, 0) for i in slots_of[s]) for s in slots_of}
    mean = sum(sizes.values()) / shards
    for s in slots_of:
        for slot in sorted(slots_of[s], key=lambda i: (-sizes.get(i, 0), i)):
            if sizes.get(slot, 0) and load[s] - sizes[slot] >= mean:
                load[s] -= sizes[slot]
                homeless.append(slot)
    heap = [(load[s], s) for s in slots_of]
    heapq.heapify(heap)
    for slot in sorted(homeless, key=lambda i: (-sizes.get(i, 0), i)):
        size, s = heapq.heappop(heap)
        shard_of[slot] = s
        heapq.heappush(heap, (size + sizes.get(slot, 0), s))
    return SlotMap(old.version + 1, tuple(shard_of))


MAP = "version int, virtual_slot int, shard int"


def save_map(spark: SparkSession, m: SlotMap, path: str) -> None:
    """Stores a version of the map as a new part of the table at ``path``; versions are never
    changed. One writer at a time: a version that exists already is an error."""
    rows = spark.createDataFrame([(m.version, i, s) for i, s in enumerate(m.shard_of)], MAP)
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/map-{m.version:08d}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap | None:
    """The newest stored version, or the given one; None where nothing is stored."""
    try:
        table = spark.read.schema(MAP).parquet(f"{path}/map-{'*' if version is None else f'{version:08d}'}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = table.agg(F.max("version")).first()[0]
    rows = table.filter(F.col("version") == newest).orderBy("virtual_slot").collect()      # SLOTS rows
    if [r["virtual_slot"] for r in rows] != list(range(len(rows))):
        raise ValueError(f"version {newest} of the map at {path} is not whole")
    return SlotMap(newest, tuple(r["shard"] for r in rows))


def rebalance(spark: SparkSession, docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS) -> SlotMap:
    """The stored map, edited for the bytes that ``docs`` have per slot now and for ``shards``, and
    stored as the next version; the first version where nothing is stored."""
    size, crc = text_size(F.col("text")), text_crc(F.col("text"))
    sized = docs.select(slot_of([F.col("doc_id"), crc, size], slots).alias("s"), size.alias("b"))
    sizes = {i: b for i, (b, _) in slot_sizes(sized, "s", "b").items()}
    old = load_map(spark, path)
    new = first_map(sizes, shards, slots) if old is None else edit_map(old, sizes, shards)
    save_map(spark, new, path)
    return new


def slot_of(identity: list[Column], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*identity), F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame, slot: str, size: str) -> dict[int, tuple[int, int]]:
    """slot → (bytes, rows): at most ``SLOTS`` entries."""
    rows = records.groupBy(slot).agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("n")).collect()
    return {r[0]: (r["b"], r["n"]) for r in rows}


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def place(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS,
          slot_map: SlotMap | None = None, keep: bool = False) -> DataFrame:
    """Each record with its place.

    Returns doc_id, size, text_crc32, law, shard, slot (position within the shard, from 0
    without gaps), grown_shard (null under this law), virtual_slot, map_version. With ``keep``
    the input's columns come first; one that clashes with a result column is named
    ``input_<name>``, since the result's names always hold the result. ``slot_map`` is the stored
    map (:func:`load_map`); None builds its first version.
    """
    p = own_names(docs)
    size, crc, slot = f"{p}size", f"{p}crc", f"{p}slot"
    carried = docs.columns if keep else ["doc_id"]
    records = docs.withColumns({size: text_size(F.col("text")), crc: text_crc(F.col("text"))})
    records = records.withColumn(slot, slot_of([F.col("doc_id"), F.col(crc), F.col(size)], slots))
    records = cut(spark, records.select(*carried, size, crc, slot), "shard-records")
    sizes = slot_sizes(records, slot, size)
    by_bytes = {i: b for i, (b, _) in sizes.items()}
    m = slot_map or first_map(by_bytes, shards, slots)
    offset, filled = [], [0] * (max(m.shard_of) + 1)
    for i, s in enumerate(m.shard_of):
        offset.append((m.version, i, s, filled[s]))
        filled[s] += sizes.get(i, (0, 0))[1]
    table = spark.createDataFrame(offset, f"{p}v int, {slot} int, {p}shard int, {p}first long")
    within = Window.partitionBy(slot).orderBy("doc_id", crc, size)
    out = records.join(F.broadcast(table), slot).withColumn(f"{p}n", F.row_number().over(within))
    result = {
        "doc_id": F.col("doc_id"), "size": F.col(size), "text_crc32": F.col(crc),
        "law": F.lit("bytes"), "shard": F.col(f"{p}shard"),
        "slot": F.col(f"{p}first") + F.col(f"{p}n") - 1,
        "grown_shard": F.lit(None).cast("int"), "virtual_slot": F.col(slot),
        "map_version": F.col(f"{p}v"),
    }
    taken = {n.lower() for n in result if n != "doc_id"}
    have = [F.col(c).alias(f"input_{c}" if c.lower() in taken else c) for c in docs.columns] if keep else []
    names = {c.lower() for c in docs.columns} - taken if keep else set()
    return out.select(*have, *[c.alias(n) for n, c in result.items() if n not in names])


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; rows are dealt to writers by virtual slot, so that no task holds
    a whole shard."""
    placed.repartition("shard", "virtual_slot").write.partitionBy("shard").parquet(path)


def op3_shard_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the first stored version of their map."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = f"{checkpoint_dir(spark).rstrip('/')}/pitwall-llm/slot-map-{uuid.uuid4().hex}"
    rebalance(spark, docs, path)
    return place(spark, docs, slot_map=load_map(spark, path))
