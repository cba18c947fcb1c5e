"""Token ids as length-delimited binary records, with a separate offset index.

File format. A data set is a folder with ``data/`` (record files, in ascending order of document
id by file name and position) and ``index/`` (a Parquet table, one row per record). A record is

    length   unsigned 64 bit   bytes of the payload
    check    unsigned 32 bit   masked CRC-32 of the eight length bytes
    payload                    one sequence: a byte for the id's presence, the document id (signed
                               64 bit), a byte for the width of an id, then the ids
    check    unsigned 32 bit   masked CRC-32 of the payload
    newline                    one byte, closes the record

all little-endian. A mask rotates the CRC right by 15 bits and adds a constant, so that the
checksum of data that itself holds checksums stays meaningful. Ids take two bytes where the
vocabulary allows it. The index holds for each record its file, its place in the file, byte offset
and length, document id, number of ids and ``start``, the number of ids before it in the whole
data set: a reader that shuffles needs the index alone to choose, then one range per record
(``RecordReader``).

Work. Documents are split by ranges of (id, text hash, row number), so no range is hot even where
one id or one text is very frequent; each range is tokenised and framed where it lands and written
by Spark's own text writer as raw bytes, so a file appears when its task has committed and a lost
executor leaves no half record. Number of files: bytes of text over ``FILE_BYTES``. Files are read
back whole, one at a time per task; prefix sums over files (one row each) give ``start``.

Encoding. The tokenizer drops white space, and no rule of it looks across white space, so the ids
of a text are those of its runs of other characters in order; nor does one look from a letter to a
sentence mark after it, so a run's ids are those of its core and of the marks at its end (tested on
whole texts). A worker has the library encode each distinct part once and remembers the ids of up
to ``KNOWN_PARTS`` parts; texts are put together from them by array operations.

Defined results: a null or empty text is the end id alone; a null id comes first; rows that repeat
an id are ordered by text hash, equal rows give equal records; very long texts are encoded in runs
and framed as one record; an empty table gives an empty data set. Only id and text are read, so
other columns cannot clash. A wrong checksum or a truncated file raises ``ValueError``.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import bounded_batches, read_table
from pitwall.session import checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
FILE_BYTES = 16 << 20           # text per record file
KNOWN_PARTS = 1 << 20           # parts a worker remembers; beyond, it forgets all
BLOCK_BYTES = 8 << 20           # text encoded at once inside a task; one text is never cut
BROADCAST_FILES = 1 << 15       # files whose index summary is broadcast (100 bytes a file)
MARKS = ".,;:!?"

MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
SEQUENCE = struct.Struct("<?qB")
TAIL = struct.Struct("<Ic")
NEWLINE = b"\n"

ENTRY = "file string, position long, offset long, length long, doc_id long, n_tokens long, earlier long"
SEQUENCES = "doc_id long, start long, n_tokens long, ids binary"


# --- records ----------------------------------------------------------------------------

def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def unmasked(value: int) -> int:
    rotated = (value - MASK) & 0xFFFFFFFF
    return (rotated >> 17 | rotated << 15) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One record, without its closing newline."""
    payload = SEQUENCE.pack(doc_id is not None, doc_id or 0, width) + ids
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def read_record(data, offset: int = 0) -> tuple[int | None, np.ndarray, int]:
    """(document id, ids, offset of the next record) of the record at ``offset``."""
    view = memoryview(data)
    if len(view) < offset + HEAD.size:
        raise ValueError("truncated record head")
    size, check = HEAD.unpack_from(view, offset)
    if masked(view[offset:offset + 8]) != check:
        raise ValueError(f"wrong checksum of the length at byte {offset}")
    begin = offset + HEAD.size
    if len(view) < begin + size + TAIL.size:
        raise ValueError("truncated record")
    payload = view[begin:begin + size]
    check, close = TAIL.unpack_from(view, begin + size)
    if masked(payload) != check or close != NEWLINE:
        raise ValueError(f"wrong checksum of the payload at byte {offset}")
    present, doc_id, width = SEQUENCE.unpack_from(payload)
    ids = np.frombuffer(payload[SEQUENCE.size:], np.dtype(f"<u{width}")).astype("<u4")
    return doc_id if present else None, ids, begin + size + TAIL.size


def records(data) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, document id, ids) of every record of a file's content."""
    at = 0
    while at < len(data):
        doc_id, ids, after = read_record(data, at)
        yield at, after - at, doc_id, ids
        at = after


# --- encoding ---------------------------------------------------------------------------

class Encoder:
    """Ids of whole texts as little-endian bytes, the end id last."""

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self.width = 2 if max(self._tokenizer.get_vocab_size(), end_id) <= 1 << 16 else 4
        self._kind = np.dtype(f"<u{self.width}")
        self._end = np.asarray([end_id], self._kind).tobytes()
        self._forget()

    def _forget(self) -> None:
        """Known: the empty part only. Part k has the ids ``pool[first[k]:first[k] + size[k]]``."""
        self._parts = pa.array([""])
        self._pool = np.empty(0, self._kind)
        self._first, self._size = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _learn(self, parts: pa.Array) -> None:
        """The library encodes each of the new parts."""
        texts, ids = parts.to_pylist(), []
        for i in range(0, len(texts), 4096):
            ids += [e.ids for e in self._tokenizer.encode_batch_fast(texts[i:i + 4096], add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self._first = np.concatenate([self._first, len(self._pool) + np.cumsum(size) - size])
        self._size = np.concatenate([self._size, size])
        self._pool = np.concatenate([self._pool, np.fromiter(chain.from_iterable(ids), self._kind, int(size.sum()))])
        self._parts = pa.concat_arrays([self._parts, parts])

    def _numbers(self, parts: pa.Array) -> np.ndarray:
        """The number of each part, new ones learnt."""
        at = pc.index_in(parts, value_set=self._parts)
        if at.null_count:
            missing = pc.is_null(at)
            new, known = parts.filter(missing).unique(), len(self._parts)
            self._learn(new)
            at = at.fill_null(-1).to_numpy().copy()
            at[missing.to_numpy(zero_copy_only=False)] = known + pc.index_in(parts.filter(missing), value_set=new).to_numpy()
            return at
        return at.to_numpy()

    def encode(self, texts: pa.Array) -> list[bytes]:
        if len(self._parts) > KNOWN_PARTS:
            self._forget()
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        core, marks = split_runs(coded.dictionary)
        both = self._numbers(pa.concat_arrays([core, marks]))
        run = coded.indices.to_numpy()
        parts = np.empty(2 * len(run), np.int64)
        parts[0::2], parts[1::2] = both[:len(core)][run], both[len(core):][run]
        n = self._size[parts]
        ends = np.cumsum(n)
        out = self._pool[np.arange(int(n.sum())) + np.repeat(self._first[parts] - (ends - n), n)]
        offsets = words.offsets.to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], ends])[2 * (offsets - offsets[0])]
        return [out[a:b].tobytes() + self._end for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def split_runs(runs: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(cores, sentence marks at their ends) of runs; no marks where the core does not end in a
    letter. The tokenizer splits there anyway, and no letter composes with such a mark."""
    core = pc.utf8_rtrim(runs, characters=MARKS)
    split = pc.and_(pc.not_equal(core, runs), pc.match_substring_regex(core, r"\p{L}$"))
    marks = pc.replace_substring_regex(runs.filter(split), rf"(?s)^.*[^{MARKS}]", "")
    return pc.if_else(split, core, runs), pc.replace_with_mask(pa.array([""] * len(runs)), split, marks)


@lru_cache(1)
def shared_encoder(path: str, end_id: int) -> Encoder:
    """One for all tasks of a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task per core
    return Encoder(path, end_id)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def frames(path: str, end_id: int):
    """An Arrow function (id, text) -> record as raw text."""
    @F.arrow_udf("binary")
    def framed(doc_id: pa.Array, text: pa.Array) -> pa.Array:
        encoder, out = shared_encoder(path, end_id), []
        for start, texts in runs_of(text):
            out += [frame(doc_id[start + i].as_py(), ids, encoder.width) for i, ids in enumerate(encoder.encode(texts))]
        return pa.array(out, pa.binary())
    return framed


def runs_of(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(index of the first row, texts) for slices of about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    i = 0
    while i < len(sizes):
        j = max(i + 1, i + int(np.searchsorted(np.cumsum(sizes[i:]), limit)))
        yield i, column.slice(i, j - i)
        i = j


# --- data sets --------------------------------------------------------------------------

def write_records(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID,
                  file_bytes: int = FILE_BYTES) -> None:
    """Writes ``folder``/data and ``folder``/index."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    order = ["doc_id", "mark", "row"]
    ordered = (rows.withColumns({"mark": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
               .repartitionByRange(max(1, -(-size // file_bytes)), *order).sortWithinPartitions(*order))
    framed = frames(tokenizer or tokenizer_path(), end_id)
    (ordered.select(framed("doc_id", "text").cast("string").alias("value"))
     .write.option("lineSep", "\n").text(f"{folder}/data"))
    entries = spark.read.format("binaryFile").load(f"{folder}/data").select("path", "content").mapInArrow(_entries, ENTRY)
    entries.write.parquet(f"{folder}/entries")
    write_index(spark.read.schema(entries.schema).parquet(f"{folder}/entries"), f"{folder}/index")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every record of files (path, content), ``earlier``: ids before it in its file."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            file = path.as_py().rsplit("/", 1)[-1]
            found = [(at, size, doc_id, len(ids)) for at, size, doc_id, ids in records(content.as_buffer())]
            n, columns = len(found), list(zip(*found, strict=True)) or [()] * 4
            earlier = np.cumsum(columns[3], dtype=np.int64) - np.asarray(columns[3], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.string()), pa.array(np.arange(n), pa.int64()),
                 *(pa.array(c, pa.int64()) for c in (*columns, earlier))],
                names=["file", "position", "offset", "length", "doc_id", "n_tokens", "earlier"])


def write_index(entries: DataFrame, folder: str) -> None:
    """Writes the index: the ids before a record are those of all earlier files, summed over one
    row a file (a file holds ``FILE_BYTES`` of text on average), and those earlier in its file."""
    before = F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = entries.groupBy("file").agg(F.sum("n_tokens").alias("ids")).select(
        "file", F.coalesce(before, F.lit(0)).alias("before"))
    (entries.join(files, "file").withColumn("start", F.col("before") + F.col("earlier"))
     .drop("before", "earlier").write.parquet(folder))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): all records, read from the files in order and checked, also
    against the index; ids as little-endian unsigned 32-bit integers. The index gives each file's
    first ``start`` and number of records, one row a file; up to ``BROADCAST_FILES`` of them go to
    the files, so that no content is moved."""
    known = read_index(spark, folder).groupBy("file").agg(F.min("start").alias("start"), F.count(F.lit(1)).alias("n"))
    if known.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES:
        known = F.broadcast(known)
    files = spark.read.format("binaryFile").load(f"{folder}/data").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.join(known, "file").select("content", "start", "n").mapInArrow(_in_order, SEQUENCES)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    for batch in batches:
        for content, start, n in zip(*batch.columns, strict=True):
            start, rows, seen = start.as_py(), [], 0
            for _, _, doc_id, ids in records(content.as_buffer()):
                rows.append((doc_id, start, len(ids), ids.tobytes()))
                start, seen = start + len(ids), seen + 1
                if len(rows) == 1024:
                    yield _batch(rows, kinds)
                    rows = []
            if seen != n.as_py():
                raise ValueError(f"a file has {seen} records, the index names {n.as_py()}")
            yield _batch(rows, kinds)


def _batch(rows: list[tuple], kinds) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["doc_id", "start", "n_tokens", "ids"])


class RecordReader:
    """Random access for a training process: ``reader[file, offset, length]`` reads one range."""

    def __init__(self, folder: str):
        self._fs, self._path = pyarrow.fs.FileSystem.from_uri(folder)

    def __getitem__(self, place: tuple[str, int, int]) -> tuple[int | None, np.ndarray]:
        file, offset, length = place
        with self._fs.open_input_file(f"{self._path}/data/{file}") as f:
            f.seek(offset)
            return read_record(f.read(length))[:2]


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as records with their index, and read back with it."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pitwall-llm/records-{uuid.uuid4().hex}"
    write_records(read_table(spark, sf_dir, "documents"), folder)
    return read_records(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
