"""Shared helpers: table reading, lineage cuts, and vectorised word hashing.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r. These bytes never occur inside
a multi-byte UTF-8 character, so splitting bytes and splitting characters agree. A word's
hash is a 64-bit multilinear hash of its bytes: two different words or shingles share a hash
with probability about 2^-64 per pair.
"""

from __future__ import annotations


import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

BATCH_BYTES = 8 << 20
CHUNK_BYTES = 1 << 19          # text handled at once inside a task; one text is never cut


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: a lineage cut that
    outlives lost executors, and a table that several later steps read."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/pitwall-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` in this session: rows of text differ a thousandfold
    in size, so a limit in rows does not bound a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def own_names(df: DataFrame, *names: str) -> str:
    """A prefix that no column of ``df`` starts with, for helper columns."""
    prefix = "_w"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


# --- inside tasks -----------------------------------------------------------------------

_RNG = np.random.Generator(np.random.PCG64(20240229))
_POW = _RNG.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TURN, _M1, _M2, _K = (int(x) | 1 for x in _RNG.integers(2**62, 2**63, 4, dtype=np.uint64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def give_back(run):
    """A task function over batches that returns unused memory to the system when it ends: idle
    workers are kept for the next task, and several share an executor's memory."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # only the GNU library has it
            if trim is not None:
                trim(0)
    return wrapped


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(_M1)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(_M2)
    return h ^ (h >> np.uint64(32))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first row, texts as UTF-8) for runs of rows of about ``limit`` bytes; a
    null text is empty. Only one run's texts are copied out of the column at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    i = 0
    while i < len(sizes):
        j, size = i + 1, int(sizes[i])
        while j < len(sizes) and size + int(sizes[j]) <= limit:
            size += int(sizes[j])
            j += 1
        yield i, [x or b"" for x in column.slice(i, j - i).cast(pa.binary()).to_pylist()]
        i = j


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, word bounds): the words of text i are
    ``hashes[bounds[i]:bounds[i + 1]]``. ``lower`` folds A-Z only."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    space = _IS_SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]          # the buffer ends with a separator
    bounds = np.searchsorted(starts, offsets)
    out = np.empty(len(starts), np.uint64)
    table = (_LOWER if lower else np.arange(256, dtype=np.uint8)).astype(np.uint64) + np.uint64(1)
    a = 0
    while a < len(starts):                         # a very long text goes through in pieces
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + 2 * CHUNK_BYTES)))
        s, e = starts[a:b], ends[a:b]
        size = e - s
        first = np.cumsum(size) - size
        pos = np.arange(int(size.sum())) - np.repeat(first, size)
        at = pos + np.repeat(s, size)
        power = _POW[pos & 4095]
        if int(size.max()) > 4096:
            power = power + (pos >> 12).astype(np.uint64) * np.uint64(_TURN)
        out[a:b] = np.add.reduceat(table[buf[at]] * power, first)
        a = b
    return mix(out), bounds


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n``-word shingles at every position of one run of words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = words[:m].copy()
    for j in range(1, n):
        h *= np.uint64(_K)
        h += words[j:j + m]
    return mix(h)


def arrow_rows(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


