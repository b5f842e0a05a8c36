"""What several operators share: a shared scratch folder and byte-level numpy helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: Deleted by the equality rules of several operators: the six ASCII white-space characters.
WHITE = r"[\x20\x09-\x0D]"


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share.

    Where the configuration names none, the folder that the context was given counts.
    Only where there is none either (tests on one machine) a temporary folder is made and set;
    on a cluster this raises.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not base and given.isDefined():
        base = given.get()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        base = tempfile.mkdtemp(prefix="civitas-")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, "civitas", uuid.uuid4().hex)


def stored(spark: SparkSession, df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts lineage so that a lost executor costs a read, and freezes whatever
    would differ if a stage ran again. Pages are packed by zstd, whose buffers lie on the
    heap; those of the default codec lie beside it, and for long binary values they grow.
    """
    path = f"{folder}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete stored tables that no later step reads."""
    jvm = spark.sparkContext._jvm
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand a task's Python BATCH bytes of rows at once, not 10,000 rows of any length.

    A setting of the session, since a plan reads it when it runs, after the operator has returned.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def trimmed() -> None:
    """Hand memory that a worker no longer uses back to the system: workers outlive their tasks."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def texts(array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string or binary array, end to end, and each value's bounds.

    Nulls count as empty.
    """
    import pyarrow as pa

    if pa.types.is_string(array.type) or pa.types.is_large_string(array.type):
        array = array.cast(pa.large_string())
    else:
        array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null("" if pa.types.is_large_string(array.type) else b"")
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    if data is None or len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def column(batch, name: str):
    """One column of an Arrow record batch as one array."""
    return batch.column(batch.schema.get_field_index(name))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**0 ... BASE**(n-1) modulo 2**64, or of its inverse; kept by the worker."""
    key = "inverse" if inverse else "base"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(PART + (1 << 16), n)
        have = np.full(size, INVERSE if inverse else BASE, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[key] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums over the first i bytes of (byte + 1) * BASE**k; windows follow by subtraction."""
    out = np.zeros(len(data) + 1, np.uint64)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    values *= powers(len(data))
    np.cumsum(values, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-free 64-bit hashes of the byte ranges [start, end)."""
    out = prefix[ends] - prefix[starts]
    out *= powers(len(prefix), inverse=True)[starts]
    return mixed(out ^ (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


#: Bytes of rows that Spark hands to a task's Python at once.
BATCH = 1 << 22
#: Bytes of text worked on at once; a longer text is worked on in such parts.
PART = 1 << 19
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BREAK = np.zeros(256, bool)
BREAK[[9, 10, 11, 12, 13, 32]] = True


def parts(batch, most: int = PART):
    """Pieces of a record batch of at most `most` bytes of text, or of one text."""
    _, bounds = texts(column(batch, "text"))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
