"""Helpers that the training-data operators share: tables, checkpoints, word and window hashes."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
#: Bytes that are hashed at once; the scratch arrays take some forty times as much.
BLOCK = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Bytes of input for each hash bucket, which one Python task holds at once with what is derived from it.
BUCKET_BYTES = 16 << 20


class Buckets:
    """Hash buckets, numbered so that Spark's hash partitioning deals them evenly: as many to each shuffle partition."""

    def __init__(self, n: int, parts: int):
        self.n = n
        self.labels = np.zeros(n, np.int32)
        want, at, label = -(-n // parts), np.zeros(parts, np.int64), 0
        while (at < want).any():  # numbers that hash to each partition, as many as it is to have
            numbers = np.arange(label, label + 4 * n + 64, dtype=np.int64)
            label += len(numbers)
            for number, part in zip(numbers.tolist(), (spark_hash(numbers) % parts).tolist(), strict=True):
                bucket = part + parts * int(at[part])
                if at[part] < want:
                    at[part] += 1
                    if bucket < n:
                        self.labels[bucket] = number

    def of(self, x: np.ndarray) -> np.ndarray:
        """The bucket of each hash."""
        return self.labels[(x % U64(self.n)).astype(np.int64)]


def spark_hash(x: np.ndarray) -> np.ndarray:
    """What Spark's hash partitioning makes of whole numbers of 32 bits."""
    low = (1 << 32) - 1
    turn = lambda v, by: (v << by | v >> (32 - by)) & low
    k = turn((x & low) * 0xCC9E2D51 & low, 15) * 0x1B873593 & low
    h = (turn(42 ^ k, 13) * 5 + 0xE6546B64 & low) ^ 4
    h = (h ^ h >> 16) * 0x85EBCA6B & low
    h = (h ^ h >> 13) * 0xC2B2AE35 & low
    h ^= h >> 16
    return np.where(h >= 1 << 31, h - (1 << 32), h)


def hash_buckets(df: DataFrame) -> Buckets:
    """Buckets for a table: one for each shuffle partition, or more by its size where Spark knows it (files, checkpoints), so that a bucket is bounded whatever the session's partitions are."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = partitions(df.sparkSession)
    return Buckets(max(parts, -(-known // BUCKET_BYTES) if known < 1 << 50 else 0), parts)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares, from spark.checkpoint.dir; without one a session on one machine (tests) gets a local folder, any other an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="maskwright-"))
    return str(sc._jsc.sc().getCheckpointDir().get())


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark has it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut_lineage(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Checkpoint to the shared folder. Narrow tables, a few numbers for some of the documents, are written in an eighth of the shuffle partitions."""
    shared_folder(df.sparkSession)
    return (df.coalesce(max(1, partitions(df.sparkSession) // 8)) if narrow else df).checkpoint()


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte array and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, count=len(column) + 1, offset=column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


_lean = False


def lean() -> None:
    """Let this process give large freed blocks back to the system: workers stay alive between tasks, and what they keep adds up."""
    global _lean
    if not _lean:
        _lean = True
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            libc = ctypes.CDLL("libc.so.6")
            libc.mallopt(-3, 1 << 20)  # blocks from 1 MB on are mapped by themselves
            libc.mallopt(-1, 8 << 20)  # and the heap's free end is cut at 8 MB
        except (OSError, AttributeError):
            pass  # another C library


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 20, rows: int = 2048) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a batch in stretches of about `most` bytes of text and at most `rows` rows, with the bytes and offsets.

    A row is never split, so a text longer than `most` is a stretch of its own.
    """
    lean()
    data, offsets = text_buffer(batch[text])
    lo = 0
    while lo < len(batch):
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1))
        o = offsets[lo : hi + 1]
        yield batch.slice(lo, hi - lo), data[o[0] : o[-1]], o - o[0]
        lo = hi


def fmix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK + 4096)
        run = np.full(size, base, U64)
        run[0] = 1
        have = _powers[base] = np.multiply.accumulate(run)
    return have[:n]


def byte_values(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return fmix((np.arange(1, 257, dtype=U64) + U64(seed * 1000)) * U64(0x9E3779B97F4A7C15))


VALUES = byte_values(1)
LOWER_VALUES = VALUES.copy()
LOWER_VALUES[65:91] = VALUES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def prefix_sums(data: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    """p with hash(data[a:b]) = (p[b] - p[a]) * base**a, modulo 2**64."""
    out = np.empty(len(data) + 1, U64)
    out[0] = 0
    np.cumsum(values[data] * powers(_INVERSE, len(data)), out=out[1:])
    return out


def span_hashes(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    raw = (p[b] - p[a]) * powers(_BASE, len(p))[a]
    return fmix(raw ^ ((b - a).astype(U64) * U64(0xD6E8FEB86659FD93)))


def _pieces(data: np.ndarray, offsets: np.ndarray, space: np.ndarray):
    """Byte ranges of about BLOCK that end at a row's end or, in a long row, at a space."""
    lo, end = int(offsets[0]), int(offsets[-1])
    while lo < end:
        hi = min(end, lo + BLOCK)
        if hi < end:
            row = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
            if row > lo:
                hi = row
            else:  # within one long row: on to its next space or end
                stop = int(offsets[np.searchsorted(offsets, hi, "right")])
                while hi < stop and not space[data[hi]]:
                    gap = np.flatnonzero(space[data[hi : min(stop, hi + BLOCK)]])
                    hi = hi + int(gap[0]) if len(gap) else min(stop, hi + BLOCK)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray = VALUES, space: np.ndarray = SPACE):
    """Words of all rows in order: start and end byte, row, 64-bit hash."""
    starts, ends, hashes = [], [], []
    for lo, hi in _pieces(data, offsets, space):
        part = data[lo:hi]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = ~space[part]
        first = inside[1:-1] & ~inside[:-2]
        last = inside[1:-1] & ~inside[2:]
        cuts = offsets[np.searchsorted(offsets, lo, "left") : np.searchsorted(offsets, hi, "right")] - lo
        at = cuts[cuts < len(part)]
        first[at] |= inside[1:-1][at]
        at = cuts[cuts > 0] - 1
        last[at] |= inside[1:-1][at]
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(span_hashes(prefix_sums(part, values), a, b))
        starts.append(a + lo)
        ends.append(b + lo)
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U64)
    start = np.concatenate(starts)
    return start, np.concatenate(ends), np.searchsorted(offsets, start, "right") - 1, np.concatenate(hashes)


def constants(k: int, seed: int) -> np.ndarray:
    return byte_values(seed)[:k] | U64(1) if k <= 256 else np.resize(byte_values(seed), k) * powers(_BASE, k) | U64(1)


def windows(hashes: np.ndarray, row: np.ndarray, k: int, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k words from here on, and whether they lie in one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, bool)
    out = np.zeros(n, U64)
    for j, c in enumerate(constants(k, seed)):
        out += hashes[j : j + n] * c
    return fmix(out), row[:n] == row[k - 1 :]


def bounds(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Where each row's items begin, and their end."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def runs(sorted_ids: np.ndarray, gap: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each maximal run whose members are at most gap apart."""
    if not len(sorted_ids):
        return sorted_ids, sorted_ids
    cut = np.flatnonzero(np.diff(sorted_ids) > gap)
    return sorted_ids[np.r_[0, cut + 1]], sorted_ids[np.r_[cut, len(sorted_ids) - 1]]


def delta(x: np.ndarray, kind) -> bytes:
    """Differences as bytes; the shuffle's compressor makes little of small ones."""
    x = x.astype(kind)
    return np.diff(x, prepend=x.dtype.type(0)).tobytes()


def undelta(raw: bytes, kind) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, kind), dtype=kind)
