"""Bring equal fingerprints of all documents together and send what was found back to the documents.

A map task packs its entries into one row for each hash bucket: arrays of hashes, documents and
positions as bytes. Before that it settles what equal entries of its own can tell, so a fingerprint
that any share of the corpus holds reaches its bucket once from each task at most. A reduce task sorts its
bucket and answers; the answers of a document are then merged to one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import U64, Buckets, delta, fmix, lean, undelta

ROW = "bucket int, kind int, h binary, g binary, d binary, p binary, t binary"
NAMES = ["bucket", "kind", "h", "g", "d", "p", "t"]
#: The kind of rows that need no lookup: answers that a map task found by itself.
ANSWER = 9
#: Entries that a map task holds before it packs them: at least, and at most.
FLUSH = 1 << 19, 1 << 22


@dataclass
class Entries:
    """Columns of equal length: hash, further hash, document, position, tag."""

    h: np.ndarray
    d: np.ndarray
    p: np.ndarray
    t: np.ndarray
    g: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))

    def __len__(self) -> int:
        return len(self.d)

    def __getitem__(self, at: np.ndarray) -> Entries:
        return Entries(self.h[at] if len(self.h) else self.h, self.d[at], self.p[at], self.t[at], self.g[at] if len(self.g) else self.g)

    @staticmethod
    def joined(parts: list[Entries]) -> Entries:
        return Entries(*(np.concatenate([getattr(x, c) for x in parts]) for c in ("h", "d", "p", "t", "g")))


def answers(d: np.ndarray, p: np.ndarray, t: np.ndarray) -> Entries:
    return Entries(np.zeros(0, U64), d, p, t)


def doc_bucket(d: np.ndarray, buckets: Buckets) -> np.ndarray:
    return buckets.of(fmix(d.astype(np.int64).view(U64) + U64(77)))


def packed(kind: int, bucket: np.ndarray, e: Entries, width: int = 8) -> pa.RecordBatch | None:
    """One row for each bucket that has entries; hashes keep their lowest `width` bytes."""
    if not len(e):
        return None
    order = np.lexsort((e.p, e.d, bucket))
    bucket, e = bucket[order], e[order]
    cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
    short = lambda x: np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width]).reshape(-1) if len(x) else x
    h, g = short(e.h), short(e.g)
    cols: list[list] = [[], [], [], [], []]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        for col, x in zip(cols, (h[a * width : b * width].tobytes(), g[a * width : b * width].tobytes(), delta(e.d[a:b], np.int64), delta(e.p[a:b], np.uint32), e.t[a:b].astype(np.uint16).tobytes()), strict=True):
            col.append(x)
    n = len(cuts) - 1
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), pa.array(np.full(n, kind, np.int32)), *(pa.array(c, pa.binary()) for c in cols)], names=NAMES)


def unpacked(rows: pa.Table, width: int = 8) -> Entries:
    def wide(column: str) -> np.ndarray:
        raw = np.frombuffer(b"".join(rows[column].to_pylist()), np.uint8).reshape(-1, width)
        out = np.zeros((len(raw), 8), np.uint8)
        out[:, :width] = raw
        return out.reshape(-1).view(U64)

    join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
    return Entries(
        wide("h"),
        join([undelta(x, np.int64) for x in rows["d"].to_pylist()], np.int64),
        join([undelta(x, np.uint32) for x in rows["p"].to_pylist()], np.uint32).astype(np.int64),
        np.frombuffer(b"".join(rows["t"].to_pylist()), np.uint16),
        wide("g"),
    )


def flush_at(buckets: Buckets) -> int:
    """Enough entries for rows of some length in each bucket, within the bounds of FLUSH."""
    return int(np.clip(64 * buckets.n, *FLUSH))


class Packer:
    """Collects the parts of a task's slices and packs them when there are enough."""

    def __init__(self, most: int):
        self.most = most
        self.parts: list[Entries] = []
        self.n = 0

    def add(self, e: Entries) -> bool:
        if len(e):
            self.parts.append(e)
            self.n += len(e)
        return self.n >= self.most

    def take(self) -> Entries | None:
        out = Entries.joined(self.parts) if self.parts else None
        self.parts, self.n = [], 0
        return out


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by keys (the first is the class), and for each item in that order: the class's first place and its size."""
    order = np.lexsort(keys[::-1])
    k = keys[0][order]
    new = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(k)])
    which = np.cumsum(new) - 1
    return order, first[which] if len(k) else first, size[which] if len(k) else size


def looked_up(emitted: DataFrame, reduce: Callable[[dict[int, Entries]], Entries], buckets: Buckets, widths: dict[int, int]) -> DataFrame:
    """Send entries to their buckets, and each answer on to its document's bucket."""

    def settle(rows: pa.Table) -> pa.Table:
        lean()
        kinds = rows["kind"].to_numpy()
        own = {int(k): unpacked(rows.filter(pa.array(kinds == k)), widths.get(int(k), 8)) for k in np.unique(kinds)}
        parts = [x for x in (own.pop(ANSWER, None), reduce(own) if own else None) if x is not None and len(x)]
        found = Entries.joined([answers(x.d, x.p, x.t) for x in parts]) if parts else None
        out = packed(ANSWER, doc_bucket(found.d, buckets), found) if found is not None else None
        return pa.Table.from_batches([out] if out is not None else [], pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in NAMES[2:])]))

    return emitted.groupBy("bucket").applyInArrow(settle, ROW)


def by_document(found: DataFrame) -> DataFrame:
    """One row per document: doc, and its answers' positions and tags as bytes; equal positions are merged by OR."""

    def merge(rows: pa.Table) -> pa.Table:
        lean()
        e = unpacked(rows)
        order = np.lexsort((e.p, e.d))
        d, p, t = e.d[order], e.p[order], e.t[order]
        if len(d):
            new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (p[1:] != p[:-1])])
            d, p, t = d[new], p[new], np.bitwise_or.reduceat(t, new)
        cuts = np.r_[0, np.flatnonzero(np.diff(d)) + 1, len(d)] if len(d) else np.zeros(1, np.int64)
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.table([pa.array(d[cuts[:-1]]), pa.array([delta(p[a:b], np.uint32) for a, b in spans], pa.binary()), pa.array([t[a:b].tobytes() for a, b in spans], pa.binary())], names=["doc", "p", "t"])

    return found.groupBy("bucket").applyInArrow(merge, "doc long, p binary, t binary")


def marked(docs: DataFrame, found: DataFrame, doc_id: str) -> DataFrame:
    """Documents with their answers in columns p and t, null for those without any.

    The join is a left one, as an inner one would put a filter on the documents: so their shuffle by doc_id is the same at each call, and Spark reuses it.
    """
    return docs.join(found.hint("shuffle_hash"), F.col(doc_id) == F.col("doc"), "left").drop("doc")


def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of marked documents that have an answer."""
    for batch in batches:
        own = batch.filter(batch["p"].is_valid())
        if len(own):
            yield own


def positions(value: bytes | None) -> np.ndarray:
    return undelta(value, np.uint32).astype(np.int64) if value else np.zeros(0, np.int64)


def tags(value: bytes | None) -> np.ndarray:
    return np.frombuffer(value or b"", np.uint16)


def covered_runs(starts: np.ndarray, lengths: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Union of [start, start + length) as maximal runs; starts are sorted."""
    if not len(starts):
        return starts, starts
    ends = np.maximum.accumulate(starts + lengths)
    new = np.r_[True, starts[1:] > ends[:-1]]
    at = np.flatnonzero(new)
    return starts[at], ends[np.r_[at[1:] - 1, len(starts) - 1]]


