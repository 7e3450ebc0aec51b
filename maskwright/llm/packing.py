"""Best-fit decreasing packing of tokenised documents into sequences of a fixed length.

Only the number of pieces of each length matters to best fit, so the packing is planned on the
driver over a histogram of at most `capacity` rows, whatever the input's size: a segment tree indexed by
remaining capacity holds groups of open sequences and gives the tightest that still takes a length.
Pieces then find their place by their rank among the pieces of the same length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import cut_lineage, partitions

#: What a worker keeps between tasks: an encoder for each vocabulary file.
_encoders: dict[str, ByteEncoder] = {}
#: The byte-level pre-tokenizer's pattern, as the vocabulary's public description gives it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteEncoder:
    """Ids of a byte-level BPE vocabulary file, with a memo of units.

    No token of this pre-tokenizer goes from a non-space into a space, so a text is cut before each
    space that follows a non-space, and each cut unit is encoded once and then looked up.
    """

    most_units = 400_000

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            file = json.load(f)
        vocabulary = file["model"]["vocab"]
        # the file writes bytes as printable characters
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(back[c] for c in token): i for token, i in vocabulary.items() if all(c in back for c in token)}
        #: The file's added tokens: their strings in a text are these ids, as in the library's default.
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        for token in self.added:
            ranks.pop(token.encode(), None)
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.units: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        if self.cuts and any(t in text for t in self.added):
            return np.concatenate([np.array([self.added[x]], np.uint32) if x in self.added else self._plain(x) for x in self.cuts.split(text)])
        return self._plain(text)

    def _plain(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        units, memo = text.split(" "), self.units
        if len(memo) > self.most_units:
            memo.clear()
        # a run of several spaces is no unit: its parts belong together
        if "" in units[1:] or any(c in text for c in ODD_SPACES):
            return np.array(self.encode(text), np.uint32)
        out = [memo.get(u) for u in units]
        first = units[0]
        for i, found in enumerate(out):
            if found is None:
                unit = units[i]
                found = memo[unit] = np.array(self.encode(" " + unit), np.uint32).tobytes()
                out[i] = found
        out[0] = np.array(self.encode(first), np.uint32).tobytes()
        return np.frombuffer(b"".join(out), np.uint32)


#: White space other than the space that may stand before one; such texts are encoded whole.
ODD_SPACES = tuple(f"{c} " for c in map(chr, range(0x3001)) if c.isspace() and c != " ")


def encoder(path: str) -> ByteEncoder:
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


class CapacityTree:
    """A segment tree over remaining capacities 0 to n: which are in use, and the least one that is not below a length."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.used = [False] * (2 * self.size)

    def set(self, at: int, used: bool) -> None:
        at += self.size
        self.used[at] = used
        while at > 1:
            at //= 2
            self.used[at] = self.used[2 * at] or self.used[2 * at + 1]

    def least(self, low: int) -> int | None:
        """The least used capacity of at least `low`."""
        at = low + self.size
        if self.used[at]:
            return low
        while at > 1:  # up, until a used node lies to the right
            if at % 2 == 0 and self.used[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.size:
            at = 2 * at if self.used[2 * at] else 2 * at + 1
        return at - self.size


@dataclass(frozen=True)
class Placement:
    """Pieces of one length with ranks from `first` on go to sequences from `sequence` on, `each` to a sequence, from offset `offset`."""

    length: int
    first: int
    last: int
    sequence: int
    each: int
    offset: int


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[Placement]:
    """Best-fit decreasing for counts[length] pieces of each length; equal pieces and equally full sequences are handled at once.

    A sequence that takes a piece and still fits another of that length is then the tightest, so it
    takes as many as fit before the next one is touched.
    """
    out: list[Placement] = []
    tree, free = CapacityTree(capacity), {}  # free: remaining capacity -> [(first sequence, number)]

    def put(remaining: int, start: int, n: int) -> None:
        if remaining and n:
            free.setdefault(remaining, []).append((start, n))
            tree.set(remaining, True)

    made = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.least(length)
            if room is None:
                room, each = capacity, capacity // length
                n = -(-left // each)
                start, made = made, made + n
            else:
                each = room // length
                start, n = free[room].pop()
                if not free[room]:
                    del free[room]
                    tree.set(room, False)
            full = min(n, left // each)
            if full:
                out.append(Placement(length, rank, rank + full * each, start, each, capacity - room))
                put(room - each * length, start, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # the last one takes what is left
                out.append(Placement(length, rank, rank + left, start + full, left, capacity - room))
                put(room - left * length, start + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < n:
                put(room, start + full, n - full)
    return out


PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


def pieces(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Each document's ids and then `end_id`, cut into full windows and a rest: one row per piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        for batch in batches:
            keys, rows, ids = [], [], []
            for i, (key, value) in enumerate(zip(batch[doc_id], batch[text], strict=True)):
                own = np.append(encode(value.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(own), capacity):
                    part = own[start : start + capacity]
                    keys.append(key.as_py())
                    rows.append((start, len(part), zlib.crc32(part.tobytes()), len(own)))
                    if keep_ids:
                        ids.append(part.astype(np.int32))
                if len(rows) >= 4096 and (keep_ids or i + 1 == len(batch)):
                    yield made(batch, keys, rows, ids)
                    keys, rows, ids = [], [], []
            yield made(batch, keys, rows, ids)

    def made(batch: pa.RecordBatch, keys: list, rows: list, ids: list) -> pa.RecordBatch:
        values = np.array(rows, np.int64).reshape(-1, 4)
        arrays = [pa.array(keys, batch.schema.field(doc_id).type), *(pa.array(x) for x in values.T)]
        names = [doc_id, "start", "length", "ids_crc32", "doc_tokens"]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.list_(pa.int32()))] if keep_ids else arrays, names=[*names, "ids"] if keep_ids else names)

    schema = T.StructType([df.schema[doc_id], *T._parse_datatype_string(PIECE).fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else [])])
    return df.select(doc_id, text).mapInArrow(cut, schema)


def pack(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens by best-fit decreasing.

    Returns one row per piece: doc_id, start, length, ids_crc32 (of the little-endian unsigned 32-bit ids),
    doc_tokens, sequence_id, offset, and with keep_ids the piece's ids. A null or empty text is the one token
    `end_id`; repeated rows and ties get pieces of their own; an empty table gives no rows; other columns are
    ignored. `tokenizer` is the path of a byte-level BPE file that executors can read.
    """
    spark = df.sparkSession
    cut = cut_lineage(pieces(df, tokenizer, doc_id, text, capacity, end_id, keep_ids))
    parts = partitions(spark)
    # rank of a piece among those of its length: rows of one length are dealt over the parts, and the
    # parts' counts (capacity x parts rows at most) give what lies before
    dealt = cut.withColumn("_part", F.pmod(F.xxhash64(doc_id, "start", "ids_crc32"), F.lit(parts)))
    counts = dealt.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part")
    counts = cut_lineage(counts.withColumn("_before", F.sum("_n").over(before) - F.col("_n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # capacity rows at most
    plan = plan_best_fit(histogram, capacity)
    inside = Window.partitionBy("length", "_part").orderBy(doc_id, "start", "ids_crc32")
    ranked = (
        dealt.withColumn("_place", F.row_number().over(inside) - 1)
        .join(F.broadcast(counts.select("length", "_part", "_before")) if parts * capacity <= 1 << 18 else counts.select("length", "_part", "_before"), ["length", "_part"])
        .withColumn("_rank", F.col("_before") + F.col("_place"))
        .drop("_part", "_before", "_place")
    )
    # the plan's size depends on the capacity alone
    by_length: dict[int, list[Placement]] = {}
    for p in plan:
        by_length.setdefault(p.length, []).append(p)
    table = {n: np.array([(p.first, p.sequence, p.each, p.offset) for p in sorted(x, key=lambda p: p.first)], np.int64) for n, x in by_length.items()}
    shared = spark.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for n in np.unique(length):
                own, rows = np.flatnonzero(length == n), plan[int(n)]
                first, start, each, base = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1].T
                sequence[own] = start + (rank[own] - first) // each
                offset[own] = base + (rank[own] - first) % each * n
            kept = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    kept = [f for f in ranked.schema.fields if f.name != "_rank"]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*(f.name for f in kept), "_rank").mapInArrow(place, schema)
