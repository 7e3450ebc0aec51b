"""Fixity audit of WARC replicas by Merkle trees over ordered offset ranges. DataFrame functions only.

Each replica makes its tree by itself: records that begin in the same `range_bytes` bytes of a file make a lowest node, the hash of their list in the order of
offsets, and `fanout` neighbouring nodes make the next one, up to a root for each file. As nodes are ranges of offsets and not of
record numbers, a lost or added record changes its own branch alone. The audit compares the replicas' roots; only where they differ it looks at the
next nodes below, level by level, and at last at the records of the lowest nodes that differ. Records and nodes of branches that agree are never brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut_lineage

RECORD = "file string, offset long, length long, warc_type string, uri string, payload binary"


def warc_record(uri: Column, payload: Column) -> Column:
    """The bytes of a WARC/1.0 resource record; null counts as empty."""
    body = F.coalesce(payload.cast("binary"), F.lit(bytearray()))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(uri, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit(bytearray(b"\r\n\r\n")))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of uncompressed WARC files: file, offset and length of the whole record, type, uri, payload.

    A file is one task's work, as WARC files are of bounded size by custom (about 1 GB). What can't be read as a record up to the
    next `WARC/` line becomes a record of type `damaged`, so a later record is still found. An empty file has no records.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, raw in zip(batch["path"], batch["content"], strict=True):
                rows: list[tuple] = []
                for row in warc_records(raw.as_py() or b""):
                    rows.append((file.as_py(), *row))
                    if len(rows) == 256:
                        yield made(rows)
                        rows = []
                yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["file", "offset", "length", "warc_type", "uri", "payload"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(parse, RECORD)


def warc_records(data: bytes) -> Iterator[tuple[int, int, str, str, bytes]]:
    """Offset, length, type, uri and payload of each record."""
    at, end = 0, len(data)
    while at < end:
        head_end = data.find(b"\r\n\r\n", at)
        fields = {}
        if data.startswith(b"WARC/", at) and head_end >= 0:
            for line in data[at:head_end].split(b"\r\n")[1:]:
                name, _, value = line.partition(b":")
                fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
        size = fields.get(b"content-length", "")
        stop = head_end + 4 + int(size) + 4 if size.isdigit() else -1
        if stop < 0 or data[stop - 4 : stop] != b"\r\n\r\n":
            following = data.find(b"\r\n\r\nWARC/", at + 1)
            stop = end if following < 0 else following + 4
            yield at, stop - at, "damaged", "", data[at:stop]
        else:
            yield at, stop - at, fields.get(b"warc-type", ""), fields.get(b"warc-target-uri", ""), data[head_end + 4 : stop - 4]
        at = stop


def record_digests(df: DataFrame, file: str, offset: str, content: str) -> DataFrame:
    """file, offset, length, digest (of the record's bytes) of a replica's records."""
    body = F.coalesce(F.col(content).cast("binary"), F.lit(bytearray()))
    return df.select(F.col(file).cast("string").alias("file"), F.col(offset).cast("long").alias("offset"), F.octet_length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest"))


#: Records without an offset have no place in their file. They make a tree of their own, in which their digest gives the place, one of so many.
UNPLACED = 1 << 40


def _hash(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def manifest(records: DataFrame) -> DataFrame:
    """A replica's records (file, offset, length, digest), each different one once with its number of copies; placed: whether it has an offset; at: its place in the tree."""
    counted = records.select(F.coalesce("file", F.lit("")).alias("file"), "offset", "length", "digest").groupBy("file", "offset", "length", "digest").agg(F.count(F.lit(1)).alias("copies"))
    spread = F.pmod(F.xxhash64("length", "digest"), F.lit(UNPLACED))
    return counted.withColumn("placed", F.col("offset").isNotNull()).withColumn("at", F.coalesce("offset", spread))


NODE = ["file", "placed", "node"]


def merkle_tree(records: DataFrame, range_bytes: int = 1 << 20, fanout: int = 16) -> list[DataFrame]:
    """The tree of one replica's manifest: its levels, lowest first, each with file, placed, node (number within the level) and hash. Files' roots are the nodes 0 of
    the last level; files that need fewer levels repeat theirs upwards."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "length", "digest", "copies")))
    listed = F.transform(ordered, lambda x: F.concat_ws(":", x["at"], x["length"], x["digest"], x["copies"]))
    levels = [cut_lineage(records.groupBy("file", "placed", F.floor(F.col("at") / F.lit(range_bytes)).alias("node")).agg(_hash(F.lit("0"), listed).alias("hash")))]
    reach = levels[0].agg(F.max("node")).first()[0] or 0
    below = F.array_sort(F.collect_list(F.struct("node", "hash")))
    while reach > 0:
        up = levels[-1].groupBy("file", "placed", F.floor(F.col("node") / F.lit(fanout)).alias("up"))
        levels.append(cut_lineage(up.agg(_parent(below).alias("hash")).select("file", "placed", F.col("up").alias("node"), "hash"), narrow=True))
        reach //= fanout
    return levels


def _parent(children: Column) -> Column:
    """Hash of a list of (node, hash)."""
    return _hash(F.lit("1"), F.transform(children, lambda x: F.concat_ws(":", x["node"], x["hash"])))


def grown(tree: list[DataFrame], levels: int) -> list[DataFrame]:
    """A tree of more levels: its roots are repeated as the nodes above, by the same rule, so equal files stay equal."""
    tree = list(tree)
    while len(tree) < levels:
        tree.append(tree[-1].withColumn("hash", _parent(F.array(F.struct("node", "hash")))))
    return tree


def differing_ranges(tree_a: list[DataFrame], tree_b: list[DataFrame], fanout: int = 16) -> DataFrame:
    """The lowest nodes (file, placed, node) below roots that differ, reached through nodes that differ alone. A level's nodes that differ are settled before the next one is read."""
    levels, differ = max(len(tree_a), len(tree_b)), None
    for a, b in reversed(list(zip(grown(tree_a, levels), grown(tree_b, levels), strict=True))):
        a, b = (t.select(*NODE, F.col("hash").alias(n)) for t, n in ((a, "a"), (b, "b")))
        if differ is not None:
            up = differ.select(F.col("file").alias("_file"), F.col("placed").alias("_placed"), F.col("node").alias("_node"))
            a, b = (t.join(up, (t["file"] == F.col("_file")) & (t["placed"] == F.col("_placed")) & (F.floor(t["node"] / F.lit(fanout)) == F.col("_node")), "left_semi") for t in (a, b))
        differ = cut_lineage(a.join(b, NODE, "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select(*NODE), narrow=True)
    return differ


def audit(replica_a: DataFrame, replica_b: DataFrame, range_bytes: int = 1 << 20, fanout: int = 16) -> DataFrame:
    """Records in which two replicas, as record_digests gives them, differ.

    Returns file, offset, status (changed, missing: only in the first, extra: only in the second), a_length, a_digest, b_length,
    b_digest, a_copies, b_copies (of the records that differ). A null file counts as file '', and null offsets, which are reported as -1, are told apart from all others. A record that a replica lists
    twice differs from one listed once. If several records share an offset the least digest of those that differ is reported for each side. Records of any length are hashed where
    they stand. Empty replicas agree; an empty one against a full one has every record missing. Other columns are ignored. A lowest node lists at most
    the different records of range_bytes starts, and any other at most fanout children, so no node grows with a file.
    """
    records = [cut_lineage(manifest(r)) for r in (replica_a, replica_b)]
    bad = differing_ranges(*(merkle_tree(r, range_bytes, fanout) for r in records), fanout)
    near = bad.select(F.col("file").alias("_file"), F.col("placed").alias("_placed"), F.col("node").alias("_node"))
    sides = []
    for r, a in zip(records, (1, 0), strict=True):
        inside = (F.col("file") == F.col("_file")) & (F.col("placed") == F.col("_placed")) & (F.floor(F.col("at") / F.lit(range_bytes)) == F.col("_node"))
        own = r.join(near, inside, "left_semi")
        sides.append(own.select("file", F.coalesce("offset", F.lit(-1).cast("long")).alias("offset"), "placed", "length", "digest", (F.col("copies") * a).alias("a"), (F.col("copies") * (1 - a)).alias("b")))
    both = sides[0].union(sides[1]).groupBy("file", "offset", "placed", "length", "digest").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter("a <> b")
    side = lambda n, other: F.min(F.when(F.col(n) > F.col(other), F.struct("digest", "length")))
    found = both.groupBy("file", "offset", "placed").agg(side("a", "b").alias("x"), side("b", "a").alias("y"), F.sum("a").alias("a_copies"), F.sum("b").alias("b_copies"))
    status = F.when(F.col("x").isNull(), "extra").when(F.col("y").isNull(), "missing").otherwise("changed")
    return found.select("file", "offset", status.alias("status"), F.col("x.length").alias("a_length"), F.col("x.digest").alias("a_digest"), F.col("y.length").alias("b_length"), F.col("y.digest").alias("b_digest"), "a_copies", "b_copies")
