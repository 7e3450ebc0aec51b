"""Verdicts on finished output. Nothing checked is UNPROVEN, never a pass."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import detect
from ..session import cut_lineage


def verdict(checked: Column, violations: Column) -> Column:
    return F.when(violations > 0, "FAIL").when(checked > 0, "PASS").otherwise("UNPROVEN")


def gate(name: str, df: DataFrame, violation: Column) -> DataFrame:
    """One row: gate, checked, violations, verdict."""
    counted = df.agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.coalesce(violation, F.lit(True))).alias("violations"))
    return counted.select(F.lit(name).alias("gate"), "checked", "violations", verdict(F.col("checked"), F.col("violations")).alias("verdict"))


def counted(name: str, counts: DataFrame) -> DataFrame:
    """One row: gate, checked, violations, verdict; from a row of the two counts."""
    return counts.select(F.lit(name).alias("gate"), F.col("checked").cast("long").alias("checked"), F.col("violations").cast("long").alias("violations"), verdict(F.col("checked"), F.col("violations")).alias("verdict"))


def unproven(df: DataFrame, name: str) -> DataFrame:
    """The row of a gate that couldn't be run, beside a row of df."""
    return counted(name, df.agg(F.lit(0).alias("checked"), F.lit(0).alias("violations")))


def examples(violations: DataFrame, order: list[str], most: int = 10) -> DataFrame:
    """The first violations, for a report."""
    return violations.orderBy(*order).limit(most)


def needle_hits(texts: DataFrame, doc: str, text: str, needles: DataFrame, value: str, mode: str = "anchored", least: int = 5, at_once: int = 20_000) -> DataFrame:
    """Documents in which a needle survives: value, doc, context (of the first hit, 40 characters on each side; null in loose and upper mode).

    One automaton of the needles reads each text once, where it stands, so nothing is shuffled and no pairs are made;
    needles come in passes of `at_once`, which are broadcast, so what tasks hold is bounded. Loose search ignores all but letters and digits; anchored search then asks that a hit
    begins and ends at other characters and has at most three of them between its runs; upper search looks for the string itself in any case of letters. Needles with fewer
    than `least` letters and digits aren't searched.

    More than `at_once` needles of an upper search take no passes, as each would read all texts again: they are met by a join (`_ends_met`).
    """
    fold = str.upper if mode == "upper" else _canonical
    spark = texts.sparkSession
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("doc", texts.schema[doc].dataType), T.StructField("context", T.StringType())])
    out = spark.createDataFrame([], schema)
    wanted = needles.select(F.col(value).cast("string").alias("v")).filter(detect.is_searchable(F.col("v"), least)).distinct()
    if mode == "upper" and wanted.limit(at_once + 1).count() > at_once:
        return _ends_met(texts, doc, text, wanted).select("value", "doc", F.lit(None).cast("string").alias("context"))
    listed = wanted.orderBy("v").toLocalIterator()

    def found(batch: pa.RecordBatch, hits: list, at: list, contexts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hits, pa.string()), batch[doc].take(pa.array(at, pa.int64())), pa.array(contexts, pa.string())], names=["value", "doc", "context"])

    while part := [r.v for r in islice(listed, at_once)]:
        shared = spark.sparkContext.broadcast(part)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton, values, patterns = ahocorasick.Automaton(), {}, {}
            for v in shared.value:
                values.setdefault(fold(v), []).append(v)
            for key, own in values.items():
                automaton.add_word(key, own)
            automaton.make_automaton()
            for batch in batches:
                hits, at, contexts = [], [], []
                for i in range(batch.num_rows):
                    t = batch[text][i].as_py()  # a batch can have 64 MB; one text at a time is taken out of it
                    if len(hits) >= FLUSH:
                        yield found(batch, hits, at, contexts)
                        hits, at, contexts = [], [], []
                    for v in dict.fromkeys(v for _, own in automaton.iter(fold(t or "")) for v in own):
                        context = None
                        if mode == "anchored":
                            if v not in patterns:
                                patterns[v] = _anchored(v)
                            if not (m := patterns[v].search(t)):
                                continue
                            context = t[max(0, m.start() - 40) : m.end() + 40].replace("\n", " ")
                        hits.append(v)
                        at.append(i)
                        contexts.append(context)
                yield found(batch, hits, at, contexts)

        out = out.union(texts.select(doc, text).mapInArrow(search, schema))
    return out


#: Hits that a task holds before it gives them back.
FLUSH = 2000
#: Bits of the filter of needles' ends, two for each needle; the longest end that is hashed; characters hashed at once.
FILTER_BITS, LONGEST_END, HASHED = 1 << 27, 32, 1 << 18


def _window_hashes(codes: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """k and the hash of the k characters from each place on, for k = 1, 2, 4 up to most."""
    k, h, base = 1, codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019), 0xD6E8FEB86659FD93
    while True:
        yield k, h
        k, h, base = 2 * k, h[:-k] * np.uint64(base) + h[k:], base * base % (1 << 64)
        if k > most or not len(h):
            return


def _end_class(size: int) -> int:
    return min(LONGEST_END, 1 << (size.bit_length() - 1))


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(37), (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(37)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _ends_met(texts: DataFrame, doc: str, text: str, wanted: DataFrame) -> DataFrame:
    """value, doc of any number of needles (v) that occur in any case of letters, with one reading of the texts.

    A needle is known by a hash of its last 1, 2, 4 .. 32 characters, the longest of these that it has. A filter of fixed size with all of them is broadcast; places of texts
    that pass it go, with the characters before them, to a join on the hash, which compares whole needles.
    """
    spark = texts.sparkSession

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["v"].to_pylist()
            keys = [v.upper() for v in values]
            last = [[h for k, h in _window_hashes(_codes(key[-_end_class(len(key)) :]), LONGEST_END)][-1][-1] for key in keys]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(keys, pa.string()), pa.array([_end_class(len(key)) for key in keys], pa.int32()), pa.array(np.array(last, np.uint64).view(np.int64)), pa.array([len(key) for key in keys], pa.int32())], names=["value", "key", "k", "h", "size"])

    known = cut_lineage(wanted.mapInArrow(ends, "value string, key string, k int, h long, size int"))
    filled = np.zeros(FILTER_BITS >> 3, np.uint8)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(np.concatenate(_bits(batch["h"].to_numpy().view(np.uint64)))).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([places.tobytes()], pa.binary())], names=["places"])

    for r in known.select("h").mapInArrow(marks, "places binary").toLocalIterator():
        places = np.frombuffer(r.places, np.uint32)
        np.bitwise_or.at(filled, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
    longest = known.agg(F.max("size")).first()[0]
    classes = {r.k for r in known.select("k").distinct().collect()}  # six at most
    shared = spark.sparkContext.broadcast(filled.tobytes())
    schema = T.StructType([T.StructField("doc", texts.schema[doc].dataType), T.StructField("k", T.IntegerType()), T.StructField("h", T.LongType()), T.StructField("tail", T.StringType())])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)

        def passed(batch: pa.RecordBatch, rows: list[int], keys: list[str]) -> Iterator[pa.RecordBatch]:
            whole = "".join(keys)
            sizes = np.array([len(key) for key in keys], np.int64)
            starts = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(keys)), sizes)
            for k, h in _window_hashes(_codes(whole), max(classes)):
                if k not in classes:
                    continue
                one, two = _bits(h)
                at = np.flatnonzero((bits[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8) & bits[two >> np.uint64(3)] >> (two & np.uint64(7)).astype(np.uint8)) & 1)
                at = at[owner[at] == owner[at + k - 1]]
                for a in range(0, len(at), FLUSH):
                    some = at[a : a + FLUSH]
                    tails = [whole[max(s, p + k - longest) : p + k] for p, s in zip(some.tolist(), starts[owner[some]].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch[doc].take(pa.array([rows[i] for i in owner[some].tolist()], pa.int64())), pa.array(np.full(len(some), k, np.int32)), pa.array(h[some].view(np.int64)), pa.array(tails, pa.string())], names=["doc", "k", "h", "tail"])

        for batch in batches:
            rows, keys, size = [], [], 0
            for i in range(batch.num_rows):
                rows.append(i)
                keys.append((batch[text][i].as_py() or "").upper())
                size += len(keys[-1])
                if size >= HASHED or i == batch.num_rows - 1:
                    yield from passed(batch, rows, keys)
                    rows, keys, size = [], [], 0

    met = texts.select(doc, text).mapInArrow(places, schema).join(known, ["k", "h"])
    return met.filter(F.col("tail").endswith(F.col("key"))).select("value", "doc").distinct()


def _canonical(value: str) -> str:
    return re.sub("[^a-z0-9]", "", value.lower())


def _anchored(value: str) -> re.Pattern:
    return re.compile("(?i)(?<![A-Za-z0-9])" + "[^A-Za-z0-9]{0,3}".join(re.findall("[A-Za-z0-9]+", value)) + "(?![A-Za-z0-9])")


def search_report(hits: DataFrame) -> DataFrame:
    """value, files, first, context: each value that is still there, in how many files, and the first with what stands around it."""
    return hits.groupBy("value").agg(F.count_distinct("doc").alias("files"), F.min("doc").alias("first"), F.min_by("context", F.struct("doc", "context")).alias("context"))


def with_paths(texts: DataFrame, path: str, text: str) -> DataFrame:
    """texts and, as further rows, their paths, which are searched like texts."""
    return texts.select(F.col(path).alias("path"), F.col(text).alias("text")).union(texts.select(F.col(path), F.col(path)))


def output_gate(texts: DataFrame, hits: DataFrame) -> DataFrame:
    return counted("output search", texts.agg(F.count(F.lit(1)).alias("checked")).crossJoin(hits.agg(F.count_distinct("value").alias("violations"))))  # one row each


def image_gate(read: DataFrame, needles: DataFrame, value: str) -> DataFrame:
    """Verdicts on texts that were read in images (image, text, photo): identifiers in screenshots; photographs, which no reader can vouch for, are never proven."""
    shots = read.filter("not photo")
    hits = needle_hits(shots, "image", "text", needles, value, mode="loose")
    found = shots.agg(F.count(F.lit(1)).alias("checked")).crossJoin(hits.agg(F.count_distinct("doc").alias("violations")))
    return counted("screenshots", found).union(unproven(read, "photographs"))


def clone_gate(repos: DataFrame) -> DataFrame:
    """repos: repo, refs, commits. A clone without either is incomplete."""
    return gate("clones", repos, (F.col("refs") == 0) | (F.col("commits") == 0))


def package_status(repos: DataFrame) -> DataFrame:
    """repos (repo, residual, remotes, commits, authors) with their status: what must be looked at before it leaves."""
    bad = (F.col("residual") != 0) | (F.col("remotes") != 0) | (F.col("commits") == 0)
    return repos.withColumn("status", F.when(F.coalesce(bad, F.lit(True)), "REVIEW").otherwise("OK"))


def findings_gate(name: str, scanned: DataFrame, findings: DataFrame) -> DataFrame:
    """Fails on any finding (with a count n); nothing scanned proves nothing."""
    total = findings.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
    return counted(name, scanned.agg(F.count(F.lit(1)).alias("checked")).crossJoin(total))  # one row each


def delivery_gates(names: DataFrame, texts: DataFrame, counts: DataFrame, paths: DataFrame, syntax: DataFrame | None = None) -> DataFrame:
    """The four axes of a delivery: names in texts (n), commit counts (status), names in paths (n), and syntax (violation), which stays unproven without a parser's results."""
    same = gate("integrity", counts, F.col("status") != "equal")
    parsed = gate("syntax", syntax, F.col("violation")) if syntax is not None else unproven(texts, "syntax")
    return findings_gate("names", texts, names).union(same).union(parsed).union(findings_gate("paths", texts, paths))


def commit_counts(source: DataFrame, delivered: DataFrame) -> DataFrame:
    """Repositories whose counts (repo, commits) differ, or that one side lacks."""
    both = source.withColumnRenamed("commits", "source_commits").join(delivered.withColumnRenamed("commits", "delivered_commits"), "repo", "full")
    return both.withColumn("status", F.when(F.col("source_commits").isNull(), "not in source").when(F.col("delivered_commits").isNull(), "not delivered").when(F.col("source_commits") != F.col("delivered_commits"), "changed").otherwise("equal"))
