"""Remove passages that repeat from documents with smaller ids, found by difference-cover anchors.

A difference cover of a period v holds, for any two positions, a shift below v that takes both
into the cover. So two equal windows of `window` words share an equal run of window - v + 1 words that begins at cover positions
of both documents: only those runs are hashed and shuffled. Documents whose
anchors recur extend them to all full windows around, and these are compared by their whole fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _exchange as X
from ._common import U64, Buckets, bounds, hash_buckets, lean, slices, windows, words

#: Perfect difference covers by period: each non-zero difference occurs.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def _ids(batch: pa.RecordBatch, doc_id: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and whether each is known; rows without an id take no part."""
    column = batch[doc_id]
    return column.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def _bucket(h: np.ndarray, buckets: Buckets) -> np.ndarray:
    return buckets.of(h >> U64(32))


def _anchor_rows(docs: DataFrame, doc_id: str, text: str, window: int, period: int, buckets: Buckets, flush_at: int) -> DataFrame:
    cover = np.zeros(period, bool)
    cover[list(COVERS[period])] = True
    k = window - period + 1

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = X.Packer(flush_at)

        def flush() -> Iterator[pa.RecordBatch]:
            e = packer.take()
            if e is None:
                return
            order, first, size = X.grouped(e.h)
            e, alone, lead = e[order], size == 1, first == np.arange(len(order))
            sent = e[lead]
            sent.t = (~alone[lead]).astype(np.uint16)  # known already: no answer needed
            yield from filter(None, (X.packed(0, _bucket(sent.h, buckets), sent, 4), X.packed(X.ANSWER, X.doc_bucket(e.d[~alone], buckets), X.answers(e.d[~alone], e.p[~alone], e.t[~alone]))))

        for batch in batches:
            for part, data, offsets in slices(batch, text):
                _, _, row, h = words(data, offsets)
                ids, known = _ids(part, doc_id)
                begin = bounds(row, len(part))
                place = np.arange(len(row)) - begin[row]
                key, whole = windows(h, row, k)
                n = len(key)
                ok = whole & cover[place[:n] % period] & known[row[:n]] & (np.diff(begin)[row[:n]] >= window)
                at = np.flatnonzero(ok)
                if packer.add(X.Entries(key[at], ids[row[at]], place[at], np.zeros(len(at), np.uint16))):
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(emit, X.ROW)


def _settle_anchors(own: dict[int, X.Entries]) -> X.Entries:
    e = own[0]
    order, _, size = X.grouped(e.h)
    e = e[order][(size > 1) & (e.t[order] == 0)]
    return X.answers(e.d, e.p, np.zeros(len(e), np.uint16))


def _window_rows(docs: DataFrame, doc_id: str, text: str, window: int, period: int, buckets: Buckets, flush_at: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = X.Packer(flush_at)

        def flush() -> Iterator[pa.RecordBatch]:
            e = packer.take()
            if e is None:
                return
            order, first, _ = X.grouped(e.h, e.d, e.p)
            e = e[order]
            later = e.d > e.d[first]
            sent, found = e[~later], e[later]
            yield from filter(None, (X.packed(0, buckets.of(sent.g), X.Entries(sent.h, sent.d, sent.p, sent.t)), X.packed(X.ANSWER, X.doc_bucket(found.d, buckets), X.answers(found.d, found.p, found.t))))

        for batch in X.answered(batches):
            for part, data, offsets in slices(batch, text):
                _, _, row, h = words(data, offsets)
                ids, _ = _ids(part, doc_id)
                begin = bounds(row, len(part))
                at = [begin[i] + X.positions(x.as_py()) for i, x in enumerate(part["p"])]
                wanted = np.zeros(len(row) + 1, np.int64)
                for a in at:
                    a = a[a < len(row)]
                    wanted[a + 1] -= 1
                    np.add.at(wanted, np.maximum(a - (period - 1), 0), 1)
                key, whole = windows(h, row, window)
                other, _ = windows(h, row, window, seed=5)
                s = np.flatnonzero((np.cumsum(wanted)[: len(key)] > 0) & whole)
                if packer.add(X.Entries(key[s], ids[row[s]], s - begin[row[s]], np.zeros(len(s), np.uint16), other[s])):
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(emit, X.ROW)


def _settle_windows(own: dict[int, X.Entries]) -> X.Entries:
    e = own[0]
    order, first, _ = X.grouped(e.h, e.d)
    e = e[order]
    e = e[e.d > e.d[first]]
    return X.answers(e.d, e.p, np.zeros(len(e), np.uint16))


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 13, period: int = 7, texts: bool = True, flush_at: int | None = None) -> DataFrame:
    """df without words that lie in a window of `window` words which also starts in a document with a smaller id.

    Words are runs of non-space bytes, unchanged; windows are judged on the input. Adds n_words, n_removed
    (long), spans (removed runs of words as arrays [first, end)), kept_sha256 and, with texts, kept_text (kept words joined by one space
    where any was removed, else the text as it was); kept_sha256 is that of the kept words joined by one space, in lower-case hexadecimal. A null or empty text has no
    words. doc_id names a document: rows with equal id and text are the same document and are treated
    alike, and rows with a null id neither lose words nor remove any. Ties between equal windows go to the
    smaller id; a text of any length is read whole and must fit in a task's memory some ten times; an empty table gives no rows; other columns stay, but for those named like
    the added ones. `flush_at`: entries that a map task holds before it packs them.
    """
    buckets = hash_buckets(df)
    flush_at = flush_at or X.flush_at(buckets)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    anchors = X.by_document(X.looked_up(_anchor_rows(docs, "doc_id", "text", window, period, buckets, flush_at), _settle_anchors, buckets, {0: 4}))
    found = X.looked_up(_window_rows(X.marked(docs, anchors, "doc_id"), "doc_id", "text", window, period, buckets, flush_at), _settle_windows, buckets, {})
    added = {"n_words": T.LongType(), "n_removed": T.LongType(), "spans": T._parse_datatype_string("array<array<long>>"), "kept_sha256": T.StringType()}
    if texts:
        added["kept_text"] = T.StringType()
    rest = [f for f in df.schema.fields if f.name not in added]
    left = df.select(*(F.col(f"`{f.name}`") for f in rest)) if len(rest) < len(df.columns) else df
    starts = X.by_document(found)
    # with no other columns this is the shuffle of the documents that the windows were found by
    narrow = {f.name for f in rest} <= {doc_id, text}
    side = docs if narrow else left
    key, body = ("doc_id", "text") if narrow else (doc_id, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            n_words, n_removed, spans, kept_text, sha = [], [], [], [], []
            for value, p in zip(batch[body], batch["p"], strict=True):
                whole = value.as_py()
                own = (whole or "").encode().split()
                a, b = X.covered_runs(X.positions(p.as_py()), window)
                n_words.append(len(own))
                spans.append(np.stack([a, b], axis=1).tolist() if len(a) else [])
                if len(a):
                    keep = np.ones(len(own), bool)
                    for x, y in zip(a, b, strict=True):
                        keep[x:y] = False
                    own = list(compress(own, keep))
                n_removed.append(n_words[-1] - len(own))
                joined = b" ".join(own)
                sha.append(hashlib.sha256(joined).hexdigest())
                if texts:
                    kept_text.append(joined.decode() if len(a) else whole)
            arrays = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(sha, pa.string())]
            if texts:
                arrays.append(pa.array(kept_text, pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in out_names), *arrays], names=[*final_names, *added])

    out_names = list(side.columns)
    final_names = [doc_id if c == key else text if c == body else c for c in out_names]
    schema = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(final_names, side.schema.fields, strict=True)), *(T.StructField(k, t) for k, t in added.items())])
    renamed = starts.select(F.col("doc").alias("_doc"), F.col("p"))
    joined = side.join(renamed.hint("shuffle_hash"), F.col(key) == F.col("_doc"), "left").drop("_doc")
    return joined.select(*out_names, "p").mapInArrow(cut, schema)
