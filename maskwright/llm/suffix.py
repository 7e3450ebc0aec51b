"""Remove byte strings that occur elsewhere, by longest-previous-factor arrays.

The longest previous factor (LPF) of a position is the longest string from there that also starts earlier;
in the suffix order it is found at the previous or next entry of smaller text position. `lpf_array` does that
exactly for one byte string. For a corpus only the question LPF >= length matters, so suffixes are ordered by their
first `length` bytes alone, by fingerprint: suffixes that agree in them are neighbours, sorted by position, and the
previous and next smaller position of an entry are its neighbours in its class.

Sorting all suffixes would move some sixteen bytes for each byte of text. Instead
1. each string of `length` bytes picks the least hash of the k-grams in it as its anchor; strings with the same anchor in a
   row form a segment, and equal strings have equal anchors wherever they stand;
2. segments are sorted by the hash of their whole text, and by that of their anchor. A segment that recurs
   as a whole is settled; one whose anchor does not recur holds no repeat;
3. only the rest, at the edges of repeated passages, sends each of its strings, and one copy of each
   settled segment with the same anchor answers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _exchange as X
from ._common import U64, Buckets, fmix, hash_buckets, lean, powers, prefix_sums, slices, text_buffer
from ._common import _BASE as BASE
from .substring import _ids

#: Tags: a segment or string occurs earlier, or later; its anchor occurs elsewhere; its anchor stands in different segments.
EARLIER, LATER, ANCHOR, MIXED = 1, 2, 4, 8
LENGTH_SHIFT = 4  # a tag's upper bits hold the number of a segment's starts
#: Starts that are looked at together; a longer document is cut at multiples of it.
CHUNK = 1 << 19
#: A tag has 16 bits, LENGTH_SHIFT of them taken; a segment has as many starts as an anchor can serve at most.
MOST_STARTS = (1 << 16 - LENGTH_SHIFT) - 1


def suffix_array(data: bytes) -> np.ndarray:
    """Start positions of all suffixes in lexical order, by prefix doubling."""
    n = len(data)
    rank = np.frombuffer(data, np.uint8).astype(np.int64)
    k = 1
    order = np.argsort(rank, kind="stable")
    while n > 1:
        second = np.full(n, -1)
        second[: n - k] = rank[k:] if k < n else second[:0]
        order = np.lexsort((second, rank))
        new = np.r_[0, np.cumsum((np.diff(rank[order]) != 0) | (np.diff(second[order]) != 0))]
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            break
        k *= 2
    return order


def lcp_array(data: bytes, order: np.ndarray) -> np.ndarray:
    """Length that each suffix shares with the one before it in the order."""
    n = len(data)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    out, h = np.zeros(n, np.int64), 0
    for i in range(n):
        if rank[i]:
            j = order[rank[i] - 1]
            while i + h < n and j + h < n and data[i + h] == data[j + h]:
                h += 1
            out[rank[i]] = h
            h = max(0, h - 1)
        else:
            h = 0
    return out


def lpf_array(data: bytes) -> np.ndarray:
    """Longest previous factor of each position, from the previous and next smaller positions in suffix order."""
    order = suffix_array(data)
    lcp = lcp_array(data, order)
    n = len(data)
    out = np.zeros(n, np.int64)
    stack: list[tuple[int, int]] = []  # positions increase; with each, what it shares with the suffix at hand
    for at in range(n + 1):
        position, shared = (int(order[at]), int(lcp[at])) if at < n else (-1, 0)
        while stack and stack[-1][0] > position:
            top, below = stack.pop()
            out[top] = max(out[top], shared)  # next smaller position
            shared = min(shared, below)
        if stack:
            out[position] = max(out[position], shared)  # previous smaller position
        if at < n:
            stack.append((position, shared))
    return out


def _sliding_least(key: np.ndarray, w: int) -> np.ndarray:
    """Least of each w in a row."""
    n = len(key)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, U64)
    padded[:n] = key
    blocks = padded.reshape(-1, w)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    before = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    return np.minimum(after[: n - w + 1], before[w - 1 : n])


def _chunks(data: np.ndarray, offsets: np.ndarray, length: int, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Byte ranges that hold whole documents together, or a stretch of a long one and the length - 1 bytes after it."""
    row, n = 0, len(offsets) - 1
    while row < n:
        lo = int(offsets[row])
        last = int(np.searchsorted(offsets, lo + chunk, "right")) - 1
        if last > row:
            yield lo, int(offsets[last])
            row = last
        else:
            end = int(offsets[row + 1])
            for at in range(lo, max(lo + 1, end - length + 1), chunk):
                yield at, min(end, at + chunk + length - 1)
            row += 1


def segments(data: np.ndarray, offsets: np.ndarray, length: int, k: int, chunk: int = CHUNK):
    """Segments of all rows: row, first start within it, number of starts, hash of the anchor, hash of the text and the anchor's place in it."""
    out = []
    for lo, hi in _chunks(data, offsets, length, chunk):
        n = hi - lo - length + 1
        if n <= 0:
            continue
        p = prefix_sums(data[lo:hi])
        up = powers(BASE, len(p))
        grams = fmix((p[k:] - p[:-k]) * up[: len(p) - k])
        key = (grams & ~U64((1 << 24) - 1)) | np.arange(len(grams), dtype=U64)
        anchor = (_sliding_least(key, length - k + 1) & U64((1 << 24) - 1)).astype(np.int64)
        # a start is whole if its row ends no sooner than the string
        starts = np.arange(lo, lo + n)
        row = np.searchsorted(offsets, starts, "right") - 1
        at = np.flatnonzero(starts + length <= offsets[row + 1])
        if not len(at):
            continue
        new = np.r_[True, (np.diff(at) > 1) | (anchor[at[1:]] != anchor[at[:-1]])]
        first = at[new]
        last = at[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]
        a = anchor[first]
        whole = (p[last + length] - p[first]) * up[first]
        whole = fmix(fmix(whole + (last - first).astype(U64) * U64(0x9FB21C651E98DF25)) + (a - first).astype(U64))
        r = row[first]
        out.append((r, first + lo - offsets[r], last - first + 1, grams[a], whole))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U64), np.zeros(0, U64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _bucket(h: np.ndarray, buckets: Buckets) -> np.ndarray:
    return buckets.of(fmix(h + U64(11)))


def _ordered(e: X.Entries) -> tuple[X.Entries, np.ndarray, np.ndarray]:
    """Entries by class and position in the corpus, and whether each has an earlier or later one in its class.

    The same position given twice, by a repeated row, is one entry.
    """
    order, _, _ = X.grouped(e.h, e.d, e.p, e.t)
    e = e[order]
    if len(e):
        e = e[np.flatnonzero(np.r_[True, (e.h[1:] != e.h[:-1]) | (e.d[1:] != e.d[:-1]) | (e.p[1:] != e.p[:-1])])]
    order, first, size = X.grouped(e.h, e.d, e.p)
    place = np.arange(len(order)) - first
    return e[order], place > 0, place < size - 1


def _segment_rows(docs: DataFrame, length: int, k: int, buckets: Buckets, flush_at: int, chunk: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = X.Packer(flush_at)

        def flush() -> Iterator[pa.RecordBatch]:
            e = packer.take()  # h: anchor, g: text, t: starts
            if e is None:
                return
            size = e.t.astype(np.uint16) << np.uint16(LENGTH_SHIFT)
            found = []
            # by anchor
            order, first, n = X.grouped(e.h, e.g, e.d, e.p)
            x, s = e[order], size[order]
            lead = first == np.arange(len(order))
            differs = np.r_[False, x.g[1:] != x.g[:-1]] & ~lead
            group = np.cumsum(lead) - 1
            mixed = (np.bincount(group, weights=differs) > 0)[group]
            tag = (np.where(n > 1, ANCHOR, 0) | np.where(mixed, MIXED, 0)).astype(np.uint16)
            found.append(X.answers(x.d, x.p, tag | s)[np.flatnonzero(tag)])
            # one entry of an anchor says for all whether they differ here
            sent = X.Entries(x.h, x.d, x.p, s | np.where(mixed, MIXED, 0).astype(np.uint16), x.g)[np.flatnonzero(lead)]
            yield from filter(None, [X.packed(0, _bucket(sent.h, buckets), sent)])
            # by text
            x = X.Entries(e.g, e.d, e.p, size)
            x, earlier, later = _ordered(x)
            tag = (np.where(earlier, EARLIER, 0) | np.where(later, LATER, 0)).astype(np.uint16)
            found.append(X.answers(x.d, x.p, tag | x.t)[np.flatnonzero(tag)])
            sent = x[np.flatnonzero(~earlier)]
            out = X.Entries.joined(found)
            yield from filter(None, [X.packed(1, _bucket(sent.h, buckets), X.Entries(sent.h, sent.d, sent.p, sent.t)), X.packed(X.ANSWER, X.doc_bucket(out.d, buckets), out)])

        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                ids, known = _ids(part, "doc_id")
                row, start, n, anchor, whole = segments(data, offsets, length, k, chunk)
                ok = known[row]
                if packer.add(X.Entries(anchor, ids[row], start, n, whole)[np.flatnonzero(ok)]):
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(emit, X.ROW)


def _settle_segments(own: dict[int, X.Entries]) -> X.Entries:
    found = []
    if 0 in own:
        e = own[0]
        order, first, n = X.grouped(e.h, e.g)
        e = e[order]
        lead = first == np.arange(len(order))
        differs = np.r_[False, e.g[1:] != e.g[:-1]] & ~lead | (e.t & MIXED > 0)
        mixed = (np.bincount(np.cumsum(lead) - 1, weights=differs) > 0)[np.cumsum(lead) - 1]
        tag = (np.where(n > 1, ANCHOR, 0) | np.where(mixed, MIXED, 0)).astype(np.uint16)
        found.append(X.answers(e.d, e.p, tag | e.t)[np.flatnonzero(tag)])
    if 1 in own:
        e, earlier, later = _ordered(own[1])
        tag = (np.where(earlier, EARLIER, 0) | np.where(later, LATER, 0)).astype(np.uint16)
        found.append(X.answers(e.d, e.p, tag | e.t)[np.flatnonzero(tag)])
    return X.Entries.joined(found)


def _string_rows(docs: DataFrame, length: int, repeated: int, buckets: Buckets, flush_at: int) -> DataFrame:
    """Strings of the segments that are not settled; kind 0 wants an answer, tag 1 says that it is known."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        packer = X.Packer(flush_at)
        settled: list[X.Entries] = []

        def flush() -> Iterator[pa.RecordBatch]:
            e = packer.take()
            found = [*settled]
            settled.clear()
            if e is not None:
                e, earlier, later = _ordered(e)
                dup = (np.where(earlier, EARLIER, 0) | np.where(later, LATER, 0)) & repeated > 0
                found.append(X.answers(e.d, e.p, np.full(len(e), 1 << LENGTH_SHIFT, np.uint16))[np.flatnonzero(dup & (e.t == 0))])
                e.t = np.where(dup, 1, e.t).astype(np.uint16)
                sent = e[np.flatnonzero(~earlier)]
                yield from filter(None, [X.packed(0, buckets.of(sent.g), X.Entries(sent.h, sent.d, sent.p, sent.t))])
            if found:
                out = X.Entries.joined(found)
                yield from filter(None, [X.packed(X.ANSWER, X.doc_bucket(out.d, buckets), out)])

        for batch in X.answered(batches):
            data, offsets = text_buffer(batch["text"])
            ids, _ = _ids(batch, "doc_id")
            for i in range(len(batch)):
                at, tag = X.positions(batch["p"][i].as_py()), X.tags(batch["t"][i].as_py())
                n = (tag >> LENGTH_SHIFT).astype(np.int64)
                dup = tag & repeated > 0
                settled.append(X.answers(np.full(dup.sum(), ids[i]), at[dup], tag[dup] >> LENGTH_SHIFT << LENGTH_SHIFT))
                asks = ~dup & (tag & MIXED > 0)
                tells = dup & (tag & MIXED > 0) & (tag & EARLIER == 0)
                body = data[offsets[i] : offsets[i + 1]]
                for a, m, known in zip(at[asks | tells], n[asks | tells], dup[asks | tells], strict=True):
                    if a + m + length - 1 > len(body):
                        continue  # from another text of the same id
                    p = prefix_sums(body[a : a + m + length - 1])
                    h = (p[length:] - p[:-length]) * powers(BASE, len(p))[: len(p) - length]
                    if packer.add(X.Entries(fmix(h), np.full(m, ids[i]), np.arange(a, a + m), np.full(m, known, np.uint16), fmix(h ^ U64(0x5851F42D4C957F2D)))):
                        yield from flush()
            if sum(map(len, settled)) > flush_at:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(emit, X.ROW)


def remove_repeated_strings(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, keep_first: bool = False, k: int = 32, texts: bool = True, flush_at: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """df without bytes that lie in a string of `length` bytes which also starts elsewhere.

    With keep_first only strings that also start earlier (in a smaller id, or before in the text) are removed, that is where LPF >=
    length, so the first copy stays; else all copies go. Strings are taken from the UTF-8 bytes of whole texts, never
    cross documents, may overlap, and are judged on the input. Adds n_bytes, n_removed, n_spans (long), spans
    (maximal removed runs as arrays [first, end)), kept_sha256 (lower-case hexadecimal, of the bytes left) and, with
    texts, kept (binary: the bytes left, which may cut a character). A null text is empty. Rows with equal id and text are one document that is
    given twice, so their strings don't count as repeats of each other; rows with a null id neither lose nor
    remove bytes. A text of any length is read whole, in stretches of `chunk` starts; it must fit in a task's memory some ten times. An empty table gives
    no rows; other columns stay, but for those named like the added ones. `flush_at`: entries that a map task holds before it packs them.
    """
    if not k <= length < k + MOST_STARTS:
        raise ValueError(f"length must be from {k} to {k + MOST_STARTS - 1}")
    buckets = hash_buckets(df)
    flush_at = flush_at or X.flush_at(buckets)
    repeated = EARLIER if keep_first else EARLIER | LATER
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    first = X.by_document(X.looked_up(_segment_rows(docs, length, k, buckets, flush_at, chunk), _settle_segments, buckets, {}))

    def settle(own: dict[int, X.Entries]) -> X.Entries:
        e, earlier, later = _ordered(own[0])
        dup = (np.where(earlier, EARLIER, 0) | np.where(later, LATER, 0)) & repeated > 0
        at = np.flatnonzero(dup & (e.t == 0))
        return X.answers(e.d[at], e.p[at], np.full(len(at), 1 << LENGTH_SHIFT, np.uint16))

    found = X.looked_up(_string_rows(X.marked(docs, first, "doc_id"), length, repeated, buckets, flush_at), settle, buckets, {})
    starts = X.by_document(found).select(F.col("doc").alias("_doc"), F.col("p").alias("_p"), F.col("t").alias("_t"))
    added = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "spans": T.ArrayType(T.ArrayType(T.LongType())), "kept_sha256": T.StringType()}
    if texts:
        added["kept"] = T.BinaryType()
    rest = [f for f in df.schema.fields if f.name not in added]
    narrow = {f.name for f in rest} <= {doc_id, text}
    side = docs if narrow else df.select(*(F.col(f"`{f.name}`") for f in rest))
    key, body = ("doc_id", "text") if narrow else (doc_id, text)
    out_names = list(side.columns)
    final_names = [doc_id if c == key else text if c == body else c for c in out_names]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            data, offsets = text_buffer(batch[body])
            n_bytes, n_removed, spans, sha, kept = [], [], [], [], []
            for i, (p, t) in enumerate(zip(batch["_p"], batch["_t"], strict=True)):
                own = data[offsets[i] : offsets[i + 1]]
                at, n = X.positions(p.as_py()), (X.tags(t.as_py()) >> LENGTH_SHIFT).astype(np.int64)
                a, b = X.covered_runs(at, n + length - 1)
                ok = b <= len(own)
                a, b = a[ok], b[ok]
                left = own
                if len(a):
                    keep = np.ones(len(own), bool)
                    for x, y in zip(a, b, strict=True):
                        keep[x:y] = False
                    left = own[keep]
                n_bytes.append(len(own))
                n_removed.append(len(own) - len(left))
                spans.append(np.stack([a, b], axis=1).tolist() if len(a) else [])
                raw = left.tobytes()
                sha.append(hashlib.sha256(raw).hexdigest())
                if texts:
                    kept.append(raw)
            arrays = [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([len(x) for x in spans], pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(sha, pa.string())]
            if texts:
                arrays.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in out_names), *arrays], names=[*final_names, *added])

    schema = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(final_names, side.schema.fields, strict=True)), *(T.StructField(c, t) for c, t in added.items())])
    joined = side.join(starts.hint("shuffle_hash"), F.col(key) == F.col("_doc"), "left").drop("_doc")
    return joined.select(*out_names, "_p", "_t").mapInArrow(cut, schema)
