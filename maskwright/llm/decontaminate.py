"""Find passages of a benchmark in documents by edit distance.

The distance counts inserted, removed and replaced words. An item of n words is found where some
stretch of a document is within floor(n / 5) edits of it, that is at a similarity of 0.8 or more.

1. Windows. An item is cut into equal pieces of at most `piece` words; a match has a piece with no more than its share of the edits. Of k + 1 equal parts of a piece one
   is untouched by k edits, so a match holds a run of some words of it. A document's runs are looked up among the pieces' runs, and each hit places a
   piece-sized window. This turns most of a text away with one look, and loses nothing.
2. CGK and LSH find the candidates. A random walk reads a window and writes it, repeating or going on at each step as a shared random function of the step and the word
   decides; edits then mostly cost a few Hamming differences. The walk is sampled at a few steps, many times, with other steps and walks, and each sample
   is a bucket: the pieces in the window's buckets are its candidates. The number of walks is chosen for pieces of about one length, on copies of
   them with insertions, with replacements and with deletions apart, until the share that is found reaches the target for each kind; where `most_walks` don't reach it,
   every piece whose run placed the window is a candidate, which is exact.
3. Exact verification by dynamic programming with free ends in the document, of the candidates whose item has a run where the window lies, as a match must.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import U64, VALUES, bounds, fmix, slices, text_buffer, windows, words

#: Words are runs of ASCII letters and digits and of any characters beyond ASCII, in lower case.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class Leak:
    """One edit is allowed for each `share` words of an item."""

    share: int = 5
    #: Words of a piece at most.
    piece: int = 48
    #: Steps that one sample reads, and samples of each walk.
    bits: int = 3
    samples: int = 32
    #: Share of edited copies of the pieces that the samples must find, and walks at most.
    recall: float = 0.995
    most_walks: int = 32
    #: Edited copies of each kind that the number of walks is chosen on, for pieces whose lengths agree but for `band` words.
    trials: int = 400
    band: int = 8
    #: Items that every task holds; more are searched in several passes over the documents.
    items_at_once: int = 4096


#: Hits, and samples of windows or their matches, that are held at once.
BLOCK = 1 << 18


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the words of each text."""
    data, offsets = text_buffer(pc.utf8_lower(pa.array(texts, pa.string())))
    _, _, row, h = words(data, offsets, VALUES, BETWEEN)
    begin = bounds(row, len(texts))
    return [h[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]


def _worded(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Stretches of a batch, with row and hash of each word."""
    for own, _, _ in slices(batch, text, 1 << 22):
        data, offsets = text_buffer(pc.utf8_lower(own[text]))
        _, _, row, h = words(data, offsets, VALUES, BETWEEN)
        yield own, row, h


def walks(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, seeds: np.ndarray, steps: int) -> np.ndarray:
    """CGK embeddings of the sequences flat[begin : begin + size] by the walk of each seed: the word read at each step, 0 after the end. flat ends with a 0. sequences x seeds x steps."""
    at, end, last = np.repeat(begin[:, None], len(seeds), axis=1), (begin + size)[:, None], len(flat) - 1
    out = np.zeros((len(begin), len(seeds), steps), U64)
    rolls = fmix(seeds.astype(U64)[None, :] * U64(100_003) + np.arange(1, steps + 1, dtype=U64)[:, None])
    for j in range(steps):
        inside = at < end
        word = flat[np.where(inside, at, last)]
        out[:, :, j] = word
        at += (fmix(word ^ rolls[j][None, :]) & U64(1)).astype(np.int64) & inside
    return out


def samples(seed: int, n: int, rule: Leak) -> np.ndarray:
    """Steps that each sample of a walk over n words reads: among the first 2n, which a walk mostly reads within the text."""
    rng = np.random.default_rng([seed, n])
    return rng.integers(0, max(2 * n, 1), (rule.samples, rule.bits))


def signatures(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, n: int, seeds: np.ndarray, rule: Leak) -> np.ndarray:
    """Hash of each sample of each walk, for windows of n words: sequences x seeds x samples."""
    at = np.stack([samples(int(seed), n, rule) for seed in seeds])
    embedded = walks(flat, begin, size, seeds, int(at.max(initial=0)) + 1)
    out = np.zeros((len(begin), len(seeds), rule.samples), U64)
    each = np.arange(len(seeds))[:, None]
    for j in range(rule.bits):
        out = fmix(out * U64(0x9E3779B97F4A7C15) + embedded[:, each, at[:, :, j]])
    return fmix(out + (seeds.astype(U64)[:, None] * U64(rule.samples) + np.arange(rule.samples, dtype=U64))[None])


def _flat(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in seqs], np.int64)
    return np.concatenate([*seqs, np.zeros(1, U64)]), np.cumsum(size) - size, size


def within(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """Least edits between the item and a stretch of the text, if at most `most`; with the stretch [first, end)."""
    n = len(text)
    cost, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    place = np.arange(n + 1)
    for i, w in enumerate(item):
        new, origin = cost + 1, start.copy()
        step = cost[:-1] + (text != w)
        better = step <= new[1:]
        new[1:][better], origin[1:][better] = step[better], start[:-1][better]
        # words inserted in the text: running least of cost less place
        shifted = new - place
        least = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == least, place, 0))
        cost, start = least + place, origin[source]
        if cost.min() > most:
            return None
        if i == len(item) - 1:
            end = int(cost.argmin())
            return int(cost[end]), int(start[end]), end
    return None


class Table:
    """Values by hash; equal hashes are allowed."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        order = np.lexsort((value, key))
        self.key, self.value = key[order], value[order]

    def maybe(self, h: np.ndarray) -> np.ndarray:
        """Places in h that may be here, by a byte for each upper part of a hash, which is made where it is needed and not sent."""
        if "_seen" not in self.__dict__:
            self._seen = np.zeros(1 << 20, bool)
            self._seen[(self.key >> U64(44)).astype(np.int64)] = True
        return np.flatnonzero(self._seen[(h >> U64(44)).astype(np.int64)])

    def __getstate__(self) -> dict:
        return {"key": self.key, "value": self.value}

    def matches(self, h: np.ndarray, few: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in h and the values found there, BLOCK at once or those of one place. Unless they are few, most hashes are turned away first."""
        maybe = np.arange(len(h)) if few else self.maybe(h)
        lo, hi = np.searchsorted(self.key, h[maybe]), np.searchsorted(self.key, h[maybe], "right")
        some = hi > lo
        maybe, lo, n = maybe[some], lo[some], (hi - lo)[some]
        before = np.cumsum(n) - n
        a = 0
        while a < len(maybe):
            b = max(a + 1, int(np.searchsorted(before, before[a] + BLOCK)))
            own = n[a:b]
            at = np.repeat(np.arange(a, b), own)
            yield maybe[at], self.value[lo[at] + np.arange(len(at)) - (before[at] - before[a])]
            a = b


#: Before a row's first word a piece may begin by so many words at most.
_AHEAD = 1 << 20


def _packed(row: np.ndarray, which: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Row of a slice, piece or item, and start as one number: of 11, 20 and 32 bits."""
    return row << 52 | which << 32 | (start + _AHEAD)


def _unpacked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return x >> 52, x >> 32 & (1 << 20) - 1, (x & (1 << 32) - 1) - _AHEAD


class Index:
    """Items' pieces by their runs and by their samples."""

    def __init__(self, items: list[np.ndarray], rule: Leak):
        self.rule, self.items = rule, items
        self.size = np.array([len(w) for w in items], np.int64)
        self.most = self.size // rule.share
        pieces: list[tuple[int, int, int]] = []  # item, first word, end
        for i, w in enumerate(items):
            cuts = np.linspace(0, len(w), -(-len(w) // rule.piece) + 1).astype(int)
            pieces += [(i, int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.item, self.first, end = (np.array([p[c] for p in pieces], np.int64) for c in range(3))
        self.words = [items[i][a:b] for i, a, b in pieces]
        self.length = end - self.first
        number = np.bincount(self.item, minlength=len(items))
        self.edits = (self.most // np.maximum(number, 1))[self.item]
        #: Length of runs -> the piece and place of each, as one number.
        runs: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for i, w in enumerate(self.words):
            k = int(max(1, min(4, len(w) // (self.edits[i] + 1))))
            key, _ = windows(w, np.zeros(len(w), np.int64), k, seed=9)
            runs.setdefault(k, []).append((key, i << 20 | np.arange(len(key))))
        self.runs = {k: Table(*(np.concatenate([x[c] for x in found]) for c in range(2))) for k, found in runs.items()}
        #: Walks of each piece; 0 where the exact way is taken.
        self.walks = np.zeros(len(pieces), np.int64)
        for band in np.unique(self.length // rule.band):
            own = np.flatnonzero(self.length // rule.band == band)
            self.walks[own] = self._walks_for_recall(own)
        #: Length of pieces -> the buckets of all their walks; none where the exact way is taken.
        self.buckets: dict[int, Table] = {}
        for n in np.unique(self.length):
            own = np.flatnonzero(self.length == n)
            if many := int(self.walks[own[0]]):
                signed = signatures(*_flat([self.words[i] for i in own]), int(n), np.arange(many), rule)
                self.buckets[int(n)] = Table(signed.ravel(), np.repeat(own.astype(np.int32), many * rule.samples))

    def _walks_for_recall(self, which: np.ndarray) -> int:
        """The number of walks at which copies of these pieces, with as many edits of one kind as are allowed, are found; 0 if it isn't reached."""
        needed = 1
        for kind in (2, 0, 1):  # removals are missed the most
            n = self._walks_for_kind(which, kind)
            if not n:
                return 0
            needed = max(needed, n)
        return needed

    def _walks_for_kind(self, which: np.ndarray, kind: int) -> int:
        """The same for words inserted (0), replaced (1) or removed (2)."""
        rng = np.random.default_rng([1, kind])
        pick = np.resize(rng.permutation(which)[: self.rule.trials], self.rule.trials)
        seqs = []
        for i in pick:
            w = self.words[i].tolist()
            for _ in range(self.edits[i]):
                at, new = int(rng.integers(0, max(1, len(w)))), int(rng.integers(1, 2**63))
                w[at : at + (kind > 0)] = [] if kind == 2 and len(w) > 1 else [new]
            # windows are as long as the piece
            seqs.append(np.array((w + [int(x) for x in rng.integers(1, 2**63, self.edits[i])])[: self.length[i]], U64))
        missed = np.arange(len(seqs))
        for walk in range(self.rule.most_walks):
            found = np.zeros(len(missed), bool)
            for n in np.unique(self.length[pick[missed]]):
                at = np.flatnonzero(self.length[pick[missed]] == n)
                theirs, own = (signatures(*_flat([x[i] for i in y]), int(n), np.array([walk]), self.rule) for x, y in ((seqs, missed[at]), (self.words, pick[missed[at]])))
                found[at] = (theirs == own).any(axis=(1, 2))
            missed = missed[~found]
            if len(missed) <= (1 - self.rule.recall) * len(seqs):
                return walk + 1
        return 0

    def placed(self, h: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, piece and window start of hits of runs, some at once."""
        for k, table in self.runs.items():
            own, whole = windows(h, row, k, seed=9)
            at_whole = np.flatnonzero(whole)
            for at, value in table.matches(own[at_whole]):
                at = at_whole[at]
                yield _unpacked(np.unique(_packed(row[at], value >> 20, at - (value & (1 << 20) - 1))))

    def candidates(self, h: np.ndarray, begin: np.ndarray, r: np.ndarray, piece: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, piece and window start of those pairs of a window and a piece that share a bucket; hits place the windows."""
        for n in np.unique(self.length[piece]):
            own = np.flatnonzero(self.length[piece] == n)
            if int(n) not in self.buckets:
                yield r[own], piece[own], start[own]
                continue
            window, which = np.unique(_packed(r[own], np.zeros(len(own), np.int64), start[own]), return_inverse=True)
            told = np.unique(which * len(self.item) + piece[own])  # pairs that share a run
            in_row, _, first = _unpacked(window)
            a = np.clip(first, begin[in_row], begin[in_row + 1])
            size = np.maximum(np.minimum(first + n, begin[in_row + 1]) - a, 0)
            found = []
            many = int(self.walks[piece[own[0]]])
            step = max(1, BLOCK // (self.rule.samples * many))
            for lo in range(0, len(a), step):
                signed = signatures(h, a[lo : lo + step], size[lo : lo + step], int(n), np.arange(many), self.rule)
                for at, other in self.buckets[int(n)].matches(signed.ravel(), few=True):
                    pair = np.unique((at // (self.rule.samples * many) + lo) * len(self.item) + other)
                    place = np.minimum(np.searchsorted(told, pair), len(told) - 1)
                    found.append(pair[told[place] == pair])
            pair = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            w, other = pair // len(self.item), pair % len(self.item)
            yield in_row[w], other, first[w]

    def search(self, h: np.ndarray, row: np.ndarray, n_rows: int) -> list[tuple[int, int, int, int, int]]:
        """Best match of each row and item: row, item, edits, first word, end."""
        if not self.items or not len(h):
            return []
        begin, ended = bounds(row, n_rows), np.r_[h, U64(0)]
        found: list[np.ndarray] = []
        for hits in self.placed(h, row):
            for r, piece, start in self.candidates(ended, begin, *hits):
                found.append(np.unique(_packed(r, self.item[piece], start - self.first[piece])))
        rows, items, start = _unpacked(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64))
        most = 2 * self.most[items]
        lows, highs = np.maximum(begin[rows], start - most), np.minimum(begin[rows + 1], start + self.size[items] + most)
        # stretches of a row and item that meet are verified together; starts come in order
        new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (items[1:] != items[:-1]) | (lows[1:] > highs[:-1])]) if len(rows) else np.zeros(0, np.int64)
        last = np.r_[new[1:], len(rows)] - 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for r, item, lo, hi in zip(rows[new].tolist(), items[new].tolist(), lows[new].tolist(), highs[last[: len(new)]].tolist(), strict=True):
            match = within(self.items[item], h[lo:hi], int(self.most[item]))
            if match and ((r, item) not in best or match[0] < best[r, item][0]):
                best[r, item] = match[0], lo + match[1] - int(begin[r]), lo + match[2] - int(begin[r])
        return [(*key, *x) for key, x in best.items()]


def leaks(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rule: Leak = Leak()) -> DataFrame:
    """Items that a document holds within the allowed edits: doc_id, item_id, n_item_words, edits, first_word, end_word.

    One row for each document and item, with the least edits (then the first stretch). Null or empty texts hold nothing
    and items without words are never found; a null doc_id is reported as null; repeated rows are reported each; an empty table
    gives no rows; other columns are ignored. Items with equal words are searched once and reported each. A text of any length is read whole and must fit in a task's memory
    some fifty times. Items go to every task in passes of `items_at_once`, so what is broadcast is bounded. doc_id must not be named like an added column.
    """
    if doc_id in ("item_id", "n_item_words", "edits", "first_word", "end_word"):
        raise ValueError(f"{doc_id} is a column of the result; rename it")
    spark = df.sparkSession
    schema = T.StructType([T.StructField(doc_id, df.schema[doc_id].dataType), T.StructField("item_id", T.LongType()), *(T.StructField(c, T.LongType()) for c in ("n_item_words", "edits", "first_word", "end_word"))])
    out = spark.createDataFrame([], schema)
    for index, names in _passes(benchmark, item_id, item_text, rule):
        shared = spark.sparkContext.broadcast((index, names))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names = shared.value
            for batch in batches:
                for own, row, h in _worded(batch, text):
                    found = index.search(h, row, len(own))
                    flat = [(r, key, len(index.items[i]), edits, a, b) for r, i, edits, a, b in found for key in names[i]]
                    values = np.array([x[2:] for x in flat], np.int64).reshape(-1, 4)
                    at = pa.array([x[0] for x in flat], pa.int64())
                    yield pa.RecordBatch.from_arrays([own[doc_id].take(at), pa.array([x[1] for x in flat], pa.int64()), *(pa.array(c) for c in values.T)], names=schema.names)

        out = out.union(df.select(doc_id, text).mapInArrow(run, schema))
    return out


def without_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rule: Leak = Leak()) -> DataFrame:
    """The rows of df, whole and unchanged, in which `leaks` finds no item. One pass over the documents for each items_at_once items; no shuffle."""
    schema, names = df.schema, df.columns
    for index, _ in _passes(benchmark, item_id, item_text, rule):
        shared = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for own, row, h in _worded(batch, text):
                    clean = np.ones(len(own), bool)
                    clean[[r for r, *_ in index.search(h, row, len(own))]] = False
                    yield own.filter(pa.array(clean))

        df = df.select(*names).mapInArrow(run, schema)
    return df


def _passes(benchmark: DataFrame, item_id: str, item_text: str, rule: Leak) -> Iterator[tuple[Index, list[list[int]]]]:
    """An index of each items_at_once items, and the ids of those with each index entry's words."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).filter("text is not null").orderBy("item_id", "text").toLocalIterator()
    while part := [(r.item_id, r.text) for r in islice(rows, rule.items_at_once)]:
        same: dict[bytes, list[int]] = {}
        first: list[np.ndarray] = []
        for (key, _), w in zip(part, item_words([t for _, t in part]), strict=True):
            if len(w):
                if w.tobytes() not in same:
                    first.append(w)
                same.setdefault(w.tobytes(), []).append(key)
        yield Index(first, rule), list(same.values())
