"""Quality rules by divergence from language references.

Each document gets two histograms: characters by class, and words among the commonest of its language. A
language's reference is the sum over all its other documents that pass the base rules: a document is never part of what it is held against. It is
kept when the Jensen-Shannon distance of both histograms to the reference stays within bounds; histograms of too few
characters or words are not judged, as their distance is mostly chance. Where a language's other documents are too few
for a reference, the class histogram is held against that of all languages, with all letters as one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import U64, cut_lineage, fmix, prefix_sums, slices, span_hashes, windows, words

#: Classes by byte: lower-case, upper-case, digit, space, line end, full stop or comma, other marks, symbols, and the parts of letters beyond ASCII.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "symbol", "wide")
_CLASS = np.full(256, CLASSES.index("wide"), np.uint8)
_CLASS[:128] = CLASSES.index("mark")
for _name, _chars in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"), ("space", b" \t\x0b\x0c\r"), ("newline", b"\n"), ("stop", b".,"), ("symbol", b"#*$%&|<>")):
    _CLASS[list(_chars)] = CLASSES.index(_name)
_SYMBOL = _CLASS == CLASSES.index("symbol")
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False


@dataclass(frozen=True)
class Divergence:
    """Bounds of the verdict. Distances are square roots of base-2 divergences, so from 0 to 1."""

    max_class_distance: float = 0.3
    max_word_distance: float = 0.45
    #: Short texts stray further by chance: the bound of the class distance grows by this over the root of the characters.
    class_slack: float = 0.5
    min_chars: int = 200
    min_words: int = 50
    #: A word is common if it makes up at least one in so many of its language's words, so there are at most as many.
    common_share: int = 500
    #: Words that a language's other documents must have to be its reference.
    min_reference: int = 2000
    #: Languages whose references the driver holds; those of further ones, in the order of their words, come to the documents by a shuffle.
    languages_at_once: int = 1000


BASE = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType())]


def _base_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], tuple]:
    n = len(offsets) - 1
    start, end, row, h = found = words(data, offsets)
    lead = np.r_[0, np.cumsum(_LEAD[data])] if len(data) else np.zeros(1, np.int64)
    per = lambda weights: np.bincount(row, weights=weights, minlength=n).astype(np.int64)
    symbols = np.r_[0, np.cumsum(_SYMBOL[data])] if len(data) else np.zeros(1, np.int64)
    out = {"n_words": np.bincount(row, minlength=n), "word_chars": per(lead[end] - lead[start]), "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]]}
    # words in three-word windows that the row holds twice or more
    key, whole = windows(h, row, 3)
    at = np.flatnonzero(whole)
    key = fmix(key[at] + fmix(row[at].astype(U64) + U64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(h), bool)
    for j in range(3):
        covered[at[twice] + j] = True
    out["n_repeat_words"] = per(covered)
    # lines with a word that equal an earlier line of the row
    ends = np.flatnonzero(data == 10)
    a = np.sort(np.r_[offsets[:-1], ends + 1])
    a = a[a <= offsets[-1]]
    line_row = np.searchsorted(offsets, a, "right") - 1
    b = np.r_[a[1:], offsets[-1]]
    b = b - ((b > a) & (np.r_[data, 0][b - 1] == 10) & (b > offsets[np.minimum(line_row, n - 1)])) if len(data) else b
    wordy = np.searchsorted(start, b) > np.searchsorted(start, a)
    a, b, line_row = a[wordy], b[wordy], line_row[wordy]
    key = np.zeros(len(a), U64)
    for lo in range(0, len(a), 1 << 14):  # hashed in stretches, to bound the scratch arrays
        x, y = a[lo : lo + (1 << 14)], b[lo : lo + (1 << 14)]
        key[lo : lo + (1 << 14)] = span_hashes(prefix_sums(data[x[0] : y[-1]]), x - x[0], y - x[0])
    key = fmix(key + fmix(line_row.astype(U64) + U64(1)))
    order = np.argsort(key, kind="stable")
    again = order[1:][key[order][1:] == key[order][:-1]]
    out["n_dup_lines"] = np.bincount(line_row[again], minlength=n)
    return out, found


def _class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each row by class."""
    n, k = len(offsets) - 1, len(CLASSES)
    kind = _CLASS[data]
    kind[~_LEAD[data]] = k  # the later bytes of a character
    row = np.repeat(np.arange(n, dtype=np.int64) * (k + 1), np.diff(offsets))
    return np.bincount(row + kind, minlength=n * (k + 1)).reshape(n, k + 1)[:, :k]


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of counts to a reference row of the same width; 0 where either is empty."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / np.maximum(reference.sum(axis=-1, keepdims=True), 1e-300)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1) / 2 + np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1) / 2
    return np.where((p.sum(axis=1) > 0) & (q.sum(axis=-1) > 0), np.sqrt(np.maximum(d, 0)), 0.0)


#: Classes that hold letters, which languages use in different shares.
_LETTERS = [CLASSES.index(c) for c in ("lower", "upper", "wide")]


def without_letters(counts: np.ndarray) -> np.ndarray:
    """Class counts with all letters as the first class."""
    rest = [i for i in range(len(CLASSES)) if i not in _LETTERS]
    return np.concatenate([counts[..., _LETTERS].sum(axis=-1, keepdims=True), counts[..., rest]], axis=-1)


def language_references(df: DataFrame, text: str, lang: str, rule: Divergence) -> tuple[dict[str | None, dict], np.ndarray, DataFrame | None]:
    """Histograms of each language over all its documents that pass the base rules: characters by class, and its common words by hash; and the classes of all languages.

    What comes to the driver is bounded by the rule: languages_at_once languages of common_share words each. If there are more languages,
    those of fewer words are a table of lang and ref.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str | None, int], np.ndarray] = {}
        words_of: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            """A row for each language and word that the task has met, and for each language's totals."""
            for name, parts in words_of.items():
                h, n = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
                word, at = np.unique(h, return_inverse=True)
                yield made(name, np.zeros(len(word), np.int32), word.view(np.int64), np.bincount(at, weights=n, minlength=len(word)).astype(np.int64))
            for name, sums in total.items():
                yield made(name, np.arange(1, len(sums) + 1, dtype=np.int32), np.zeros(len(sums), np.int64), sums)
            words_of.clear()
            total.clear()

        for batch in batches:
            for part, data, offsets in slices(batch, text):
                base, (_, _, row, h) = _base_counts(data, offsets)
                passed = ~base_failed(base["n_words"], base["n_repeat_words"])
                classes = _class_counts(data, offsets) * passed[:, None]
                names = part[lang].to_pylist()
                for name in set(names):
                    own = passed & np.array([x == name for x in names])
                    word, n = np.unique(h[own[row]], return_counts=True)
                    words_of.setdefault(name, []).append((word, n))
                    held += len(word)
                    sums = np.r_[base["n_words"][own].sum(), classes[own].sum(axis=0)].astype(np.int64)
                    total[name] = total.get(name, 0) + sums
                if held > 1 << 20:
                    yield from flush()
                    held = 0
        yield from flush()

    def made(name: str | None, kind: np.ndarray, word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name] * len(kind), pa.string()), pa.array(kind), pa.array(word), pa.array(n)], names=["lang", "kind", "word", "n"])

    # kind 0: a word; 1 and on: all words, then the classes
    counted = df.select(text, F.col(lang).alias(lang)).mapInArrow(counts, "lang string, kind int, word long, n long")
    summed = cut_lineage(counted.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")))
    pooled = np.zeros(len(CLASSES))
    for r in summed.filter("kind > 1").groupBy("kind").agg(F.sum("n").alias("n")).collect():  # a row for each class
        pooled[r.kind - 2] = r.n
    # a language with fewer words can be no document's reference
    own = summed.filter(F.col("kind") == 1).filter(F.col("n") >= rule.min_reference).select(F.col("lang").alias("_lang"), F.col("n").alias("_all"))
    large = own.orderBy(F.desc("_all"), "_lang").limit(rule.languages_at_once + 1).collect()
    common = (F.col("kind") > 0) | (F.col("n") * rule.common_share >= F.col("_all"))
    named = summed.join(own.hint("broadcast") if len(large) <= rule.languages_at_once else own, F.col("lang").eqNullSafe(F.col("_lang"))).filter(common)
    rest = None
    if len(large) > rule.languages_at_once:
        last = large[rule.languages_at_once]
        same = F.lit(True) if last._lang is None else F.col("_lang") >= F.lit(last._lang)  # a null language comes first among equals
        behind = (F.col("_all") < last._all) | ((F.col("_all") == last._all) & same)
        rest = named.filter(F.coalesce(behind, F.lit(False))).groupBy("lang").agg(F.collect_list(F.struct("kind", "word", "n")).alias("ref"))
        named = named.filter(~F.coalesce(behind, F.lit(False)))
    found: dict[str | None, dict] = {}
    for r in named.select("lang", "kind", "word", "n").collect():
        _put(found, r.lang, r.kind, r.word, r.n)
    return found, pooled, rest


def _put(found: dict[str | None, dict], lang: str | None, kind: int, word: int, n: int) -> None:
    ref = found.setdefault(lang, {"words": {}, "classes": [0] * len(CLASSES), "all": 0})
    if kind == 0:
        ref["words"][word] = n
    elif kind == 1:
        ref["all"] = n
    else:
        ref["classes"][kind - 2] = n


def _arrays(found: dict[str | None, dict]) -> dict[str | None, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted common words of each language, their counts with that of all others, and the classes."""
    return {
        name: (np.array(sorted(x["words"]), np.int64), np.array([x["words"][w] for w in sorted(x["words"])] + [max(0, x["all"] - sum(x["words"].values()))], float), np.array(x["classes"], float))
        for name, x in found.items()
    }


ADDED = (*(k for k, _ in BASE), "class_distance", "word_distance", "base_failed", "kept")


def quality_rules(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rule: Divergence = Divergence(), carry: tuple[str, ...] = ()) -> DataFrame:
    """Base counts, distances to the language's reference, and the verdict of every document; with the columns of `carry` before them.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), class_distance,
    word_distance (double, rounded to 6 places), base_failed, kept (boolean). kept is false where base_failed, or where a histogram of
    enough characters or words is too far from its reference. A null text has no words, so base_failed
    holds; a null language is a language of its own. A document whose language has fewer than min_reference words in other documents that pass the base rules is
    held against the classes of all languages, its letters as one class, and its words aren't judged. Rows are judged each by itself, so repeated rows and ties
    agree; a text of any length is read whole and must fit in a task's memory some fifty times; an empty table gives
    no rows; columns of `carry` that are named like an added one are left out, and other columns are ignored.
    """
    spark = df.sparkSession
    found, pooled, rest = language_references(df, text, lang, rule)
    shared = spark.sparkContext.broadcast((_arrays(found), pooled))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, every = shared.value
            if "_ref" in batch.schema.names:
                refs = told(batch)
            for part, data, offsets in slices(batch, text):
                base, (_, _, row, h) = _base_counts(data, offsets)
                classes = _class_counts(data, offsets)
                n = len(part)
                failed = base_failed(base["n_words"], base["n_repeat_words"])
                # what the document itself has added to a reference
                added = np.where(failed, 0, 1)[:, None]
                class_distance = js_distance(without_letters(classes), np.maximum(without_letters(every[None, :] - classes * added), 0))
                word_distance = np.zeros(n)
                names = part[lang].to_pylist()
                for name in set(names) & set(refs):
                    common, word_ref, class_ref = refs[name]
                    mine = np.array([x == name for x in names])
                    mine = np.flatnonzero(mine & (word_ref.sum() - base["n_words"] * added[:, 0] >= rule.min_reference))
                    class_distance[mine] = js_distance(classes[mine], np.maximum(class_ref[None, :] - classes[mine] * added[mine], 0))
                    place = np.full(n, -1)
                    place[mine] = np.arange(len(mine))
                    own = place[row] >= 0
                    key = h[own].view(np.int64)
                    at = np.minimum(np.searchsorted(common, key), max(len(common) - 1, 0))
                    at = np.where(common[at] == key, at, len(common)) if len(common) else np.zeros(len(key), np.int64)
                    k = len(common) + 1
                    hist = np.bincount(place[row[own]] * k + at, minlength=len(mine) * k).reshape(len(mine), k)
                    for lo in range(0, len(mine), 256):  # to bound the scratch arrays
                        some, x = mine[lo : lo + 256], hist[lo : lo + 256]
                        word_distance[some] = js_distance(x, np.maximum(word_ref[None, :] - x * added[some], 0))
                chars = classes.sum(axis=1)
                far = (class_distance > rule.max_class_distance + rule.class_slack / np.sqrt(np.maximum(chars, 1))) & (chars >= rule.min_chars) | (word_distance > rule.max_word_distance) & (base["n_words"] >= rule.min_words)
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in before), *(pa.array(base[k], pa.int64()) for k, _ in BASE), pa.array(class_distance.round(6)), pa.array(word_distance.round(6)), pa.array(failed), pa.array(~failed & ~far)],
                    names=[*before, *ADDED],
                )

    def told(batch: pa.RecordBatch) -> dict:
        """References that came with the rows."""
        own: dict[str | None, dict] = {}
        for i, name in enumerate(batch[lang].to_pylist()):
            if name not in own and batch["_ref"][i].is_valid:
                for x in batch["_ref"][i].as_py():
                    _put(own, name, x["kind"], x["word"], x["n"])
        return _arrays(own)

    before = [c for c in dict.fromkeys([*carry, doc_id]) if c not in ADDED] if carry else [doc_id]
    schema = T.StructType([*(df.schema[c] for c in before), *(T.StructField(k, t) for k, t in BASE), T.StructField("class_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])
    rows = df.select(*dict.fromkeys([*before, text, lang]))
    if rest is None:
        return rows.mapInArrow(judge, schema)
    # the driver's languages are judged where they stand, the others' rows are joined to their references
    held = F.col(lang).isin([x for x in found if x is not None]) | (F.col(lang).isNull() & F.lit(None in found))
    held = F.coalesce(held, F.lit(None in found))
    small = rows.filter(~held).join(rest.select(F.col("lang").alias("_lang"), F.col("ref").alias("_ref")).hint("shuffle_hash"), F.col(lang).eqNullSafe(F.col("_lang")), "left").drop("_lang")
    return rows.filter(held).mapInArrow(judge, schema).union(small.mapInArrow(judge, schema))
