"""Near-duplicate groups: fast similarity sketches, banding, exact verification.

The sketch has t bins. In round i each element is thrown into a bin with a value in [i, i + 1), and a bin keeps its
least value; the first t rounds choose bins at random, round t + i throws all elements into bin i. So every bin is
filled after 2t rounds at most, mostly after the first few, and coordinates of two sets agree with the probability
of their Jaccard similarity, concentrated as for independent trials.

Sets that are equal are one class. Classes that agree in all rows of some band are candidates, and are joined in
candidate components, which hold every link. Full sets are shipped once for each member of a component, and
links are confirmed on them; components that are too large for one task are dealt in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import LOWER_VALUES, U64, bounds, cut_lineage, fmix, lean, partitions, slices, windows, words


@dataclass(frozen=True)
class Near:
    """A pair is linked if den * intersection >= num * union. rows * bands coordinates are sketched; at similarity s a pair
    is missed with probability (1 - s**rows)**bands: 4e-7 at 0.85, for the default."""

    num: int = 85
    den: int = 100
    words: int = 5
    rows: int = 5
    bands: int = 25
    #: Classes of a component that one task compares at most, and shingles of them all together (8 bytes each, some ten times as much while they are compared).
    block: int = 1500
    block_shingles: int = 1 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows, sorted in each: row and hash. Fewer than k words count as one shingle."""
    n_rows = len(offsets) - 1
    _, _, row, h = words(data, offsets, LOWER_VALUES)
    key, whole = windows(h, row, k, seed=7)
    r = row[: len(key)][whole]
    key = key[whole]
    begin = bounds(row, n_rows)
    few = np.flatnonzero((np.diff(begin) > 0) & (np.diff(begin) < k))
    if len(few):
        short = np.array([int(fmix(np.array([hash_of(h[begin[i] : begin[i + 1]])], U64))[0]) for i in few], U64)
        r, key = np.r_[r, few], np.r_[key, short]
    order = np.lexsort((key, r))
    r, key = r[order], key[order]
    new = np.r_[True, (r[1:] != r[:-1]) | (key[1:] != key[:-1])] if len(r) else np.zeros(0, bool)
    return r[new], key[new]


def hash_of(h: np.ndarray) -> int:
    """Hash of a short sequence of words, by its words and length."""
    out = 0x1234567 + len(h)
    for x in h.tolist():
        out = (out * 0x9E3779B97F4A7C15 + x) & (2**64 - 1)
        out ^= out >> 29
    return out


def sketches(row: np.ndarray, key: np.ndarray, n_rows: int, t: int) -> np.ndarray:
    """Fast similarity sketches of the rows' sets: n_rows x t values; rows without elements keep the largest value."""
    most = np.iinfo(np.uint64).max
    out = np.full(n_rows * t, most, U64)
    has = np.zeros(n_rows, bool)
    has[row] = True
    for i in range(2 * t):
        if not len(row):
            break
        x = fmix(key ^ fmix(np.array([i * 2 + 1], U64) * U64(0xA0761D6478BD642F)))
        bin_ = (x >> U64(40)) % U64(t) if i < t else np.full(len(x), i - t, U64)
        at = row * t + bin_.astype(np.int64)
        empty = out[at] == most
        # values of later rounds are larger: the round fills the value's upper bits
        value = (U64(i) << U64(54)) | ((x * U64(0xE7037ED1A0B428DB)) >> U64(10))
        np.minimum.at(out, at[empty], value[empty])
        done = (out.reshape(n_rows, t) != most).all(axis=1)
        if i and done[has].all() or done.all():
            break
        stay = ~done[row]
        row, key = row[stay], key[stay]
    return out.reshape(n_rows, t)


def _set_hash(row: np.ndarray, key: np.ndarray, n_rows: int, seed: int) -> np.ndarray:
    sums = np.zeros(n_rows + 1, U64)
    begin = bounds(row, n_rows)
    sums = np.r_[np.zeros(1, U64), np.cumsum(fmix(key ^ U64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))))]
    return fmix(sums[begin[1:]] - sums[begin[:-1]] + np.diff(begin).astype(U64))


SKETCHED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, text_hash long"


def sketched(df: DataFrame, rule: Near) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the set, and the hash of each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = rule.rows * rule.bands
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                n = len(part)
                row, key = shingle_sets(data, offsets, rule.words)
                sketch = sketches(row, key, n, t).reshape(n, rule.bands, rule.rows)
                band = np.zeros((n, rule.bands), U64)
                for j in range(rule.rows):
                    band = fmix(band * U64(0x9E3779B97F4A7C15) + sketch[:, :, j])
                band = fmix(band + np.arange(rule.bands, dtype=U64)[None, :] * U64(0xD6E8FEB86659FD93))
                size = np.bincount(row, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(size.astype(np.int64)),
                        pa.array(_set_hash(row, key, n, 1).view(np.int64)),
                        pa.array(_set_hash(row, key, n, 2).view(np.int64)),
                        pa.FixedSizeListArray.from_arrays(pa.array(band.reshape(-1).view(np.int64)), rule.bands).cast(pa.list_(pa.int64())),
                        part["text_hash"],
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "text_hash"],
                )

    return df.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, SKETCHED)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the least node of each; by alternating
    large-star and small-star steps, each of which is a sort of the edges by one end, with a checkpoint after each round."""
    pair = lambda x, y: F.struct(F.col(x).alias("a"), F.col(y).alias("b"))
    each = lambda e, *pairs: e.select(F.inline(F.array(*(pair(*p) for p in pairs))))
    e = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), narrow=True)
    for _ in range(most_rounds):
        if _is_flat(e):
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        # large star: each node links its larger neighbours to its least neighbour (or itself)
        both = each(e, ("a", "b"), ("b", "a"))
        e = with_least(both, 2 * e.count()).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        # small star: each node links its smaller neighbours and itself to its least neighbour
        e = cut_lineage(each(with_least(e, None), ("b", "m"), ("a", "m")).filter("a <> b").distinct(), narrow=True)
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")


#: A hub has at least one in so many of all ends of edges, so there are at most as many hubs.
HUB_SHARE = 500


def with_least(e: DataFrame, ends: int | None) -> DataFrame:
    """Edges with m, the least b of their a. With the number of edges given, those of hubs get it where they stand, so that no task gets all edges of a hub; the others by a shuffle."""
    least = e.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("_n"))
    if ends is None:
        return e.join(least.drop("_n"), "a")
    hubs = F.broadcast(least.filter(F.col("_n") * HUB_SHARE > ends).drop("_n"))  # fewer than HUB_SHARE rows
    return e.join(hubs, "a").unionByName(e.join(hubs, "a", "left_anti").join(least.drop("_n"), "a"))


def _is_flat(e: DataFrame) -> bool:
    """Whether every node has one edge to its root, and no root has one: then the edges are the components."""
    ends = e.select(F.inline(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("root")), F.struct(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("root")))))
    return ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("root").alias("root")).filter("up > 1 or up > 0 and root > 0").isEmpty()


class Forest:
    """Union-find over places."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def linked_pairs(sets: list[np.ndarray], rule: Near) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets.

    Tokens that one set alone holds can't be shared. A set goes on only while those left reach the required part of it; the set with
    most tokens in common is compared to all others, and so on a few times; what then is still in
    different trees is compared in blocks, by products of the token matrices.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    member = np.repeat(np.arange(n), size)
    token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:] if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    shared = count[token] > 1
    member, token = member[shared], token[shared]
    token = np.unique(token, return_inverse=True)[1]
    common = np.bincount(member, minlength=n)
    forest, out = Forest(n), []
    # a set with fewer tokens in common than num/den of its own has no link
    live = rule.den * common >= rule.num * size
    begin = bounds(member, n)
    n_tokens = int(token.max()) + 1 if len(token) else 0

    def against(i: int) -> np.ndarray:
        held = np.zeros(n_tokens, bool)
        held[token[begin[i] : begin[i + 1]]] = True
        both = np.bincount(member, weights=held[token], minlength=n)
        return (rule.den * both >= rule.num * (size[i] + size - both)) & live

    order = np.argsort(-common, kind="stable")
    hubs = 0
    for i in order:
        if not live[i]:
            continue
        if hubs >= 8:
            break
        hubs += 1
        for j in np.flatnonzero(against(i)):
            if j != i and forest.join(int(i), int(j)):
                out.append((int(i), int(j)))
        if len({forest.find(int(x)) for x in np.flatnonzero(live)}) <= 1:
            return out
    alive = np.flatnonzero(live)
    alive = alive[np.argsort(size[alive], kind="stable")]
    step = 512
    for a in range(0, len(alive), step):
        left = alive[a : a + step]
        for b in range(a, len(alive), step):
            right = alive[b : b + step]
            if rule.den * size[left].max() < rule.num * size[right].min():
                break  # sizes only grow from here
            trees_l = np.array([forest.find(int(x)) for x in left])
            trees_r = np.array([forest.find(int(x)) for x in right])
            if len(np.union1d(trees_l, trees_r)) == 1:
                continue
            both = _products(left, right, member, token, begin)
            ok = rule.den * both >= rule.num * (size[left][:, None] + size[right][None, :] - both)
            for x, y in zip(*np.nonzero(ok & (trees_l[:, None] != trees_r[None, :])), strict=True):
                if forest.join(int(left[x]), int(right[y])):
                    out.append((int(left[x]), int(right[y])))
    return out


def _products(left: np.ndarray, right: np.ndarray, member: np.ndarray, token: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, over stretches of their common tokens."""
    mine = np.concatenate([token[begin[i] : begin[i + 1]] for i in left])
    theirs = np.concatenate([token[begin[i] : begin[i + 1]] for i in right])
    used = np.intersect1d(mine, theirs)
    row_l = np.repeat(np.arange(len(left)), begin[left + 1] - begin[left])
    row_r = np.repeat(np.arange(len(right)), begin[right + 1] - begin[right])
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(used), 4096):
        part = used[lo : lo + 4096]
        m = []
        for rows, tokens, n in ((row_l, mine, len(left)), (row_r, theirs, len(right))):
            at = np.minimum(np.searchsorted(part, tokens), len(part) - 1)
            ok = part[at] == tokens
            x = np.zeros((n, len(part)), np.float32)
            x[rows[ok], at[ok]] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return np.rint(out)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Near = Near()) -> DataFrame:
    """Groups of documents whose sets of lower-cased word shingles are linked.

    Returns doc_id, n_shingles, component_id (least id that is reached by links, itself included), kept (whether it
    is the document's own) and text_hash (xxhash64 of the text: with doc_id it tells rows of one id apart). Texts with fewer words than a shingle are one shingle; null or empty texts have none and
    are linked with nothing. Equal ids are one document if their sets are equal, else documents of their own; rows that are repeated whole have equal results, and a row with a null id is a
    group of its own. An empty table gives no rows; other columns are ignored. No cap: groups of any size are compared in blocks. A text of any length is read whole
    and must fit in a task's memory some fifty times.
    """
    buckets = partitions(df.sparkSession)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = cut_lineage(sketched(docs, rule))
    # equal sets: one class, named by its least document
    filled = known.filter("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("class"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size"))
    classes = cut_lineage(classes)
    # a bucket's members are linked to its least one: as many candidate edges as entries
    entries = classes.select("class", F.explode("bands").alias("band"))
    least = entries.groupBy("band").agg(F.min("class").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "b")
    edges = cut_lineage(entries.join(least, "band").select(F.col("class").alias("a"), "b").filter("a <> b").distinct(), narrow=True)
    candidate = components(edges)
    candidate = cut_lineage(candidate.union(candidate.select(F.col("component").alias("node"), "component").distinct()), narrow=True)
    sized = candidate.join(classes.select(F.col("class").alias("node"), "size"), "node")
    joined = _confirmed(docs, edges, sized, rule, buckets)
    named = classes.select("set_a", "set_b", "class").join(joined.withColumnRenamed("node", "class"), "class", "left")
    named = named.select(F.col("set_a").alias("_a"), F.col("set_b").alias("_b"), F.coalesce("component", "class").alias("_component"))
    out = known.select("doc_id", "n_shingles", "set_a", "set_b", "text_hash").join(named, (F.col("set_a") == F.col("_a")) & (F.col("set_b") == F.col("_b")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("_component", "doc_id")
    return out.select(F.col("doc_id").alias(doc_id), "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_hash")


def _confirmed(docs: DataFrame, edges: DataFrame, candidate: DataFrame, rule: Near, buckets: int) -> DataFrame:
    """Rows (node, component) of the components of all links, which lie within the candidate components.

    candidate has columns node, component and size (shingles). A component of more than rule.block classes or rule.block_shingles shingles is dealt in blocks. First each block is compared in itself and with
    the component's hub, the class that most candidate edges lead to; in a group of near copies that links
    all of them. Then the strays, which are not linked with the hub, are compared with every block.
    """
    sizes = candidate.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("n") / rule.block), F.least("n", F.ceil(F.col("size") / rule.block_shingles))).cast("int"))
    members = cut_lineage(candidate.join(sizes.select("component", "blocks"), "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), narrow=True)
    split = members.filter("blocks > 1")
    degree = edges.groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    hubs = split.join(degree, "node").groupBy("component").agg(F.expr("max_by(node, struct(degree, -node))").alias("hub"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                row, key = shingle_sets(data, offsets, rule.words)
                begin = bounds(row, len(part))
                raw = [key[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["component"], part["groups"], part["alone"], pa.array(raw, pa.binary())], names=["node", "component", "groups", "alone", "shingles"])

    def compared(dealt: DataFrame) -> DataFrame:
        """dealt: node, component and groups, the numbers of those that the class is compared in."""
        shipped = docs.join(dealt.hint("shuffle_hash"), F.col("doc_id") == F.col("node")).select("doc_id", "text", "component", "groups", "alone").mapInArrow(sets, "node long, component long, groups array<long>, alone boolean, shingles binary")
        # groups of small components are compared together, a block of a split one by itself
        each, deal = shipped.withColumn("group", F.explode("groups")).drop("groups"), F.xxhash64("component", "group")
        return each.withColumn("deal", F.when(F.col("alone"), -1 - F.abs(deal)).otherwise(F.pmod(deal, F.lit(64 * buckets)))).drop("alone").groupBy("deal").applyInArrow(confirm, "a long, b long")

    def confirm(rows: pa.Table) -> pa.Table:
        lean()
        a_out, b_out = [], []
        node, component, group = (rows[c].to_numpy() for c in ("node", "component", "group"))
        shingles = rows["shingles"]
        order = np.lexsort((node, group, component))
        cut = np.r_[0, np.flatnonzero((np.diff(component[order]) != 0) | (np.diff(group[order]) != 0)) + 1, len(order)]
        for x, y in zip(cut[:-1], cut[1:], strict=True):
            own = order[x:y]
            own = own[np.r_[True, node[own][1:] != node[own][:-1]]] if len(own) else own
            if len(own) > 1:
                found = linked_pairs([np.frombuffer(shingles[int(i)].as_py(), U64) for i in own], rule)
                a_out += [int(node[own[i]]) for i, _ in found]
                b_out += [int(node[own[j]]) for _, j in found]
        return pa.table({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})

    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1).cast("array<long>")
    first = members.join(hubs, "component", "left").select("node", "component", F.when(F.col("node") == F.col("hub"), every("blocks")).otherwise(F.array(F.col("block").cast("long"))).alias("groups"), (F.col("blocks") > 1).alias("alone"))
    found = cut_lineage(compared(first))
    trees = components(found)
    if split.isEmpty():
        return trees
    tree = split.join(trees.withColumnRenamed("component", "tree"), "node", "left").withColumn("tree", F.coalesce("tree", "node"))
    home = tree.join(hubs.select("hub"), F.col("node") == F.col("hub")).select(F.col("component").alias("c"), F.col("tree").alias("home"))
    placed = tree.join(home, F.col("component") == F.col("c")).withColumn("stray", F.col("tree") != F.col("home"))
    strays = placed.filter("stray").groupBy("component").agg(F.greatest(F.ceil(F.count(F.lit(1)) / rule.block), F.ceil(F.sum("size") / rule.block_shingles)).cast("int").alias("stray_blocks"))
    # group s * blocks + j: the strays of stray block s, and all of block j
    placed = placed.join(strays, "component").withColumn("s", F.pmod(F.xxhash64("node", F.lit(1)), F.col("stray_blocks")))
    as_member = F.expr("transform(sequence(0, stray_blocks - 1), s2 -> cast(s2 as bigint) * blocks + block)")
    as_stray = F.expr("transform(sequence(0, blocks - 1), j -> s * blocks + j)")
    second = placed.select("node", "component", F.when(F.col("stray"), F.array_union(as_member, as_stray)).otherwise(as_member).alias("groups"), F.lit(True).alias("alone"))
    more = cut_lineage(compared(second))
    if more.isEmpty():
        return trees
    return components(more.union(trees.select(F.col("node").alias("a"), F.col("component").alias("b"))))
