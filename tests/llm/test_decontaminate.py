import random
import re

import numpy as np

from maskwright.llm.decontaminate import Index, Leak, item_words, leaks, within


def tokens(t):
    return re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", (t or "").lower())


def best(item, text):
    """Least edits to a stretch, row by row."""
    cost = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(cost[j] + (w != x), cost[j + 1] + 1, new[j] + 1))
        cost = new
    return min(cost)


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        at = rng.randrange(len(w))
        w[at : at + rng.choice([0, 1])] = rng.choice([[], ["zz%d" % rng.randrange(999)]])
    return w


def make(rng):
    vocabulary = [f"w{i}" for i in range(800)]
    line = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(100 + i, " ".join(line(n))) for i, n in enumerate([14, 20, 33, 45, 59, 59, 9, 5, 3])]
    docs = []
    for i in range(150):
        body = line(rng.choice([5, 80, 300]))
        if i % 3 == 0:
            w = items[rng.randrange(len(items))][1].split()
            at = rng.randrange(len(body) + 1)
            body[at:at] = edited(rng, w, rng.randint(0, len(w) // 4 + 1))
        docs.append((i, rng.choice([" ", ", "]).join(body).replace("w1", "W1")))
    return docs + [(900, None), (901, ""), (902, "...")], items + [(800, None), (801, ""), (802, items[0][1])]


def test_matches_brute_force(spark):
    docs, items = make(random.Random(6))
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string").repartition(4)
    rows = leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.edits for r in rows}
    want = {}
    for key, t in docs:
        for item, u in items:
            w = tokens(u)
            if w and (e := best(w, tokens(t))) <= len(w) // 5:
                want[key, item] = e
    assert len(rows) == len(got) and set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.99 * len(want) > 20
    text = {d: tokens(t) for d, t in docs}
    for r in rows:
        w = tokens(dict(items)[r.item_id])
        assert best(w, text[r.doc_id][r.first_word : r.end_word]) == r.edits and r.n_item_words == len(w)


def test_passes_agree(spark):
    docs, items = make(random.Random(8))
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, leaks(frame, bench, rule=Leak(items_at_once=n)).collect())) for n in (4096, 5))
    assert [x[:4] for x in one] == [x[:4] for x in many]


def searchable(items):
    return Index([w for _, w in items], Leak())


def test_buckets_find_the_candidates(spark):
    """Without the walks' buckets nothing is found, as only they name candidates; with them copies are."""
    rng = np.random.default_rng(5)
    items = [(i, rng.integers(1, 2**63, 30, dtype=np.uint64)) for i in range(20)]
    index = searchable(items)
    assert (index.walks > 0).all()
    h = np.concatenate([w for _, w in items])
    assert {m[1] for m in index.search(h, np.zeros(len(h), np.int64), 1)} == set(range(20))
    index.buckets = {n: type(t)(t.key[:0], t.value[:0]) for n, t in index.buckets.items()}
    assert index.search(h, np.zeros(len(h), np.int64), 1) == []


def test_common_runs_take_bounded_memory():
    """A run that a text holds 3,000 times and every item holds: 300,000 hits, looked at a part at once."""
    import tracemalloc

    rng = np.random.default_rng(6)
    run, between = (rng.integers(1, 2**63, n, dtype=np.uint64) for n in (4, 1))
    items = [(i, np.r_[run, rng.integers(1, 2**63, 26, dtype=np.uint64)]) for i in range(100)]
    index = searchable(items)
    h = np.r_[np.tile(np.r_[run, between], 3000), items[7][1]]
    tracemalloc.start()
    found = index.search(h, np.zeros(len(h), np.int64), 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [m[1] for m in found] == [7] and peak < 100e6


def test_recall_on_copies_with_all_allowed_edits():
    rng = np.random.default_rng(3)
    items = [(i, rng.integers(1, 2**63, int(rng.integers(14, 60)), dtype=np.uint64)) for i in range(60)]
    index = searchable(items)
    found = n = 0
    for i, w in items:
        for _ in range(5):
            x = w.copy()
            x[rng.choice(len(x), len(x) // 5, replace=False)] = rng.integers(1, 2**63, len(x) // 5, dtype=np.uint64)
            pad = rng.integers(1, 2**63, 30, dtype=np.uint64)
            h = np.r_[pad, x, pad]
            n += 1
            found += any(m[1] == i for m in index.search(h, np.zeros(len(h), np.int64), 1))
    assert found >= 0.98 * n


def test_recall_by_length_and_kind_of_edit():
    rng = np.random.default_rng(4)
    new = lambda n: rng.integers(1, 2**63, n, dtype=np.uint64)
    items = [(i, new(n)) for i, n in enumerate([40] * 8 + [120] * 4 + [250] * 2)]
    index = searchable(items)
    for kind in ("insert", "replace", "remove"):
        for i, w in items:
            for _ in range(6):
                x, k = w.copy(), len(w) // 5
                if kind == "insert":
                    x = np.insert(x, np.sort(rng.integers(0, len(x), k)), new(k))
                elif kind == "replace":
                    x[rng.choice(len(x), k, replace=False)] = new(k)
                else:
                    x = np.delete(x, rng.choice(len(x), k, replace=False))
                h = np.r_[new(30), x, new(30)]
                assert any(m[1] == i for m in index.search(h, np.zeros(len(h), np.int64), 1)), (kind, len(w))


def test_within():
    a = item_words(["a b c d e"])[0]
    t = item_words(["x y a b q c d e z"])[0]
    assert within(a, t, 1) == (1, 2, 8) and within(a, t, 0) is None


def test_no_rows(spark, no_docs, docs):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert leaks(no_docs, bench).count() == 0 and leaks(docs, bench.limit(0)).count() == 0
