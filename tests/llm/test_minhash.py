import random
import re

import numpy as np
import pytest

from maskwright.llm.minhash import Near, components, near_duplicates, sketches

from .conftest import prose


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def check(spark, rows, rule=Near()):
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rule=rule).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"z{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("block", [1500, 7])
def test_groups_and_chains(spark, block):
    rng = random.Random(11)
    rows = []
    for _ in range(6):
        base = prose(rng, 150, 5000).split()
        chain = base
        for _ in range(10):
            rows.append(edited(rng, base, rng.choice([0, 0, 1, 2, 3, 4])))
            chain = edited(rng, chain, 2)
            rows.append(chain)
    rows = [(i, " ".join(w).replace("w1", "W1") if i % 3 else " ".join(w)) for i, w in enumerate(rows)]
    rng.shuffle(rows)
    check(spark, rows, Near(block=block))


def test_odd_texts(docs, corpus, spark, no_docs):
    check(spark, [(r[0], r[1]) for r in corpus])
    assert near_duplicates(no_docs).count() == 0
    got = near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept", "text_hash"]
    got = near_duplicates(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (2, "a b c"), (2, "a b c"), (5, "A b C")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (0, 0, True), (2, 2, True), (2, 2, True), (5, 2, False)]


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    t, pairs = 120, 60
    rows, keys, want = [], [], []
    for i in range(pairs):
        both, own = rng.integers(0, 2**63, 5 + i, dtype=np.uint64), int(rng.integers(0, 30))
        for j in range(2):
            x = np.r_[both, rng.integers(0, 2**63, own, dtype=np.uint64)]
            rows.append(np.full(len(x), 2 * i + j))
            keys.append(x)
        want.append(len(both) / (len(both) + 2 * own))
    got = sketches(np.concatenate(rows), np.concatenate(keys), 2 * pairs, t)
    assert (got != np.iinfo(np.uint64).max).all()
    alike = (got[0::2] == got[1::2]).mean(axis=1)
    assert abs(alike - np.array(want)).mean() < 0.05


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and 0 not in got
    for a, b in edges:
        assert got.get(a, a) == got.get(b, b)
