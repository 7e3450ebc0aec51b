import zlib

import numpy as np

from maskwright.llm.classify import FEATURES, Discriminant, Model, fit, quality_scores, statistics


def test_fit_equals_plain_formula():
    rng = np.random.default_rng(2)
    d, rule = len(FEATURES), Discriminant()
    xs = [rng.normal(k, 1 + k, (80 + 40 * k, d)) for k in (0, 1)]
    sums = np.stack([np.c_[np.ones(len(x)), x].T @ np.c_[np.ones(len(x)), x] for x in xs])
    model = fit(sums, rule)
    pooled = sum(np.cov(x.T, bias=True) * len(x) for x in xs) / 200
    log, probe = [], rng.normal(0.5, 2, (9, d))
    for k, x in enumerate(xs):
        c = 0.7 * np.cov(x.T, bias=True) + 0.3 * pooled
        c = 0.9 * c + 0.1 * np.diag(np.diag(c)) + 1e-4 * np.eye(d)
        r = probe - x.mean(axis=0)
        log.append(np.log(len(x) / 200) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", r, np.linalg.inv(c), r))
    assert np.allclose(model.margin(probe), log[1] - log[0])
    assert ((model.score(probe) >= 0.5) == (log[1] >= log[0])).all()


def test_one_class_or_none():
    sums = np.zeros((2, 4, 4))
    assert fit(sums, Discriminant()) == 0.5
    sums[1, 0, 0] = 3
    assert fit(sums, Discriminant()) == 1.0


def test_held_out_accuracy_and_no_leak(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for k, r in got.items())
    told = {r.doc_id: r.quality for r in labels.collect()}
    test = [(told[k], got[k].score) for k in told if got[k].held_out]
    good, bad = np.array([s for q, s in test if q]), np.array([s for q, s in test if not q])
    auc = ((good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2).item()
    accuracy = np.mean([(s >= 0.5) == q for q, s in test])
    print("auc", auc, "accuracy", accuracy)
    assert auc > 0.97 and accuracy > 0.95
    # labels of held-out rows change nothing
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_scores(docs, flipped).collect()}
    assert all(abs(again[k] - r.score) < 1e-9 for k, r in got.items())


def test_odd_texts(docs, corpus, spark, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 9) for i in range(30)] + [(None, 1, 9), (3, None, 9), (4, 7, 9)], "doc_id long, quality int, text int")
    got = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    assert len(got) == len(corpus) and all(0 <= s <= 1 for s in got.values())
    empty = [got[r[0]] for r in corpus if not r[1]]
    assert len(set(empty)) == 1
    assert quality_scores(no_docs, labels).count() == 0
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert statistics(np.zeros(0, np.uint8), np.zeros(1, np.int64)).shape == (0, len(FEATURES))
