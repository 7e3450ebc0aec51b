import hashlib
import re

import pytest

from maskwright.llm import substring


def brute(rows, window=13):
    docs = {r[0]: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows}
    least = {}
    for key in sorted(docs):
        for i in range(len(docs[key]) - window + 1):
            least.setdefault(tuple(docs[key][i : i + window]), key)
    out = {}
    for key, w in docs.items():
        gone = {i + j for i in range(len(w) - window + 1) if least[tuple(w[i : i + window])] < key for j in range(window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[key] = len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept
    return out


@pytest.mark.parametrize("flush_at", [50, None])
def test_matches_brute_force(docs, corpus, flush_at):
    got = {r.doc_id: r for r in substring.remove_repeats(docs, flush_at=flush_at).collect()}
    want = brute(corpus)
    assert got.keys() == want.keys()
    for key, (n, gone, sha, kept) in want.items():
        r = got[key]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, sha), key
        if gone:
            assert r.kept_text == " ".join(kept) and sum(b - a for a, b in r.spans) == gone
    assert got[5].source == "s" and got[5].hash == "h" and got[5]._part == 3


def test_large_group_of_copies(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(40)) + f" own{i} text{i}") for i in range(500)]
    got = {r.doc_id: r.n_removed for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)).collect()}
    assert got[0] == 0 and all(got[i] == 40 for i in range(1, 500))


def test_nulls_repeats_and_no_rows(spark, no_docs):
    assert substring.remove_repeats(no_docs).count() == 0
    text = " ".join(f"w{j}" for j in range(20))
    got = substring.remove_repeats(spark.createDataFrame([(None, text), (4, text), (4, text), (9, text), (9, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got if r.kept_text) == [(-1, 0), (4, 0), (4, 0)] and len(got) == 5
    assert sorted(r.n_removed for r in got if r.doc_id == 9) == [0, 20]
