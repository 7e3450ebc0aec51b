import hashlib
import random

import pytest

from maskwright.llm import suffix


def brute(rows, length, keep_first):
    docs = sorted((r[0], (r[1] or "").encode()) for r in rows)
    n, first = {}, {}
    for key, t in docs:
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            n[s] = n.get(s, 0) + 1
            first.setdefault(s, (key, i))
    out = {}
    for key, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            if n[s] > 1 and not (keep_first and first[s] == (key, i)):
                gone[i : i + length] = b"\1" * length
        left = bytes(b for b, g in zip(t, gone) if not g)
        out[key] = len(t), sum(gone), bytes(gone).replace(b"\0", b" ").split().__len__(), hashlib.sha256(left).hexdigest()
    return out


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("flush_at,chunk", [(50, 1000), (None, suffix.CHUNK)])
def test_matches_brute_force(docs, corpus, keep_first, flush_at, chunk):
    small = [r for r in corpus if len(r[1] or "") < 20000]
    frame = docs.filter("text is null or length(text) < 20000")
    got = {r.doc_id: r for r in suffix.remove_repeated_strings(frame, keep_first=keep_first, flush_at=flush_at, chunk=chunk).collect()}
    want = brute(small, 400, keep_first)
    assert got.keys() == want.keys()
    for key, w in want.items():
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w, key
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert got[5].source == "s" and got[5]._part == 3


def test_short_strings_with_many_meetings(spark):
    rng = random.Random(9)
    parts = ["".join(rng.choice("ab ") for _ in range(60)) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts)[: rng.randrange(20, 60)] for _ in range(12))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in suffix.remove_repeated_strings(frame, length=40, k=8).collect()}
    for key, w in brute(rows, 40, False).items():
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w, key


@pytest.mark.parametrize("keep_first", [False, True])
def test_segments_that_differ_in_one_task_only(spark, keep_first):
    """The text of document 5 in one partition; the same and a near copy of it in the other, whose edges hash to either side."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    left, right = [], []
    for i in range(0, 160, 20):
        whole = text(900)
        near = whole[:450] + text(450) if i % 40 else text(450) + whole[450:]
        left.append((i + 5, whole))
        right += [(i + 10, whole), (i + 11, near)]
    left += [(1000 + i, None) for i in range(len(right) - len(left))]  # halves of equal size
    frame = spark.createDataFrame(spark.sparkContext.parallelize(left + right, 2), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix.remove_repeated_strings(frame, keep_first=keep_first).collect()}
    for key, w in brute(left + right, 400, keep_first).items():
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w, key


@pytest.mark.parametrize("seed", range(4))
def test_any_partitioning(spark, seed):
    """Whole copies in one task, parts of them in another: the result is the same however rows are dealt."""
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = []
    for i in range(0, 90, 3):
        whole = text(1500)
        cut = rng.randrange(300)
        rows += [(i, text(200) + whole + text(300)), (i + 1, text(100) + whole), (i + 2, whole[cut : cut + 1200])]
    want = brute(rows, 400, False)
    dealt = [rows[::3], rows[1::3] + rows[2::3]] if seed == 0 else [[] for _ in range(rng.randrange(2, 9))]
    if seed:
        for r in rows:
            rng.choice(dealt).append(r)
    frames = [spark.createDataFrame(x, "doc_id long, text string").coalesce(1) for x in dealt if x]
    frame = frames[0]
    for x in frames[1:]:
        frame = frame.union(x)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeated_strings(frame, flush_at=rng.choice([None, 40])).collect()}
    assert got == want


def test_long_texts_that_share_passages(spark):
    """Texts of several chunks; repeats are known by construction, as all else is random."""
    rng = random.Random(3)
    noise = lambda n: rng.randbytes(n // 2).hex()
    shared = [noise(30_000) for _ in range(3)]
    rows = [(i, noise(500_000) + shared[i] + noise(300_000) + shared[(i + 1) % 3] + noise(400_000)) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in suffix.remove_repeated_strings(frame).collect()}
    for i, t in rows:
        assert got[i].n_bytes == len(t)
        # a byte or two beside a passage may agree by chance
        assert 60_000 <= got[i].n_removed <= 60_020 and got[i].n_spans == 2


def test_lengths_out_of_reach(spark, no_docs):
    with pytest.raises(ValueError):
        suffix.remove_repeated_strings(no_docs, length=5000)


def test_lpf_array():
    rng = random.Random(4)
    for _ in range(40):
        t = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40)))
        want = [max((n for j in range(i) for n in range(len(t) - i + 1) if t[j : j + n] == t[i : i + n]), default=0) for i in range(len(t))]
        assert suffix.lpf_array(t).tolist() == want


def test_no_rows(spark, no_docs):
    assert suffix.remove_repeated_strings(no_docs).count() == 0
    got = suffix.remove_repeated_strings(spark.createDataFrame([(None, "z" * 900), (1, None), *[(2, "".join(map(str, range(400))))] * 2], "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 0, 0]
