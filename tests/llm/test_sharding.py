import zlib

from maskwright.llm.sharding import shard_by_bytes


def test_matches_running_sum(docs, corpus):
    got = {r.doc_id: r for r in shard_by_bytes(docs, 7).collect()}
    sizes = [(r[0], len((r[1] or "").encode()) + 8) for r in sorted(corpus)]
    total, before, slots = sum(n for _, n in sizes), 0, {}
    for key, n in sizes:
        shard = min(6, (2 * before + n) * 7 // (2 * total))
        assert (got[key].size, got[key].shard, got[key].slot) == (n, shard, slots.setdefault(shard, 0))
        slots[shard] += 1
        before += n
    assert all(got[r[0]].text_crc32 == zlib.crc32((r[1] or "").encode()) for r in corpus)


def test_ties_nulls_and_no_rows(spark, docs, no_docs):
    assert shard_by_bytes(no_docs).count() == 0
    rows = [(None, "x", 1)] * 3 + [(7, None, 2)] * 40
    got = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string, size int"), 4).collect()
    assert len(got) == 43
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_plan_has_no_python(docs):
    plan = shard_by_bytes(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
