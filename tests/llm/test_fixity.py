import hashlib

from maskwright.llm import fixity

REPLICA = "file string, offset long, body string, digest string"


def replica(spark, rows):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], REPLICA)
    return fixity.record_digests(frame.repartition(3), "file", "offset", "body")


def brute(a, b):
    """Least differing digest of each side, by file and offset."""
    out = {}
    for side, own, other in (("a", a, b), ("b", b, a)):
        count = lambda rows, r: sum(x == r for x in rows)
        for r in own:
            if count(own, r) > count(other, r):
                key = r[0] or "", -1 if r[1] is None else r[1]
                body = (r[2] or "").encode()
                out.setdefault(key, {}).setdefault(side, []).append((hashlib.sha256(body).hexdigest(), len(body)))
    return {k: (min(v.get("a", [(None, None)])), min(v.get("b", [(None, None)]))) for k, v in out.items()}


def test_matches_brute_force_at_all_tree_heights(spark):
    a = [(f"f{i % 3}", 37 * i, f"record {i} " * (i % 7)) for i in range(300)]
    a += [("one", 0, None), ("none", 5, ""), (None, None, "x"), ("dup", 1, "same"), ("dup", 1, "same"), ("tie", 4, "p"), ("tie", 4, "q")]
    b = [r for r in a if r != a[17] and r[0] != "one"]
    b[40] = (b[40][0], b[40][1], "changed")
    b[200] = (b[200][0], b[200][1] + 1, b[200][2])
    b += [("f1", 1_000_000, "extra"), ("new", 0, "file")]
    b.remove(("dup", 1, "same"))
    b[b.index(("tie", 4, "q"))] = ("tie", 4, "r")
    want = brute(a, b)
    for range_bytes, fanout in ((1 << 20, 16), (64, 4), (1000, 3)):
        got = {(r.file, r.offset): r for r in fixity.audit(replica(spark, a), replica(spark, b), range_bytes, fanout).collect()}
        assert {k: ((r.a_digest, r.a_length), (r.b_digest, r.b_length)) for k, r in got.items()} == want
        assert got["one", 0].status == "missing" and got["new", 0].status == "extra" and got["tie", 4].status == "changed"


def test_only_differing_branches_are_descended(spark):
    """Nodes below equal roots, and below equal nodes, are never compared, whatever they hold; and what differs below is found by the nodes alone."""
    from pyspark.sql import functions as F

    rows = [(f"f{i % 4}", 100 * i, f"record {i}") for i in range(400)]
    other = [(f, o, "changed" if (f, o) == ("f1", 12100) else x) for f, o, x in rows]
    a, b = (fixity.merkle_tree(fixity.manifest(replica(spark, r)), 2048, 8) for r in (rows, other))
    assert len(a) == len(b) == 3
    node = 12100 // 2048
    assert [tuple(r) for r in fixity.differing_ranges(a, b, 8).collect()] == [("f1", True, node)]
    assert a[-1].count() == 4 and a[-1].filter("node <> 0").count() == 0
    # damaged nodes of a file whose root agrees, and of another branch of the one that differs: not looked at
    broken = [b[0].withColumn("hash", F.when((F.col("file") == "f2") | (F.col("file") == "f1") & (F.col("node") > 8), F.lit("x")).otherwise(F.col("hash"))), *b[1:]]
    assert [r.node for r in fixity.differing_ranges(a, broken, 8).collect()] == [node]
    # a tree with more levels than the other
    assert fixity.differing_ranges(fixity.grown(a, 4), a, 8).count() == 0


def test_many_records_without_place_are_spread(spark):
    rows = [(None, None, f"r{i}") for i in range(300)]
    assert fixity.merkle_tree(fixity.manifest(replica(spark, rows)))[0].count() > 250
    got = fixity.audit(replica(spark, rows), replica(spark, rows[1:])).collect()
    assert [(r.file, r.offset, r.status) for r in got] == [("", -1, "missing")]


def test_equal_and_empty_replicas(spark):
    rows = [("f", i * 10, str(i)) for i in range(50)]
    assert fixity.audit(replica(spark, rows), replica(spark, rows[::-1])).count() == 0
    none = replica(spark, rows).limit(0)
    assert fixity.audit(none, none).count() == 0
    assert {r.status for r in fixity.audit(replica(spark, rows), none).collect()} == {"missing"}
    assert fixity.audit(none, replica(spark, rows)).count() == 50


def test_plan_has_no_python(spark):
    rows = [("f", 0, "x")]
    plan = fixity.audit(replica(spark, rows), replica(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_warc_round_trip_and_damage(spark, tmp_path):
    from pyspark.sql import functions as F

    pages = [("http://a.example/é", "<p>x</p>"), ("http://b.example/", None), (None, "y" * 5000)]
    records = [bytes(r[0]) for r in spark.createDataFrame(pages, "url string, html string").select(fixity.warc_record(F.col("url"), F.col("html"))).collect()]
    whole = b"".join(records)
    (tmp_path / "a.warc").write_bytes(whole)
    got = sorted(fixity.read_warc(spark, str(tmp_path / "a.warc")).collect(), key=lambda r: r.offset)
    assert [(r.uri, bytes(r.payload)) for r in got] == [(u or "", (h or "").encode()) for u, h in pages]
    assert all(whole[r.offset : r.offset + r.length] == x for r, x in zip(got, records))
    broken = records[0].replace(b"Content-Length: 8", b"Content-Length: 9") + records[1]
    assert [x[2] for x in fixity.warc_records(broken)] == ["damaged", "resource"]
    assert list(fixity.warc_records(b"")) == [] and next(fixity.warc_records(b"junk"))[2] == "damaged"
