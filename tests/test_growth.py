"""What must not grow with the corpus: broadcasts, rows and bytes of one task, passes over the texts."""

from maskwright.operators import audio


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_recordings_are_not_broadcast(spark):
    rows = spark.createDataFrame([("a", 4000, [7, -7] * 400)], "file string, sr int, samples array<short>")
    spans = spark.createDataFrame([("a", 0.05, 0.1, "r", "x")], "file string, start double, end double, reason string, heard string")
    done = audio.finished(rows, spans, spark.createDataFrame([], "file string, s double, e double"))
    plan = plan_of(done)
    top = plan[: plan.index("[file#", plan.index("Join")) + 1]
    assert "ShuffledHashJoin" in top and "BuildRight" in plan[plan.index("ShuffledHashJoin") :].splitlines()[0]
    assert [len(r.samples) for r in done.collect()] == [800]


def test_records_are_dealt_and_taken_apart_in_stretches(spark, monkeypatch):
    import json

    from maskwright.operators import records
    from maskwright.plans import checks

    assert checks._record(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4
    rows = [(f"f{i}", json.dumps({"00100010": {"vr": 5 if i == 3 else "PN", "Value": [i]}})) for i in range(9)] + [("x", None), ("y", "[]")]
    monkeypatch.setattr(records, "STRETCH", 50)
    got = records.flattened(spark.createDataFrame(rows, "file string, content string").coalesce(1), "content", "file").collect()
    assert sorted((r.file, r.vr, r.grp, r.value) for r in got) == [(f"f{i}", "5" if i == 3 else "PN", 16, str(i)) for i in range(9)]


def test_many_needles_take_one_reading(spark):
    import random

    from maskwright.operators import gates

    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("aBß1# é") for _ in range(n))
    texts = [(i, None if i == 7 else word(draw.choice((0, 1, 5, 40, 200)))) for i in range(120)]
    some = [t[a : a + n].swapcase() for _, t in texts if t and len(t) > 90 for a, n in ((3, 70), (5, 33), (0, 9), (len(t) - 6, 6))]
    values = sorted({v for v in [*some, *(word(n) for n in (1, 1, 2, 2, 3, 4, 5, 90)), "a"] if any(c in "aB1" for c in v)})
    seen = spark.createDataFrame(texts, "id long, text string")
    got = gates.needle_hits(seen, "id", "text", spark.createDataFrame([(v,) for v in values], "v string"), "v", mode="upper", least=1, at_once=3)
    assert plan_of(got).count("MapInArrow places") == 1
    want = {(v, i) for i, t in texts for v in values if t and v.upper() in t.upper() and any(c in "AaBb1" for c in v)}
    assert {(r.value, r.doc) for r in got.collect()} == want and len(want) > 100


def test_pixels_of_an_image_are_dealt(spark):
    from pyspark.sql import functions as F

    from maskwright.operators import images

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        pixels = spark.range(4000).select(F.lit("i").alias("image"), (F.col("id") % 50).cast("int").alias("x"), F.floor(F.col("id") / 50).cast("int").alias("y"), F.lit(1.0).alias("value"))
        boxes = spark.sql("SELECT 'i' AS image, array(named_struct('x0', 0L, 'y0', 0L, 'x1', 10L, 'y1', 10L)) AS boxes")
        out = images.masked(pixels, boxes, spark.sql("SELECT 'i' AS image, 5.0D AS fill"))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2000 and out.filter("value = 5").count() == 100
        assert out.columns == ["image", "x", "y", "value"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_archives_go_through_one_after_another(spark):
    import tracemalloc

    import pyarrow as pa

    from maskwright.functions import media

    rows = [[{"name": f"{i}.bin", "content": bytes([i, k]) * 50_000} for i in range(20)] for k in range(20)]
    entries = pa.array([*rows, None, []], media._ENTRIES)
    tracemalloc.start()
    packed = media.zip_of.func(entries)
    back = media.zip_entries.func(packed)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 10_000_000 < back.nbytes  # Python's own bytes: those of one archive
    assert back.to_pylist() == [*rows, None, []] and media.zip_entries.func(pa.array([b"PK?", None], pa.binary())).to_pylist() == [None, None]


def test_hits_are_given_back_before_a_batch_ends(spark, monkeypatch):
    from maskwright.operators import gates

    monkeypatch.setattr(gates, "FLUSH", 2)
    texts = spark.createDataFrame([(i, "say needle, other pin") for i in range(7)], "id long, text string").coalesce(1)
    hits = gates.needle_hits(texts, "id", "text", spark.createDataFrame([("needle",), ("other",)], "v string"), "v")
    assert sorted((r.doc, r.value) for r in hits.collect()) == [(i, v) for i in range(7) for v in ("needle", "other")]
