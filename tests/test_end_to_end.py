"""Sound, records, sinks and streams against plain versions and round trips."""

import json
import math

import pytest
from pyspark.sql import functions as F

from maskwright.functions import media, patterns as P
from maskwright.functions.unicode import nfkc
from maskwright.operators import audio, gates, identity, images, records, speech
from maskwright.sources import readers, writers
from maskwright.streaming import incremental


def test_tones(spark):
    """Every sample of a tone by the plain formula, and none outside of it."""
    sr, quiet = 4000, [7, -7] * 4000
    rows = spark.createDataFrame([("a", sr, quiet), ("none", sr, quiet)], "file string, sr int, samples array<short>")
    spans = spark.createDataFrame([("a", 0.5, 0.75, "r", "x"), ("gone", 0.0, 1.0, "r", "y")], "file string, start double, end double, reason string, heard string")
    ws = spark.createDataFrame([], "file string, s double, e double")
    (r,) = audio.finished(rows, spans, ws).collect()
    (s,) = r.spans
    assert (s.orig_start, s.orig_end) == (0.5, 0.75) and s.start < 0.5 and s.end > 0.75
    a, b = int(s.start * sr), int(s.end * sr)
    fade = int(P.BEEP_FADE * sr)
    want = [int(P.BEEP_LEVEL * min(1.0, i / fade, (b - a - i) / fade) * 32767 * math.sin(2 * math.pi * P.BEEP_HERTZ * (i / sr))) for i in range(b - a)]
    assert r.samples[:a] == quiet[:a] and r.samples[b:] == quiet[b:] and max(abs(x - y) for x, y in zip(r.samples[a:b], want, strict=True)) <= 1
    assert audio.unconfirmed_tones(audio.finished(rows, spans, ws)).count() == 0
    (w,) = audio.wav_files(audio.finished(rows, spans, ws)).collect()
    assert media.wav_samples(bytes(w.content))[1].tolist() == r.samples


def test_words_in_compatibility_forms(spark):
    t = spark.createDataFrame([("f", [(0.0, 1.0, "x", [("\uff14\uff11\uff11\uff11", 0.0, 0.1), ("\uff21\uff42\uff43.", 0.2, 0.3), ("plain", 0.4, 0.5)])])], "file string, segments array<struct<start: double, end: double, text: string, words: array<struct<w: string, s: double, e: double>>>>")
    assert [(r.c, r.n) for r in speech.words(speech.segments(t)).orderBy("pos").collect()] == [("4111", 4), ("abc", 0), ("plain", 0)]
    assert spark.createDataFrame([("\ufb01",), (None,)], "v string").select(nfkc("v").alias("v")).collect()[0].v == "fi"


def test_planned_spans_and_transcripts(spark, tmp_path):
    words = lambda text, at: [{"w": w, "s": at + i, "e": at + i + 0.5} for i, w in enumerate(text.split())]
    segs = [{"start": 0.0, "end": 9.0, "text": "my name is Zorblat", "words": words("my name is Zorblat", 0.0)}, {"start": 100.0, "end": 109.0, "text": "a hospital visit", "words": words("a hospital visit", 100.0)}]
    (tmp_path / "a.json").write_text(json.dumps({"file": "a.wav", "duration": 110.0, "segments": segs}))
    (tmp_path / "bad.json").write_text("{")
    read = readers.transcripts(spark, str(tmp_path)).filter("file is not null")
    spans = {r.reason: (r.start, r.end, r.heard) for r in speech.planned_spans(read, spark.createDataFrame([], "name string")).collect()}
    assert spans == {"name after naming cue": (2.7, 3.8, "Zorblat"), "health information": (99.7, 109.3, "a hospital visit")}
    assert [r.file for r in speech.health_spans(speech.segments(read)).collect()] == ["a.wav"]
    found = spark.createDataFrame([("a.wav", 3.0, "Zorblat", "name/digits")], "file string, s double, w string, why string")
    writers.write_survivors(speech.survivor_transcripts(speech.segments(read), found), str(tmp_path / "out"))
    (back,) = spark.read.json(str(tmp_path / "out")).collect()
    assert [x.w for x in back.survivors] == ["Zorblat"] and [x.seg for x in back.segments] == [0, 1]


def test_nested_records(spark):
    deep = {"0040A730": {"vr": "SQ", "Value": [{}, {"0040A730": {"vr": "SQ", "Value": [{"00100010": {"vr": "PN", "keyword": "PatientName", "Value": [{"Alphabetic": "A^B"}]}}]}}]}, "00091001": {"vr": "LO", "Value": [1, "b"]}, "junk": 3}
    rows = [("f", json.dumps(deep)), ("g", "{"), ("h", None), ("i", "[]"), ("j", "{}")]
    got = records.flattened(spark.createDataFrame(rows, "file string, content string"), "content", "file").collect()
    assert sorted((r.file, r.path, r.grp, r.value) for r in got) == [("f", "00091001", 9, "1\\b"), ("f", "0040A730/1/0040A730/0/PatientName", 16, "A^B")]
    many = spark.createDataFrame([("f", "p", "U", "StudyInstanceUID", "UI", 8, "1.2\\\\3.4"), ("f", "p", "C", "SOPClassUID", "UI", 8, "1.2"), ("f", "p", "E", "X", "UI", 8, "")], "file string, patient string, path string, keyword string, vr string, grp int, value string")
    out = {r.path: r.value for r in records.remapped(many, "s").collect()}
    one = spark.range(1).select(records.uid(F.lit("1.2"), "s").alias("u")).first().u
    assert out["C"] == "1.2" and out["E"] == "" and out["U"].split("\\")[0] == one
    assert spark.range(1).select(records.delivered_path(F.lit("ann/a/b.dcm"), F.lit("CT-001")).alias("p")).first().p == "CT-001/a/b.dcm"
    # a record of someone without a key has no names and no dates
    flat = spark.createDataFrame([("f", "p", "PatientName", "PatientName", "PN", 16, "A"), ("f", "p", "StudyDate", "StudyDate", "DA", 8, "20200101")], many.schema)
    assert {r.value for r in records.stamped(flat, spark.createDataFrame([], "patient string, pseudo_id string, shift_days int")).collect()} == {""}


def test_verdicts_of_nothing(spark):
    none = spark.createDataFrame([], "repo string, refs long, commits long")
    assert gates.clone_gate(none).first().verdict == "UNPROVEN"
    assert gates.findings_gate("x", none, none.select(F.col("refs").alias("n"))).first().verdict == "UNPROVEN"
    with pytest.raises(ValueError):
        from maskwright.operators import history

        history.name_tokens(none, "repo", [])
    texts = spark.createDataFrame([("a", "x")], "path string, text string")
    rows = gates.delivery_gates(none.select(F.col("refs").alias("n")), texts, spark.createDataFrame([("r", "equal")], "repo string, status string"), none.select(F.col("refs").alias("n")), spark.createDataFrame([(True,), (False,)], "violation boolean"))
    assert {r.gate: r.verdict for r in rows.collect()} == {"names": "PASS", "integrity": "PASS", "syntax": "FAIL", "paths": "PASS"}


def test_name_rule_with_extras(spark):
    ids = spark.createDataFrame([("Anna Maria Lee Smith <a@b>",), ("Bo <b@c>",), ("Jo Brandt <c@d>",)], "identity string")
    assert identity.name_rule(identity.name_parts(ids), extra=["Al", "Di Ng"], exclude=["anna"]) == (["Anna Maria Lee Smith", "Jo Brandt", "Di Ng"], ["Smith", "Al"])


def test_tiles():
    boxes = images.tile_boxes(3500, 2000)
    assert len(boxes) == 71 and boxes[0] == (0, 0, 3500, 162) and boxes[1] == (0, 162, 300, 257) and boxes[2] == (580, 162, 700, 232)


def test_sinks(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    key = spark.createDataFrame([("B <b>", 2), ("A <a>", 1)], "identity string, n long")
    writers.write_mailmap(key, at("map"))
    assert [r.value for r in spark.read.text(at("map")).collect()] == ["Contributor 1 <contributor1@example.com> A <a>", "Contributor 2 <contributor2@example.com> B <b>"]
    writers.write_persona_key(key, at("key"))
    assert spark.read.json(at("key")).count() == 2 and (tmp_path / "key").stat().st_mode & 0o777 == 0o700
    writers.write_rules(spark.createDataFrame([(2, "b", "y"), (1, "a==", "x")], "ordinal int, lhs string, rhs string"), at("rules"))
    assert sorted(r.value for r in spark.read.text(at("rules")).collect()) == ["a====>x", "b==>y"]
    writers.write_manifest(spark.createDataFrame([("r", 1, 1, "OK")], "repo string, commits long, authors long, status string"), at("manifest"))
    assert spark.read.option("header", True).csv(at("manifest")).first().repo == "r"
    writers.write_spans(spark.createDataFrame([("f", 1.0, 2.0, "r", "h")], "file string, start double, end double, reason string, heard string"), at("spans"))
    assert spark.read.json(at("spans")).first().spans[0].reason == "r"
    texts = spark.createDataFrame([("John/a.txt", "by John")], "path string, text string")
    writers.write_masked(texts, lambda c: F.regexp_replace(c, "John", "P"), at("masked"))
    assert tuple(spark.read.parquet(at("masked")).first()) == ("P/a.txt", "by P")
    digests = writers.file_digests(readers.files(spark, at("manifest"), "*.csv")).collect()
    assert digests and all(len(d.sha256) == 64 for d in digests)
    out = spark.createDataFrame([("ann/f.dcm", "ann", "PatientName", "PatientName", "PN", 16, "CT-001")], "file string, patient string, path string, keyword string, vr string, grp int, value string")
    writers.write_elements(out, spark.createDataFrame([("ann", "CT-001", -400)], "patient string, pseudo_id string, shift_days int"), at("elements"))
    assert spark.read.parquet(at("elements")).first().file == "CT-001/f.dcm"


def test_trees_and_exports(spark, tmp_path):
    for name, body in (("src/a.PY", "x = 1"), ("vendor/b.py", "y"), ("c.exe", "z"), ("d.csv", "q"), ("e.png", "p")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.collect())
    assert names(readers.source_files(spark, str(tmp_path))) == ["a.PY"]
    assert names(readers.text_exports(spark, str(tmp_path))) == ["d.csv"] and names(readers.images(spark, str(tmp_path))) == ["e.png"]
    spark.createDataFrame([("r", "s", "blob", 1, bytearray(b"x"))], readers.OBJECTS).write.parquet(str(tmp_path / "objects"))
    assert readers.objects(spark, str(tmp_path / "objects")).count() == 1
    (tmp_path / "r.dcm.json").write_text('{"00100010": {"vr": "PN", "keyword": "PatientName", "Value": ["A"]}}')
    assert [(r.patient, r.value) for r in readers.dicom_json(spark, str(tmp_path / "r.dcm.json")).collect()] == [(tmp_path.name, "A")]


def test_watch_on_new_texts(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([(1, "4539 5787 6362 1486", "2024-01-01 00:01:00"), (2, "nothing", "2024-01-01 00:02:00"), (3, "4539578763621486", "2024-01-01 00:03:00")], "doc_id long, text string, at string").select("doc_id", "text", F.to_timestamp("at").alias("ts")).write.parquet(str(source))
    stream = spark.readStream.schema("doc_id long, text string, ts timestamp").parquet(str(source))
    run = incremental.windowed_findings(incremental.watched_findings(stream)).writeStream.format("memory").queryName("seen").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(90)
    assert [(r.cards, r.credentials) for r in spark.table("seen").collect()] == [(2, 0)]


def test_painted_words(spark):
    pixels = spark.createDataFrame([("i", x, y, 10.0 * y + x) for x in range(20) for y in range(20)], "image string, x int, y int, value double")
    words = spark.createDataFrame([("i", 5, 6, 4, 2), ("i", 1, 1, 2, 2)], "image string, x int, y int, w int, h int")
    got = {(r.x, r.y): r.value for r in images.painted(pixels, words).collect()}
    for (x, y), v in got.items():
        second = 2 <= x <= 12 and 3 <= y <= 11
        first = x <= 6 and y <= 6
        assert v == (10.0 * 7 + 2 if second else 10.0 * 2 + 0 if first else 10.0 * y + x), (x, y)


def test_first_examples(spark):
    assert [r.id for r in gates.examples(spark.range(30), ["id"], 5).collect()] == [0, 1, 2, 3, 4]
