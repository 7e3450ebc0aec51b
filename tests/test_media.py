import struct
import zlib

import numpy as np

from maskwright.functions import media, patterns as P
from maskwright.sources import readers, writers


def chunk(kind, body=b""):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def test_image_metadata():
    head = b"\x89PNG\r\n\x1a\n"
    keep = [chunk(b"IHDR", b"x" * 13), chunk(b"IDAT", b"data"), chunk(b"IEND")]
    assert media.without_metadata(head + keep[0] + chunk(b"tEXt", b"secret") + keep[1] + chunk(b"eXIf", b"gps") + keep[2]) == head + b"".join(keep)
    plain = head + b"".join(keep)
    assert media.without_metadata(plain) is plain
    seg = lambda m, body: bytes([0xFF, m]) + struct.pack(">H", len(body) + 2) + body
    scan = b"\xff\xda\x00\x04ab\xff\xe1rest"
    assert media.without_metadata(b"\xff\xd8" + seg(0xE0, b"JFIF") + seg(0xE1, b"Exif") + seg(0xED, b"irb") + scan) == b"\xff\xd8" + seg(0xE0, b"JFIF") + scan
    for odd in (b"", b"GIF89a", head, head + b"\x00\x00", b"\xff\xd8", None):
        assert media.without_metadata(odd) == odd


def plain_snap(samples, sr, a, b, lo, hi):
    """Steps of one frame, one by one."""
    w, n = max(1, int(P.FRAME_SECONDS * sr)), len(samples)
    ends = []
    for at, limit, way in ((int(a * sr), int(max(0, a - 3, lo) * sr), -1), (int(b * sr), int(min(n, (b + 3) * sr, hi * sr)), 1)):
        quiet = 0
        while (at - w > limit) if way < 0 else (at + w < limit):
            x = samples[at - w : at] if way < 0 else samples[at : at + w]
            level = 20 * np.log10(np.sqrt(sum(float(v) ** 2 for v in x) / len(x)) / 32768 + 1e-12) if len(x) else -99.0
            quiet = quiet + 1 if level < -45 else 0
            if quiet >= 9:
                break
            at += way * w
        ends.append(at)
    return max(0.0, ends[0] / sr), min(n / sr, ends[1] / sr)


def test_silence_snap_and_beep():
    rng, sr = np.random.default_rng(1), 1000
    loud = np.repeat(rng.integers(0, 2, 40), 250)[:9000]
    samples = (rng.normal(0, 3000, 9000) * loud).astype(np.int16)
    for a, b, lo, hi in ((3.0, 4.0, 0.0, 1e9), (0.1, 0.2, 0.0, 1e9), (8.5, 9.5, 0.0, 1e9), (5.0, 5.5, 4.9, 5.6)):
        assert media.snapped(samples, sr, a, b, lo, hi) == plain_snap(samples, sr, a, b, lo, hi)
    out = media.beeped(samples, 8000, [(0.2, 0.6), (5.0, 4.0)])
    assert (out[:1600] == samples[:1600]).all() and (out[4800:] == samples[4800:]).all() and out[1600] == 0
    assert media.goertzel(out[1800:4600], 8000) > 0.99 and media.goertzel(np.zeros(5, np.int16), 8000) == 0
    assert media.frame_db(np.zeros(0)) == -99.0


def test_files_round_trip(spark, tmp_path):
    samples = np.arange(-500, 500, dtype=np.int16)
    (tmp_path / "a.wav").write_bytes(media.wav_of(8000, samples))
    (tmp_path / "b.wav").write_bytes(b"RIFFxxxxWAVEjunk")
    got = readers.recordings(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0].sr == 8000 and got[0].samples == samples.tolist()
    rows = [("z1", 1, "b.txt", b"two"), ("z1", 0, "a.txt", b"one"), ("z2", 0, "c.txt", b"")]
    archive = writers.archives(spark.createDataFrame(rows, "archive string, ordinal int, entry string, content binary")).collect()
    for r in archive:
        (tmp_path / f"{r.archive}.zip").write_bytes(bytes(r.content))
    (tmp_path / "broken.zip").write_bytes(b"PK?")
    got = {(r.archive[-6:-4], r.entry): bytes(r.content) for r in readers.zip_contents(spark, str(tmp_path)).collect()}
    assert got == {(a, e): c for a, _, e, c in rows}


def test_text_readers(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# note\n\n alice \nbob\n")
    assert {r.token for r in readers.tokens(spark, str(tmp_path / "t.txt")).collect()} == {"alice", "bob"}
    (tmp_path / "r.txt").write_text("abc==>X\nregex:a+==>Y\n")
    assert {tuple(r) for r in readers.rules(spark, str(tmp_path / "r.txt")).collect()} == {("literal", "abc", "X"), ("regex", "a+", "Y")}
    (tmp_path / "m.json").write_text('{"John": "P1"}')
    assert [tuple(r) for r in readers.mapping(spark, str(tmp_path / "m.json")).collect()] == [("John", "P1")]
    (tmp_path / "s.json").write_text('[{"Secret": "abc"}, {"Secret": "abc"}, {"Other": 1}]')
    assert [r.Secret for r in readers.secret_reports(spark, str(tmp_path / "s.json")).collect()] == ["abc"]
    import pytest

    (tmp_path / "none.txt").write_text("# nothing\n")
    with pytest.raises(ValueError):
        readers.tokens(spark, str(tmp_path / "none.txt"), required=True)


def test_key_is_carried_forward(spark, tmp_path):
    from maskwright.streaming.incremental import carry_forward, current_key

    folder, batch = str(tmp_path / "key"), lambda *x: spark.createDataFrame([(v,) for v in x], "identity string")
    add = carry_forward(folder)
    add(batch("b", "a", None), 0)
    add(batch("c", "a"), 1)
    add(batch("zzz"), 1)  # run again after a failure: already done
    assert {r.identity: r.n for r in current_key(spark, folder).collect()} == {"a": 1, "b": 2, "c": 3}
