"""Detectors and redactions against Python's own expressions, and the steps that SQL can't express against plain loops."""

import base64
import random
import re

from pyspark.sql import functions as F

from maskwright.functions import detect, patterns as P, redact
from maskwright.operators import gates, pseudonym

RNG = random.Random(7)
PIECES = ["4111 1111 1111 1111", "4539578763621486", "378282246310005", "a@b.co", "A@B.co", "x.y+z@mail.example", "123456789", "1234567890123", "12345678901234567890", "3.1234567891", "(212) 555-1234", "+44 212 555 1234", "212-555-12345", "+1 212 555 1234", " ", "\n", "é", "_", "word", ".", "-", "\u0967\u0968\u0969\u096a\u096b\u096c\u096d\u096e\u096f\u0966", "\uff12\uff11\uff12-555-\uff11\uff12\uff13\uff14", "password: hunter22", "Pass is 'abcdefg'", "https://h.example/a?x=1&token=abc&y=2", "AKIA" + "A" * 16, "sk-" + "b" * 20, "token = \"0123456789abcdef\"", "key=1"]
TEXTS = ["".join(RNG.choice(PIECES) + RNG.choice(["", " ", ", "]) for _ in range(RNG.randint(0, 12))) for _ in range(400)] + ["", None]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)


def test_patterns_equal_byte_and_str_modes(spark):
    byte = {
        P.CARD: rb"\b(?:\d[ -]?){12,18}\d\b",
        P.PHONE: rb"\b(?:\+?1[ -]?)?\(?[2-9]\d{2}\)?[ -]?\d{3}[ -]?\d{4}\b",
        P.EMAIL: P.EMAIL.encode(),
    }
    text = {P.OPS_LONG_NUMBER: r"(?<![\d.])\d{9,19}(?![\d.])", P.OPS_PHONE: r"(?<![\d.\-])(?:\+?\d{1,3}[ -]?)?\(?\d{3}\)?[ -]?\d{3}[ -]?\d{4}(?![\d.\-])"}
    every = [*byte, *text]
    for r in frame(spark).select("text", *(detect.found(F.col("text"), p).alias(f"c{i}") for i, p in enumerate(every))).collect():
        if r.text is None:
            continue
        want = [[m.group().decode() for m in re.finditer(p, r.text.encode())] for p in byte.values()] + [[m.group() for m in re.finditer(p, r.text)] for p in text.values()]
        assert [r[f"c{i}"] for i in range(len(every))] == want, r.text


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_card_numbers(spark):
    got = {r.text: r.c for r in frame(spark).select("text", detect.card_numbers(F.col("text")).alias("c")).collect() if r.text is not None}
    for t, cards in got.items():
        digits = [re.sub("[ -]", "", m.decode()) for m in re.findall(rb"\b(?:\d[ -]?){12,18}\d\b", t.encode())]
        assert cards == [d for d in digits if len(d) in (13, 14, 15, 16, 19) and d not in P.TEST_CARDS and len(set(d)) > 4 and luhn(d) and d[0] in "3456"]
    assert any(got.values())


def own(pattern):
    """A pattern on decoded text without the flag that this language doesn't need."""
    return pattern.replace("(?iU)", "(?i)").replace("(?U)", "")


def plain_mask(texts):
    emails, numbers = {}, {}
    out = []
    for t in texts:
        if t is None:
            out.append(None)
            continue
        t = re.sub(P.OPS_API_KEY, "REDACTED_API_KEY", t)
        t = re.sub(own(P.OPS_PASSWORD), lambda m: m[1] + "REDACTED_CREDENTIAL", t)
        t = re.sub(own(P.OPS_TOKEN_URL), lambda m: m[1] + "REDACTED", t)
        t = re.sub(P.EMAIL, lambda m: emails.setdefault(m[0].lower(), f"person{len(emails) + 1:03d}@example.com"), t)
        t = re.sub(r"(?<![\d.])\d{9,19}(?![\d.])", lambda m: numbers.setdefault(m[0], str(10 ** (len(m[0]) - 1) + len(numbers))), t)
        out.append(re.sub(own(P.OPS_PHONE), lambda m: "X" * len(m[0]), t))
    return out


def test_mask_pipeline_equals_a_plain_loop(spark):
    got = {r.doc_id: r.text for r in pseudonym.mask_exports(frame(spark), "doc_id", "text").collect()}
    assert [got[i] for i in range(len(TEXTS))] == plain_mask(TEXTS)


def test_private_keys_keep_their_line_ends(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----\nabc\ndef\n-----END RSA PRIVATE KEY-----"
    texts = [f"a{key}b\n{key}", key, "no PRIVATE KEY here", "", None]
    got = {r.text: r.out for r in frame(spark, texts).select("text", redact.redact_credentials(F.col("text")).alias("out")).collect()}
    for t in texts[:-1]:
        assert got[t] == re.sub(P.PEM, lambda m: P.PEM_MARK + "\n" * m[0].count("\n"), t) and got[t].count("\n") == t.count("\n")
    assert got[None] is None


def test_base64_variants_are_found_at_every_alignment(spark):
    secrets = ["correct horse battery staple 42", "x" * 24, "short", "exactly-twelve"]
    got = {r.text: r.v for r in frame(spark, secrets).select("text", redact.base64_variants(F.col("text")).alias("v")).collect()}
    for s in secrets:
        for before in ("", "a", "ab", "abc", "abcd"):
            whole = base64.b64encode((before + s + "tail").encode()).decode()
            if len(s) >= 20:
                assert any(v in whole for v in got[s]), (s, before)
        assert all(len(v) >= 16 for v in got[s])


def test_needles(spark):
    needles = ["John Smith", "Acme", "ab", None, "O'Neil-Jones"]
    texts = ["by JOHN-smith.", "johnsmithson", "xacme", "the Acme!", "oneil jones", None, "", "J o h n Smith"]
    listed = spark.createDataFrame([(n,) for n in needles], "v string")
    for at_once in (1, 20_000):
        loose = {(r.value, r.doc) for r in gates.needle_hits(frame(spark, texts), "doc_id", "text", listed, "v", mode="loose", least=4, at_once=at_once).collect()}
        tight = {(r.value, r.doc) for r in gates.needle_hits(frame(spark, texts), "doc_id", "text", listed, "v", least=4, at_once=at_once).collect()}
        canon = lambda t: re.sub("[^a-z0-9]", "", (t or "").lower())
        assert loose == {(n, i) for n in needles if n and len(canon(n)) >= 4 for i, t in enumerate(texts) if canon(n) in canon(t)}
        assert tight == {("John Smith", 0), ("Acme", 3), ("O'Neil-Jones", 4)}  # runs may be joined by nothing
    report = {r.value: (r.files, r.first, r.context) for r in gates.search_report(gates.needle_hits(frame(spark, texts), "doc_id", "text", listed, "v", least=4)).collect()}
    assert report["John Smith"] == (1, 0, "by JOHN-smith.")
    upper = {(r.value, r.doc) for r in gates.needle_hits(frame(spark, ["an ACME-x", "a c m e"]), "doc_id", "text", listed, "v", mode="upper", least=1).collect()}
    assert upper == {("Acme", 0)}


def test_name_rule_and_map(spark):
    pattern = redact.merged_name_pattern(["Ann Lee"], ["Lee", "Ann.B", ""])
    assert redact.merged_name_pattern([], []) is None
    mask = redact.map_masker({"John Smith": "P1", "Smith": "P2"})
    r = frame(spark, ["ann lee, Leeds lee Ann.B john_smith SMITH"]).select(F.regexp_replace("text", pattern, "N").alias("a"), mask("text").alias("b")).first()
    assert r.a == "N, Leeds N N john_smith SMITH" and r.b == "ann lee, Leeds lee Ann.B P1 P2"
    assert redact.map_masker({})(F.col("text")) is not None
