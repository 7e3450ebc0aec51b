"""Whole results of queries whose SQL holds a part, against Python."""

import base64
import hashlib
import re

import __spark_entry__ as entry
from maskwright.functions import patterns as P
from maskwright.plans import people

SF = "/root/testdata/sf0.01"


def test_name_rule_over_all_documents(spark):
    rule = re.compile(rb"(?i)\b(?:the of|EREN|Then|tion)\b")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.redacted for r in entry.queries()["name_rule_redact"](spark, SF).collect()}
    assert got == {k: hashlib.md5(rule.sub(b"Contributor", t.encode())).hexdigest() for k, t in docs.items()}


def test_variants_at_all_alignments(spark):
    want = []
    for r in people._secrets(spark, SF).collect():
        s = r.secret
        if len(s) < 12 or " " in s or any(p in s.lower() for p in P.FALSE_SECRET_PARTS_B64):
            continue
        for pad in range(3):
            v = base64.b64encode(b"\0" * pad + s.encode()).decode()[[0, 2, 3][pad] :]
            v = v[: -(len(v) % 4 or 4)] if len(v) > 8 else v
            if len(v) >= 16:
                want.append((r.o_orderkey, v))
    got = [(r.o_orderkey, r.variant) for r in entry.queries()["b64_variants"](spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(got) > 0
