import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from maskwright.llm.packing import CapacityTree, encoder, pack, plan_best_fit
from maskwright.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(reference, corpus, spark):
    own = encoder(tokenizer_path()).ids
    texts = [r[1] or "" for r in corpus] + ["a  b", " lead", "x \n y", "x\n y", "a\xa0 b", "it's  don't<|endoftext|> 12 3456", "<|endoftext|>", "a <|endoftext|><|endoftext|>  b<|endoftext", "x  <|endoftext|>\n y", "　x   y", "tail ", "tail\n"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for t in texts:
        assert own(t).tolist() == reference(t), t[:80]


def sequential_best_fit(counts, capacity):
    bins = []
    for n in sorted((k for k, c in counts.items() for _ in range(c)), reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= n]
        if fits:
            min(fits, key=lambda b: capacity - sum(b)).append(n)
        else:
            bins.append([n])
    return Counter(sum(b) for b in bins)  # equally full sequences are interchangeable


def test_plan_equals_sequential_best_fit():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice([8, 13, 64])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 80)))
        bins = defaultdict(list)
        for p in plan_best_fit(counts, capacity):
            for k in range(p.last - p.first):
                s = p.sequence + k // p.each
                assert sum(bins[s]) == p.offset + k % p.each * p.length
                bins[s].append(p.length)
        assert sorted(bins) == list(range(len(bins)))
        assert Counter(sum(b) for b in bins.values()) == sequential_best_fit(counts, capacity)


def test_tree():
    rng = random.Random(2)
    t, used = CapacityTree(37), set()
    for _ in range(500):
        x = rng.randint(0, 37)
        (used.discard if rng.random() < 0.5 else used.add)(x)
        t.set(x, x in used)
        low = rng.randint(0, 37)
        assert t.least(low) == min((u for u in used if u >= low), default=None)


def test_round_trip(docs, corpus, reference):
    rows = pack(docs, tokenizer_path(), keep_ids=True).collect()
    text = {r[0]: r[1] for r in corpus}
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(own) == set(text)
    for key, parts in own.items():
        parts.sort(key=lambda r: r.start)
        ids = [i for r in parts for i in r.ids]
        assert ids == [*reference(text[key]), 0] and all(r.doc_tokens == len(ids) for r in parts)
        assert [r.start for r in parts] == list(range(0, len(ids), 1024))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert sorted(sequences) == list(range(len(sequences)))


def test_repeated_rows_and_no_rows(spark, no_docs):
    assert pack(no_docs, tokenizer_path()).count() == 0
    got = pack(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string"), tokenizer_path()).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3
