"""The pipeline over a small corpus against plain versions of its stages."""

import random
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from maskwright.llm.packing import encoder  # noqa: E402
from maskwright.llm.queries import tokenizer_path  # noqa: E402

from .test_decontaminate import best, tokens  # noqa: E402
from .test_minhash import shingles  # noqa: E402
from .test_substring import brute as brute_repeats  # noqa: E402


def corpus(rng):
    word = lambda: rng.choice(["of", "the", "and", "to", f"n{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}e", f"house{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}"])
    prose = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(prose(30))) for i in range(3)]
    passage = prose(60)
    texts = [prose(160) for _ in range(30)]
    texts += [texts[3], [*texts[4][:80], "other", *texts[4][81:]]]  # an exact copy and a near one
    texts += [[*prose(60), *passage, *prose(60)] for _ in range(4)]
    texts += [[*prose(80), *items[1][1].split(), *prose(40)], [f"zq{i}###" for i in range(120)], ["few", "words"], ["same"] * 200]
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]
    return [*rows, (900, None, None, None, None), (None, " ".join(prose(150)), "en", "s", 1)], items


def test_stages_and_run(spark, tmp_path):
    rows, items = corpus(random.Random(12))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    of = lambda df: {r.doc_id: r.text for r in df.collect()}
    after = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/out{i}")
        docs = spark.read.parquet(f"{tmp_path}/out{i}")
        after[name] = of(docs)
    kept = after["quality_rules"]
    assert {37, 38, 39, 900}.isdisjoint(kept) and set(range(30)) <= set(kept) and None in kept
    # near-duplicates: the least id of each group stays
    sets = {k: shingles(t) for k, t in kept.items() if k is not None}
    gone = {b for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert gone == {30, 31} and set(after["near_duplicates"]) == set(kept) - gone
    # repeats
    want = brute_repeats([(k, t) for k, t in after["near_duplicates"].items() if k is not None])
    for k, (_, n, _, left) in want.items():
        assert after["repeated_passages"][k] == (" ".join(left) if n else after["near_duplicates"][k])
    holders = {32, 33, 34, 35} & set(kept)  # the quality rules judge repeated words in these too
    assert len(holders) > 1 and sum(n for _, n, _, _ in want.values()) == 60 * (len(holders) - 1) and after["repeated_passages"][None] == kept[None]
    # leaks
    leaky = {k for k, t in after["repeated_passages"].items() if any(best(tokens(u), tokens(t)) <= len(tokens(u)) // 5 for _, u in items)}
    assert leaky == {36} and set(after["benchmark_passages"]) == set(after["repeated_passages"]) - leaky
    # packing, and the same rows from run()
    ids = encoder(tokenizer_path()).ids
    packed = stages["packing"](spark, docs, str(tmp_path)).collect()
    total = {k: len(ids(t or "")) + 1 for k, t in after["benchmark_passages"].items()}
    assert {r.doc_id: r.doc_tokens for r in packed} == total and sum(r.length for r in packed) == sum(total.values())
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or -1, r.start, r.length, r.ids_crc32) for r in ran) == sorted((r.doc_id or -1, r.start, r.length, r.ids_crc32) for r in packed)
    assert re.match("[a-z_]+$", corpus_pipeline.STAGES[0][0])
