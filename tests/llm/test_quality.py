import random
import re
from collections import Counter

import numpy as np

from maskwright.llm.quality import Divergence, js_distance, quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_base_counts(docs, corpus):
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert len(got) == len(corpus)
    for row in corpus:
        r = got[row[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(row[1]), row[1]
        assert not (r.base_failed and r.kept)


def test_far_histograms_are_rejected(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["of", "the", "and", "to", f"n{rng.randrange(3000)}", f"house{rng.randrange(3000)}"])
    clean = [(i, " ".join(word() for _ in range(150)), "en") for i in range(50)]
    odd = [(100, " ".join(f"zq{i}###" for i in range(120)), "en"), (101, " ".join(f"WORD{i}!!" for i in range(120)), "en")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(clean + odd, "doc_id long, text string, lang string")).collect()}
    assert not got[100].kept and not got[101].kept and all(got[i].kept != got[i].base_failed for i in range(50))
    assert sum(got[i].kept for i in range(50)) > 45


def test_small_languages_are_judged(spark):
    """Junk in a language of less than 1 in 1000 words, by references that are sent to all or joined."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"a{rng.randrange(10**6)}" if j % 4 else "the" for j in range(8000)), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(f"b{rng.randrange(3000)}" if j % 2 else ["ok", "es", "az"][j // 2 % 3] for j in range(100)), "xx") for i in range(20)]
    rows += [(2000, " ".join(f"{i}###%%%$$" for i in range(60)), "xx"), (2001, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    one, many = ({r.doc_id: r for r in quality_rules(frame, rule=rule).collect()} for rule in (Divergence(), Divergence(languages_at_once=1)))
    assert one == many and len(one) == len(rows)
    assert not one[2000].base_failed and not one[2000].kept and one[2000].class_distance > 0.3
    assert all(one[1000 + i].kept for i in range(20))


def test_failed_documents_are_not_in_the_reference(spark):
    rng = random.Random(6)
    clean = [(i, " ".join(rng.choice(["of", "the", *(f"n{rng.randrange(3000)}" for _ in range(4))]) for _ in range(150)), "en") for i in range(40)]
    junk = [(100 + i, "### $$$ %%% " * 2000, "en") for i in range(20)]
    judged = lambda rows: {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    alone, mixed = judged(clean), judged(clean + junk)
    assert all(mixed[100 + i].base_failed for i in range(20)) and all(alone[i] == mixed[i] and alone[i].kept for i in range(40))


def test_distance_bounds():
    assert js_distance(np.array([[1.0, 0]]), np.array([[0, 1.0]]))[0] == 1
    assert js_distance(np.array([[2.0, 2]]), np.array([[5.0, 5]]))[0] == 0
    assert js_distance(np.array([[0.0, 0]]), np.array([[5.0, 5]]))[0] == 0


def test_carried_columns(docs, corpus):
    got = {r.doc_id: r for r in quality_rules(docs, carry=("text", "_part")).collect()}
    assert {k: (r.text, r._part) for k, r in got.items()} == {r[0]: (r[1], r[6]) for r in corpus}


def test_no_rows(no_docs):
    assert quality_rules(no_docs).count() == 0


def test_labelled_junk_and_clean_documents(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [(labels.get(r.doc_id), r) for r in quality_rules(spark.read.parquet(f"{d}/documents.parquet")).collect()]
    assert not any(r.kept for q, r in got if q == 0)
    assert all(r.kept or r.base_failed for q, r in got if q == 1)
