import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, _part int"


def prose(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", ".", ",", "é"]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Null, empty and long texts, copies, shared passages, repeated rows, odd spaces."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 12, 14, 60, 200, 400]), 4000) for _ in range(40)]
    passage, line = prose(rng, 90, 4000), prose(rng, 70, 4000)
    texts = [*base, base[5], base[5], base[6], base[7] + " tail", "head " + base[7], None, None, "", " ", "\n\n", "one", "one", "a b c d e f g h i j k l m"]
    texts += [prose(rng, 30, 4000) + "\n" + passage + "\n" + prose(rng, 30, 4000) for _ in range(6)]
    texts += ["\n".join([line] * 5), line, ("same " * 500).strip(), "same " * 40 + line, "\t x\x0by\x0cz \r\n" * 30, "ñandú  €uro  " * 50, "x" * 3000, "y" * 399, "y" * 400, "y" * 401]
    texts += [prose(rng, 20000, 9000), "### %%% $$$ " + prose(rng, 80), "LOUD WORDS " * 60]
    rows = [(i, t, None if i % 11 == 0 else ("en", "fr")[i % 2], "s", len(t or ""), "h", 3) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
