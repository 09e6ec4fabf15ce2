import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, row string, _id long, kind int"


def prose(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with copies, near copies, shared passages, nulls, empties, repeats and a very long text."""
    rng = random.Random(9)
    passage = prose(rng, 70)
    texts = [prose(rng, rng.randint(1, 150)) for _ in range(40)]
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(6)]
    texts += [texts[3], texts[3].upper(), texts[3] + " zz", passage, passage + " " + passage, None, "", " \t\n", "wort " * 80, prose(rng, 60_000), "É ÄÖ ß été\n\nneue Zeile\x0bdrei"]
    out = [(i, t, "en" if i % 3 else None, None if i % 5 == 0 else f"s{i % 4}", len(t or ""), 1, 2, "x", 3, 4) for i, t in enumerate(texts)]
    return [*out, out[3], out[41], (None, passage, "en", "s1", 1, 1, 2, "x", 3, 4), (None, None, None, None, None, 1, 2, "x", 3, 4), (2, texts[5], "de", "s2", 1, 1, 2, "x", 3, 4)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
