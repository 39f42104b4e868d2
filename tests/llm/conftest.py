import random

import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING, digest STRING, `key` INT, n STRING"
WORDS = "the of and to river stone cloud winter garden music paper window silver morning letter bridge island forest market castle idiot".split()


def prose(rng, n):
    out = []
    for k in range(n):
        w = rng.choice(WORDS[:-1])
        out.append(w.capitalize() if k % 9 == 0 else w + "." * (k % 9 == 8))
    return " ".join(out)


@pytest.fixture(scope="session")
def corpus(spark):
    """Rows with nulls, empty and very long texts, ties, repeated rows, near copies, and columns whose names clash."""
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(30, 200)) for _ in range(60)]
    near = [" ".join(w if rng.random() > 0.004 else "changed" for w in base[k % 6].split()) for k in range(40)]
    texts = [*base, *base[:10], *[base[0]] * 30, *near, None, "", " \t\n ", "a", "x y", prose(rng, 30000), "É ß 日本 🙂 password = 'Zx81qqLm2Kd9'", base[3].replace(" ", "\n\t"), "\x00\x1f", "a b c d e", "A b C d E"]
    rows = [(k, t, ("en", "de", None)[k % 3], None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), "x", None, k, "y") for k, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "no id", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
