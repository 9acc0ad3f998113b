import random

import pytest

WORDS = "the of and river stone cloud maple winter signal copper garden window letter market silver forest animal bridge candle dragon".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "er"]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with every odd case: (doc_id, text, lang, source)."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 8, 60, 120, 300])) for _ in range(40)]
    texts = list(base)
    for k in range(0, 40, 3):
        words = base[k].split()
        for j in range(rng.choice([1, 1, 2, 6])):
            words[(7 * j + 3) % len(words)] = f"edit{j}"
        texts.append(" ".join(words))  # near copies
    texts += [base[5], base[5].upper(), base[7].replace(" ", "\n"), base[9] + "  "]  # copies of several kinds
    passage = prose(rng, 70)
    texts += [prose(rng, 50) + " " + passage + " " + prose(rng, 40) for _ in range(3)]
    texts += [passage + "\n" + passage, "a" * 900, "ab " * 400, prose(rng, 4000), "", " \n\t ", None, None, "x", "éé ñ 中文 😀 " * 60, "one two three four"]
    out = [(i, t, ["en", "fr", None][i % 3], ["a", None, "b"][i % 3]) for i, t in enumerate(texts)]
    return out + [out[3], out[3], (None, base[2], "en", "a"), (1, base[30], "en", "a")]


SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that the operators use inside or return.
CLASHES = ["_rid", "left", "kept", "shard", "n_words", "component_id", "score", "host", "class", "part", "path", "_part", "n", "at"]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return stored(spark, rows)


def stored(spark, rows, clashes=False):
    """The rows as a stored table, which the operators may read more than once."""
    import tempfile

    path = tempfile.mkdtemp() + "/documents.parquet"
    df = spark.createDataFrame(rows, SCHEMA)
    if clashes:
        for c in CLASHES:
            df = df.selectExpr("*", f"'kept as it was' AS `{c}`")
    df.coalesce(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return stored(spark, [])


@pytest.fixture(scope="session")
def clashing(spark, rows):
    return stored(spark, rows, clashes=True)
