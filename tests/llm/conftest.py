import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, found string, grp int"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and extra columns with clashing names."""
    rng = random.Random(7)
    vocabulary = ["alpha", "beta", "gamma", "delta", "ünïcode", "naïve", "x", "y", "zeta,", "omega."]
    prose = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(n))
    shared = [prose(80) for _ in range(4)]
    texts = [None, "", " \t\n", "one", "a " * 200, "ab " * 130 + "c", "a b " * 90, prose(49), prose(50), prose(51), shared[0], shared[0], shared[0] + "\n" + prose(10)]
    for i in range(40):
        texts.append(prose(rng.randrange(60)) + " " + rng.choice(shared)[rng.randrange(30) :] + "\n" + prose(rng.randrange(60)) + rng.choice(["", " " + rng.choice(shared)]))
    near = shared[1].split()
    for i in range(15):
        copy = list(near)
        copy[rng.randrange(len(copy))] = "changed"
        texts.append(" ".join(copy) + rng.choice(["", ".", " tail"]))
    texts += ["a " * 90 + prose(30), "line one here\n" * 30, "# $ % " * 20 + prose(60), prose(3000) + " " + shared[2]]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None]), None if t is None else len(t), "row", "found", 1) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [rows[5], rows[9], (None, shared[0], "en", "s1", 3, None, None, None), (None, None, None, None, None, None, None, None), (3, prose(120) + " " + shared[0], "en", "s1", 1, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
