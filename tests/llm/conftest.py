import random

import pytest

SYLLABLES = "an be ca do er fi go ha in jo ka lo me no on pa re sa ti un".split()


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)

    def make(n, kinds=400):
        pool = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(kinds)]
        return [rng.choice(pool) for _ in range(n)]

    return make


@pytest.fixture(scope="session")
def corpus(words):
    """(doc_id, text) with exact and near copies, shared passages, odd texts, null and repeated ids."""
    rng = random.Random(6)
    rows = []
    passage = words(40, 30_000)
    for i in range(120):
        w = words(rng.randint(1, 200), 5_000)
        if i % 4 == 0:
            at = rng.randrange(len(w) + 1)
            w = w[:at] + passage + w[at:]
        rows.append((i, " ".join(w)))
    for i in range(120, 160):  # copies and near copies of some
        w = rows[i % 7][1].split(" ")
        for _ in range((i % 5) * 2):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    long = " ".join(words(30_000, 9_000))
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "one"), (205, "One\ntwo  three"), (206, long), (207, long)]
    rows += [(None, rows[0][1]), (None, None), (3, rows[3][1]), (3, rows[3][1]), (208, "a b c d e f g h i j k l m " * 3)]
    rows += [(209, "Straße naïve ½ 日本 don't <|endoftext|> x"), (210, "x  y   z\r\n"), (-5, " lead and trail ")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names the operators use inside."""
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "'x' as block", "1 as n", "2 as bucket", "'y' as carried", "cast(null as string) as node")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def split(text):
    return (text or "").encode().split()
