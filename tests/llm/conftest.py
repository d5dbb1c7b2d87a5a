import random

import pytest

#: Null and empty texts, repeated rows, one id with two texts, null ids, clashing column names.
ODD = [
    (1, "", "a"), (2, None, None), (3, "one", "b"), (3, "one", "b"), (4, "two words\n\nand more", "b"), (4, "another text of id four", None), (None, "no id at all here", "a"), (None, None, None),
    (7, "mail a.b+c@x-y.example.org or a@b.c_d@e.f, 10.0.0.255, 10.0.0.256, 1.2.3.4.5.6.7.8 and +1 (017) 555-7713", "a"), (8, "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000000000000", "a"),
    (9, "x" * 5000, "b"), (10, "Licensed under the Apache License, Version 2.0. cc-by nc; UNDER THE MIT License CC BY-NC 4.0", "c"), (11, "é É ß ½ 日本語 ▁ 😀 <|endoftext|> \\ [INST]", "c"),
]


def words(rng, n):
    return " ".join(rng.choice(["al", "be", "ce", "di", "eo", "fu", "ga", "hi", "jo", "ku"]) + rng.choice(["ra", "so", "ti", "vu", "wo", "xy"]) + rng.choice(["", "n", "m", "s", "lt"]) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    rng = random.Random(5)
    rows = list(ODD)
    for k in range(100, 180):
        base = words(rng, rng.randint(20, 400))
        rows.append((k, base, "s"))
        if k % 5 == 0:
            rows.append((k + 1000, base, "s"))
            w = base.split(" ")
            for j in range(3):
                v = list(w)
                v[rng.randrange(len(v))] = f"new{j}"
                rows.append((k + 2000 + 100 * j, " ".join(v), "s"))
    return rows


@pytest.fixture(scope="session")
def documents(spark, texts):
    names = "doc_id long, text string, source string, bucket string, h string, rep string, t_text string, toxic_score string, words string"
    return spark.createDataFrame([(i, t, s, "b", "h", "r", "t", "x", "w") for i, t, s in texts], names).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
