import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, h int, slice int, node string, keys string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tessera.llm.common import ship
    ship(spark)


def words(rng, n):
    return " ".join(rng.choice("ab cd efg hij klm no pqrs tu vwx yz lorem ipsum dolor sit amet".split()) + rng.choice("aeiou") for _ in range(n))


def texts(seed=3):
    """Copies, near copies, shared passages, ties, repeated rows, nulls, empty and long texts, odd characters."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(60, 140)) for _ in range(6)]
    passage = words(rng, 70)
    out = list(base)
    out += [base[0], base[0], base[1]]  # exact copies
    for b in base[:3]:  # near copies
        w = b.split(" ")
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += [words(rng, 20) + "\n" + passage + "\n" + words(rng, 15) for _ in range(3)]
    out += ["x" * 1200, "y" * 450 + " tail", None, None, "", "", " \n ", "one", "two words", "é" * 300 + words(rng, 40) + "漢字 😀",
            words(rng, 3000), "ß\0nul\ttab  two  spaces", "1234 5678 !!! ???"]
    return out


@pytest.fixture(scope="session")
def rows():
    t = texts()
    out = [(i, x, ["en", "de", None][i % 3], f"s{i % 2}", None, "k", 1, 2, "n", "z") for i, x in enumerate(t)]
    out.append(out[2])  # a repeated row
    out.append((None, t[4], "en", None, None, None, None, None, None, None))  # a null id
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
