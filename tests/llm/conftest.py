import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bits int, key string, norm string, " \
         "features string, component string, part int"


def words(seed: int, n: int) -> str:
    own = random.Random(seed)
    return " ".join("".join(own.choices("abcdefghijklmnop", k=own.randint(2, 8))) for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    columns with names that operators use themselves."""
    base = words(1, 120)
    near = base.replace(base[300:310], "zzzz zzzzz", 1)
    passage = words(2, 40)
    key = "AKIA" + "Q" * 20
    texts = [
        (1, None), (2, ""), (3, " \n\t \n"), (4, base), (4, base), (5, base.upper()), (6, near), (7, None),
        (8, f"{passage} {words(3, 30)}\n{words(4, 12)}"), (9, f"{words(5, 9)} {passage}\n{words(4, 12)}\n{words(4, 12)}!"),
        (10, words(6, 60_000)), (11, "\U0001F600 \u0130\u212A \u6F22\u5B57 caf\u00e9 " * 30), (12, "Token"),
        (13, f"password = \"{'s3cret' * 4}\" {key} {'0a' * 12} token:short \u0130 secret='{'x' * 15}'"),
        (None, base), (None, "a text of its own"), (14, "x" * 49), (15, "x" * 200), (16, "x" * 51), (17, "one\ntwo\none"),
    ]
    return [(d, t, None if k % 5 == 0 else ("en", "fr")[k % 2], None if k % 7 == 0 else f"s{k % 3}",
             None if k % 3 == 0 else len(t or ""), k, "key", None, "f", "c", 1) for k, (d, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def pairs():
    return [(r[0], r[1]) for r in edge_rows()]


@pytest.fixture(scope="session")
def small(spark):
    """(path, documents, [(doc_id, text)]) of the smallest tables."""
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return SF_SMALL, docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
