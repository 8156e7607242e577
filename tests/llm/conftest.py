import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, size string, words string, h string"


def invented(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("the and of to a in is on an was for with more text here that") if rng.random() < 0.1 else
                    "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with null, empty, blank, long, repeated and near-equal texts; extra columns clash."""
    rng = random.Random(4)
    base = [invented(rng, 120) for _ in range(6)]
    texts = [None, "", "   \n\t ", "one", "one two three four", base[0], base[0], base[1], base[1].upper()]
    near = base[2].split()
    near[50] = "changed"
    texts += [base[2], " ".join(near), " ".join(near[:119] + ["end"]), base[3] + " " + base[4], base[4] + "\n" + base[3]]
    texts += ["x" * 30_000, "ab " * 4_000, "Ünï " * 60 + "wörd", base[5] + ".\n" + base[5] + ".\n\nshort line", "\x00 nul | > | > ! ! !"]
    rows = [(k, t, "en" if k % 2 else None, None if k % 5 == 0 else f"s{k % 3}", len(t or ""), "w", "s", "x", "h") for k, t in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, base[0], None, None, 1, None, None, None, None))
    return rows


@pytest.fixture(scope="package")
def odd_docs(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()
    yield docs
    docs.unpersist(blocking=True)  # other packages' tests look for what stays persisted


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
