"""Small fixtures: documents with the awkward cases every operator meets."""

import random

import pytest

WORDS = "the of and market price index fund yield bond stock rate risk gain loss trade open close high low volume".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 400)) for _ in range(n))


def small_documents():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared
    passages and lines, nulls, empty and long texts, odd white space."""
    rnd = random.Random(3)
    texts = []
    base = prose(rnd, 120)
    passage = prose(rnd, 50)
    for i in range(40):
        texts.append(prose(rnd, rnd.randint(3, 90)))
    texts += [base, base, base.upper()]
    words = base.split()
    for k in range(4):  # near copies: one word changed in each
        w = list(words)
        w[10 + 25 * k] = f"changed{k}"
        texts.append(" ".join(w))
    for k in range(4):  # a shared passage inside other text
        texts.append(f"{prose(rnd, 20 + k)} {passage}\n{prose(rnd, 30)}")
    texts += [passage + " " + passage, None, None, "", "", " \t\n", "one", "one", "two words", "a b c d", "a b c d",
              "same " * 60, "x" * 5000, "tabs\tand\x0bother\x0cspace\r\nwide space é 漢字 😀", prose(rnd, 6000),
              "  two  spaces \n\n and   more  ", "table | of | cells | and | bars", "mail me@example.org 12345"]
    lines = ["All rights reserved.", "Read more"]
    rows = []
    for i, t in enumerate(texts):
        if t and i % 3 == 0:
            t = t + "\n" + lines[i % 2] + "\n\n" + lines[i % 2]
        rows.append((i, t, ["en", "fr", None][i % 3], ["a", "a", "b", None][i % 4], None if t is None else len(t)))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    return small_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    # further columns whose names clash with the operators' own
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS node", "'x' AS component", "2 AS bucket", "3L AS n_words", "'y' AS stratum", "4 AS rank", "5 AS cell", "'z' AS host")
    return df.repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
