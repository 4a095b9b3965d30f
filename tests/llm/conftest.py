from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, columns with clashing names."""
    rng = random.Random(5)
    words = ["ab", "c", "déf", "xxx", "yz", "the", "of", "q", "ÀÉ", "<|endoftext|>", "<s>", "don't", "12"]
    base = [rng.choice(words) for _ in range(300)]
    rows: list[tuple] = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (None, "null id of some words"), (None, None)]
    for i in range(10, 150):
        kind = rng.random()
        if kind < 0.5:
            a = rng.randint(0, 200)
            part = base[a : a + rng.randint(20, 100)]
            for _ in range(rng.randint(0, 2)):
                part[rng.randrange(len(part))] = rng.choice(words)
            rows.append((i, rng.choice([" ", "  ", "\n"]).join(part)))
        elif kind < 0.6:
            rows.append((i, "De " * rng.randint(1, 200)))
        else:
            rows.append((i, " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.randint(0, 120)))))
    rows.append((200, " ".join(rng.choice(words) + str(rng.randint(0, 9999)) for _ in range(30000))))
    rows += [rows[10], rows[12], rows[12]]
    full = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", None]), 7, 8, 9.0, "x", "y") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, fp long, n_tokens long, score double, spans string, kept string").repartition(5)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
