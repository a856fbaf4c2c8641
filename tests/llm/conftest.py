from __future__ import annotations

import random

import pytest
from larder.llm import registry

CLASHES = ("fp", "size", "pattern", "draw", "score", "n_tokens", "uses", "copies", "best", "node", "root", "k", "t", "x", "d", "h")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    registry._shipped(spark.sparkContext)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(3000)]


@pytest.fixture(scope="session")
def rows(words):
    """doc_id, text, source: nulls, empty, blank, very long, copies, near copies, repeated rows, equal keys, no anchors."""
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = text(200), text(110)
    near = base.split()
    near[77] = "changed"
    out = [(i, text(rng.randint(1, 150)), f"s{i % 3}") for i in range(40)]
    out += [(100, base, "s0"), (101, base, "s1"), (102, " ".join(near), "s0")]
    out += [(110 + i, f"{text(60)}\n{passage}\n{text(60)}", "s1") for i in range(6)]
    out += [(120, "The of and\t in  to IS", "s2"), (121, "ΣΑΣ İstanbul <|endoftext|> it's 3½ 日本語 👩‍👧", "s2")]
    out += [(130, None, "s0"), (131, "", None), (132, " \n\t", "s0"), (None, text(90), "s1"), (None, None, None)]
    out += [(140, text(80), "s2")] * 2 + [(141, text(70), "s0"), (141, text(75), "s0")]
    out += [(150, text(30_000), "s1"), (151, "a" * 3000, "s2"), (152, "ab" * 900, "s2")]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with other columns whose names the operators might like to use."""
    extra = ", ".join(f"{c} string" for c in CLASHES)
    data = [(*r, *[f"{c}!" for c in CLASHES]) for r in rows]
    return spark.createDataFrame(data, f"doc_id long, text string, source string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
