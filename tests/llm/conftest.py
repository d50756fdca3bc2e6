from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id long, text string, lang string, source string, rk long, score double, n_words string, kept int"


def sentence(rng: random.Random, n: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    """Documents with every awkward case; the last four columns clash with names that operators use or return."""
    rng = random.Random(5)
    shared, base = sentence(rng, 60), sentence(rng, 120)
    texts: list[str | None] = [None, "", " \t\n ", "...", "one", "One two", "Ünïcode É x y #*$ tail", "a\n\nb\na\nb \na", "x " * 300, "ab cd " * 90]
    texts += [sentence(rng, n) for n in (3, 30, 49, 50, 51, 90, 200)]
    texts += [shared, f"{sentence(rng, 20)} {shared} {sentence(rng, 10)}", f"{shared} {shared}", shared.upper()]
    words = base.split()
    for k in range(12):
        changed = list(words)
        for at in rng.sample(range(len(words)), k % 4):
            changed[at] = f"new{k}"
        texts.append(" ".join(changed))
    texts.append(sentence(rng, 20_000))  # very long
    out = [(i, t, ["de", "en", "fr", None][i % 4], ["src0", "src0", "src7", None, "odd"][i % 5], 7, 0.5, "x", 1) for i, t in enumerate(texts)]
    out += [out[12], out[20], out[20], (None, "no id " * 40, "en", "src1", 1, None, None, None), (None, None, None, None, None, None, None, None), (40, texts[24], "en", "src1", 0, 0.0, "", 0)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
