from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"word{k}" for k in range(400)]


def prose(seed: int, n: int) -> str:
    """n words in a fixed order that depends on the seed."""
    return " ".join(WORDS[(seed * 7919 + k * k * 31 + k * (seed + 3)) % len(WORDS)] for k in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows and repeated ids."""
    rows = [(k, prose(k, 40) + "\nshared line\n" + prose(k + 50, 9), "en", f"s{k % 3}", 1) for k in range(14)]
    rows += [(100 + k, "Same  Text here, twice over", "en", "hot", 1) for k in range(9)]
    rows += [(200, None, None, None, None), (201, "", "en", "", 0), (None, "no id", "en", "s0", 5), (None, None, None, None, None), ((1 << 62) + 1, "an id beyond a float's digits", "en", "s0", 1),
             (202, prose(3, 30_000), "de", "s1", 1), (203, " \t\n \x0b", "fr", "s2", 4), (204, "École À la ÉTÉ", "fr", "s2", 4),
             (205, "dup", "en", "s1", 3), (205, "dup", "en", "s1", 3), (205, "other text of the same id", "en", "s1", 3)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
