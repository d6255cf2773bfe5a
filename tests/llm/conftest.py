import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, place int, row string, "
          "slot int, band int, score string, group_fp string, n_bytes int, item int")


def prose(seed: int, words: int) -> str:
    chance = random.Random(seed)
    return " ".join("".join(chance.choice("abcdefghilmnorstuv") for _ in range(chance.randint(2, 9))) for _ in range(words))


def edge_rows() -> list[tuple[int | None, str | None, str | None, str | None]]:
    """(doc_id, text, lang, source): nulls, empty and very long texts, copies,
    near copies, a shared passage, repeated rows."""
    passage = prose(99, 60)
    base = prose(1, 300)
    rows = [(10, base, "en", "a"), (11, base, "en", "a"), (12, base + " end", "en", "a"), (13, base, None, None),
            (20, None, "en", "a"), (21, "", "fr", "b"), (22, " \n\t ", "fr", "b"), (23, None, None, None),
            (None, prose(2, 40), "en", "a"), (None, None, None, None), (None, base, "en", "b"),
            (30, prose(3, 30_000), "en", "a"), (31, "x" * 5000, "en", "b"), (32, "ab " * 900, "en", "b"), (33, "é" * 301 + " ñandú", "es", "b")]
    rows += [(40 + i, f"{prose(200 + i, 30)} {passage} {prose(300 + i, 30)}", "en", "c") for i in range(6)]
    rows += [(60, prose(7, 80), "en", "c")] * 3
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, lang, s, len(t) if t else 0, "k", 1, "r", 2, 3, "s", "g", 4, 5) for i, t, lang, s in edge_rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
