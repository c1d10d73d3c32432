"""A small table with every awkward row, and the same table without rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# Column names that operators use inside, or return.
CLASHES = "size start kept position block ids data score rank node rep component_id _key _row _text h n".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)

_RANDOM = random.Random(7)
WORDS = ["".join(_RANDOM.choices("abcdefghijklmnop", k=_RANDOM.randint(2, 7))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if r.random() < 0.1 else "") for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    base, shared = prose(300, 1), prose(20, 2)
    near = base.replace(" ", " X ", 2)
    return [
        (10, base),
        (11, base),
        (11, base),
        (12, near),
        (13, base.upper()),
        (14, prose(200, 3) + "\n" + shared + "\n" + prose(100, 4)),
        (15, prose(150, 5) + "\n" + shared + "\n" + prose(100, 6)),
        (16, None),
        (17, ""),
        (18, " \t\n "),
        (19, "one"),
        (20, "one"),
        (21, "é ü ▁▁ 😀 \x1c ﬁ"),
        (22, "ab " * 5000),
        (23, prose(20_000, 8)),
        (24, "\n".join([prose(8, 9)] * 30)),
        (25, "x" * 3000),
        (None, base),
        (None, None),
    ]


def awkward(spark: SparkSession) -> DataFrame:
    languages, sources = ("en", "de", None), ("b", "a", None, "c")
    rows = [
        (i, t, languages[k % 3], sources[k % 4], None if t is None else len(t), *("clash" for _ in CLASHES))
        for k, (i, t) in enumerate(texts())
    ]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def labels(spark: SparkSession) -> DataFrame:
    rows = [(i, k % 2 if k % 3 else None, (k + 1) % 2, "clash") for k, (i, _) in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score string")


def no_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
