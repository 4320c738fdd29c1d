"""Small inputs with every awkward case, and plain versions to compare with."""

from __future__ import annotations

import re

import pyarrow.parquet as pq

LONG = "Abc def, ghi jkl. " * 4000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"


def awkward(spark, partitions: int = 3):
    """Null and repeated ids, null, empty, blank and very long texts, ties, clashing columns."""
    copy = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, copy, "en", "a", 10, "x", "y"), (2, copy, "en", "a", 10, "x", "y"),
        (2, copy, "en", "a", 10, "x", "y"), (3, None, None, None, None, None, None),
        (4, "", "de", "a", 0, "x", "y"), (5, " \n\t ", "de", "b", 4, "x", "y"),
        (6, LONG, "en", "a", len(LONG), "x", "y"), (7, "Ünïcode 漢字 \U0001f642 'll <|endoftext|> x", "fr", "b", 3, "", ""),
        (8, "short", "en", None, None, None, None), (9, copy.upper() + " thirteen", "en", "a", -1, "x", "y"),
        (None, copy, "en", "a", 5, "x", "y"), (None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def table(sf_dir: str, name: str, *columns: str) -> list[tuple]:
    found = pq.read_table(f"{sf_dir}/{name}.parquet", columns=list(columns)).to_pydict()
    return list(zip(*(found[c] for c in columns)))


def lower_ascii(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
