"""Small tables for the edge cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, size string, text_ string"

LONG = "lorem ipsum dolor sit amet " * 4000

ROWS = [
    (1, "the cat sat on the mat and looked at the dog all day long while rain fell on the old tin roof", "en", "a", 1, "x", "y", None),
    (1, "the cat sat on the mat and looked at the dog all day long while rain fell on the old tin roof", "en", "a", 1, "x", "y", None),
    (2, "", "en", "a", 0, None, None, None),
    (3, None, None, None, None, None, None, None),
    (None, "a row without an id", "fr", "b", 5, None, None, None),
    (4, LONG, "es", "b", len(LONG), None, None, None),
    (5, " \t\n ", "de", None, 3, None, None, None),
    (6, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" äöü 日本 ▁ \U0001f600', "de", "c", 3, None, None, None),
]


def docs(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
