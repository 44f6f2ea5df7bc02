"""Small tables for the operators' tests."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row string"


def frame(spark, texts, source=None, lang=None, ids=None):
    """Documents with two columns whose names clash with names that operators use inside."""
    rows = []
    for i, text in enumerate(texts):
        doc_id = i if ids is None else ids[i]
        n_chars = None if text is None else len(text)
        rows.append((doc_id, text, None if lang is None else lang[i], None if source is None else source[i], n_chars, "s", "r"))
    return spark.createDataFrame(rows, SCHEMA)


def rows(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
