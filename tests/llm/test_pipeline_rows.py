"""Stages of the pipeline judge rows, not ids."""

from __future__ import annotations

import random

import pyarrow.parquet as pq

import corpus_pipeline
from test_models_and_search import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(n: int) -> list[str]:
    r = random.Random(7)
    return [" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60)) for _ in range(n)]


def kept(spark, stage, rows):
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.text) for r in stage(spark, frame, SF).collect()), key=repr)


def test_simhash_stage_keeps_every_row_that_is_no_copy(spark):
    a, b, c, d, e, f = texts(6)
    rows = [(None, a), (None, b), (None, b), (3, c), (None, c), (5, d), (5, c), (6, e), (6, f), (7, a)]
    # 7 stands for the null row of a; one null row of b stays; 5 keeps d, its copy of 3 goes; both rows of 6 stay
    want = [(7, a), (None, b), (3, c), (5, d), (6, e), (6, f)]
    assert kept(spark, corpus_pipeline.simhash_stage, rows) == sorted(want, key=repr)


def test_decontaminate_stage_judges_rows(spark):
    item = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()["text"][0]
    a, b, c = texts(3)
    rows = [(None, a), (None, f"{b} {item}"), (2, f"{a} {item}"), (2, c), (3, None)]
    want = [(None, a), (2, c), (3, None)]
    assert kept(spark, corpus_pipeline.decontaminate_stage, rows) == sorted(want, key=repr)
