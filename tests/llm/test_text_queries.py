"""Whole queries of the text operators against their SQL, and their edge cases."""

import os

import pytest

from tallyline.llm import license_scan, quality_rules
from tallyline.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id BIGINT, text STRING, n_words STRING, ledger STRING"
EDGES = [
    (1, None), (2, ""), (3, " \n\t\n"), (4, "a"), (5, "cc by cc by. ALL Rights-reserved"),
    (6, "a b c d e " * 4), (6, "a b c d e " * 4), (7, "x\nx\ny\n\ny "), (8, "é ü|# *"),
    (9, "word " * 30_000), (None, "general public license"),
    (10, "Licensed under the really Apache License, Version 2.0!"),
    (11, "Permission is hereby granted, free of charge, to any person who obtains"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in EDGES], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sql_rows, spark_rows, name):
    tables = {
        t: spark.read.parquet(f"{SF_DIR}/{t}.parquet")
        for t in ("documents", "pages", "embeddings", "benchmark", "conversations")
    }
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == sql_rows(ORACLES[name], **tables)


def test_rules_on_edges(edges):
    rows = quality_rules.ledger(edges).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r.ledger for r in rows}
    assert by[1][:6] == by[2][:6] == by[3][:6] == (0, 0, 0, 0, 0, 0)
    assert by[6].n_repeat_words == 20 and by[7].n_dup_lines == 1
    assert by[8].word_chars == 5 and by[8].n_symbols == 3
    assert by[9].n_repeat_words == by[9].n_words == 30_000
    assert all(r.n_words == "clash" for r in rows)
    assert quality_rules.ledger(edges.limit(0)).count() == 0
    kept = quality_rules.kept(edges)
    assert kept.columns == edges.columns
    assert [(r.doc_id, r.n_words, r.ledger) for r in kept.collect()] == [(11, "clash", "clash")]


def test_ablations_count_each_rule(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b c d e " * 4), (3, None)], "doc_id BIGINT, text STRING")
    rows = {
        (r.policy, r.rule): r[2:]
        for r in quality_rules.ablations(quality_rules.ledger(docs)).collect()
    }
    assert rows["base-1", "few_words"] == (3, 2, 2, 1)
    assert rows["base-1", "repeated_passages"] == (3, 1, 1, 2)


def test_license_edges(edges):
    rows = license_scan.scan(edges).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r for r in rows}
    assert (by[5].n_base, by[5].first_word, by[5].last_word) == (3, 0, 4)
    assert by[5].base_labels == "cc-by,reserved"
    assert by[None].base_labels == "gpl" and by[1].labels == "" and by[1].first_word is None
    assert by[10].labels == "apache-2.0" and by[10].n_base == 0 and 0.6 < by[10].score < 1
    assert by[11].labels == "" and by[9].n_words == 30_000
    assert license_scan.scan(edges.limit(0)).count() == 0


def test_license_places_across_pieces(spark, monkeypatch):
    """Places do not depend on how a long text is cut."""
    text = "x " * 4094 + "all rights reserved cc by " * 3
    docs = spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")
    row = license_scan.scan(docs).first()
    assert (row.n_base, row.first_word, row.last_word) == (6, 4094, 4107)
