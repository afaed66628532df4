"""The pipeline's stages, each on its own input, against brute force; and its edge cases."""

import random

import brute
import duckdb
import pytest
from llm_fixtures import SF0001, SF001, none, odd, prose  # noqa: F401  (fixtures)

import __spark_entry__ as entry
import corpus_pipeline
from pitchlake.llm.common import written


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = entry.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == sorted(repr([r[i] for i in at]) for r in rel.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = written(stage(spark, docs, SF0001), "stage-test")
        got = {r["doc_id"]: r["text"] for r in after.collect()} if "text" in after.columns else None
        if name == "packing":
            assert {r["doc_id"] for r in after.collect()} == set(before)
            break
        assert after.columns == docs.columns
        if name == "near duplicates":
            want = {k for k, _, c in brute.simhash_components(list(before.items())) if c == k}
            assert got == {k: before[k] for k in want}
        elif name == "repeated passages":
            want = {k: n for k, _, n, _, _ in brute.repeated_bytes(list(before.items()))}
            assert set(got) == set(before) and sum(n > 0 for n in want.values()) > 0
            assert all((got[k] == before[k]) == (n == 0) for k, n in want.items())
        elif name == "benchmark leaks":
            leaks = {k for k, *_ in brute.contained(list(before.items()), items)}
            assert got == {k: t for k, t in before.items() if k not in leaks}
        docs = after


def test_odd_rows_and_no_rows(spark, odd, none):
    for df in (odd, none):
        docs = df
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF0001), "odd-stage")
        assert docs.columns[0] == "doc_id"
        assert (docs.count() > 0) == (df.count() > 0)


def test_rows_without_an_id_and_of_one_id_are_judged_each(spark):
    rng = random.Random(11)
    a, b, c, d = (prose(rng, 200) for _ in range(4))
    docs = spark.createDataFrame([(9, b), (30, b), (30, c), (None, a), (None, a), (None, c), (40, d), (None, b)], "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, SF0001).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(9, b), (30, c), (None, a), (40, d)]))


def test_leaks_go_by_row(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect() if r["text"])
    clean = [prose(random.Random(s), 60) for s in (1, 2)]
    docs = spark.createDataFrame([(None, f"x {item} y"), (None, clean[0]), (5, f"z {item}"), (5, clean[1])], "doc_id long, text string")
    got = corpus_pipeline.leaks(spark, docs, SF0001).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(None, clean[0]), (5, clean[1])]))


def test_quality_keeps_columns_of_its_own_names(spark):
    text = prose(random.Random(3), 60)
    docs = spark.createDataFrame([(1, text, 7, "r"), (2, "few", 7, "r")], "doc_id long, text string, n_words long, rejected_by string")
    got = corpus_pipeline.quality(spark, docs, SF0001)
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [(1, text, 7, "r")]


CLASHING = ["__row", "__cut", "__words", "__lines", "__hashes", "__ordered", "__windows", "__places", "__runs", "__k", "__first", "__id", "__of",
            "__leak", "__own_n_words", "own0"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_columns_of_the_operators_own_names_come_back_unchanged(spark, name, stage):
    rng = random.Random(8)
    shared = prose(rng, 60)
    texts = [prose(rng, 80) + " " + shared, prose(rng, 70) + " " + shared, prose(rng, 90)]
    rows = [(i, t, "en", "s", len(t), *[100 * i + k for k in range(len(CLASHING))]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in CLASHING))
    out = stage(spark, docs, SF0001)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    assert sorted(map(tuple, out.select("doc_id", *CLASHING).collect())) == [(r[0], *r[5:]) for r in rows]
