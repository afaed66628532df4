"""Ball-tree search, the filter audit and line dedup against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from llm_fixtures import SF0001, none, odd  # noqa: F401  (fixtures)

from conftest import rows
from pitchlake.llm import ball_tree, filter_audit, line_hash, queries

ITEMS = [(0, "w1x w2x w3x w1x"), (1, "All Rights Reserved one TWO"), (2, None), (3, ""), (4, "no-such-term ?!"), (5, "ÀÉ ñandú 漢字 line"),
         (5, "line one"), (None, "spam w7x w7x")]


def table_rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet").cache()


# --- search ------------------------------------------------------------------


def brute_search(docs, items, k=10):
    def terms(t):
        return re.findall("[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    split = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in split if c), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in split:
            if not c:
                continue
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // total
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t, q in Counter(terms(text)).items() if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none_ else d, -s) for i, (s, none_, d) in enumerate(sorted(scored)[:k])]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("table,leaf,docs_a_tree", [("odd", 2, 7), ("odd", 48, 1 << 14), ("small", 5, 64), ("none", 48, 9)])
def test_search(request, spark, monkeypatch, table, leaf, docs_a_tree):
    monkeypatch.setattr(ball_tree, "TREE_DOCS", docs_a_tree)
    monkeypatch.setattr(ball_tree.BallTree.__init__, "__defaults__", (leaf,))
    df = request.getfixturevalue(table)
    items = spark.createDataFrame([(*r, 7, "x") for r in ITEMS], "item_id long, text string, key long, row string")
    got = table_rows(ball_tree.search(df, items), "item", "rank", "key", "score")
    assert sorted(got, key=key) == sorted(brute_search(table_rows(df, "doc_id", "text"), ITEMS), key=key)


def test_search_without_items_and_in_blocks(spark, small, monkeypatch):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert ball_tree.search(small, no_items).count() == 0
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet").filter("item_id < 4")
    whole = rows(ball_tree.search(small, items))
    monkeypatch.setattr(ball_tree, "BLOCK_TERMS", 90)
    assert rows(ball_tree.search(small, items)) == whole == sorted(brute_search(table_rows(small, "doc_id", "text"), table_rows(items, "item_id", "text")))


def test_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    n, width = 3000, 400
    rows_, cols, vals = [], [], []
    for i in range(n):  # documents of twenty topics with words of their own
        c = np.unique(rng.integers(0, 20, 12) + 20 * (i % 20))
        rows_.append(len(c))
        cols.append(c)
        vals.append(rng.integers(10 ** 9, 4 * 10 ** 9, len(c)))
    indptr, cols, vals = np.concatenate(([0], np.cumsum(rows_))), np.concatenate(cols), np.concatenate(vals)
    tree = ball_tree.BallTree(indptr, cols, vals, width, 16)
    of = np.repeat(np.arange(n), rows_)
    for q in range(20):
        columns = np.arange(20 * q, 20 * q + 6)
        factors = rng.integers(1, 4, 6)
        dense = np.zeros(width, dtype=np.int64)
        dense[columns] = factors
        scores = np.zeros(n, dtype=np.int64)
        np.add.at(scores, of, vals * dense[cols])
        best = tree.search(columns, factors, 10, [], lambda r: -r)
        want = sorted(((int(s), -i) for i, s in enumerate(scores) if s > 0), reverse=True)[:10]
        assert sorted(best, reverse=True) == want
    assert tree.leaves_scored < 0.5 * 20 * len(tree.order)


# --- audit -------------------------------------------------------------------


def brute_audit(docs, labels):
    seen, fails, marks = {}, [], defaultdict(lambda: [0, 0])
    for d, q, t in labels:
        if d is not None:
            marks[d][0] |= q == 1
            marks[d][1] |= t == 1
    for d, t, _ in docs:
        if d is not None:
            seen[t or ""] = min(seen.get(t or "", d), d)
    for d, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "".join(x for x, y in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)),
            d is not None and seen[t] < d)) if y)
        fails.append((part or "", f, *(marks[d] if d is not None else (0, 0))))
    out = []
    for part in {p for p, *_ in fails}:
        mine = [x for x in fails if x[0] == part]
        total, found = Counter(), []
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(gone)
                found.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == f for x in mine),
                              sum(x[2] for x in gone), sum(x[3] for x in gone), f))
        out += [(*x[:-1], total[x[-1]]) for x in found]
    return sorted(out)


@pytest.mark.parametrize("table", ["odd", "none"])
def test_audit(request, spark, table):
    from pyspark.sql import functions as F

    df = request.getfixturevalue(table).withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.lit("en")))
    labels = [(1, 1, 0), (1, 0, 1), (2, None, None), (9, 1, 1), (13, 0, 1), (18, 1, None), (None, 1, 1), (77, 1, 1)]
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, row string")
    got = filter_audit.audit(df, marks)
    assert rows(got, *got.columns) == brute_audit(table_rows(df, "doc_id", "text", "lang"), labels)


def test_audit_query_on_its_tables(spark, small):
    labels = table_rows(spark.read.parquet(f"{SF0001}/labels.parquet"), "doc_id", "quality", "toxic")
    assert rows(queries.op12_filter_audit(spark, SF0001)) == brute_audit(table_rows(small, "doc_id", "text", "lang"), labels)


def test_audit_joins_are_anti_and_semi(spark):
    from pyspark.sql import functions as F

    level = spark.range(60).select(F.col("id").alias("row"), F.lit("en").alias("part"), F.lit(1).alias("mask"))
    fails = spark.range(0, 60, 3).withColumnRenamed("id", "row")
    gone, left = filter_audit.removed(level, fails, 2), filter_audit.survivors(level, fails, 2)
    for df, join in ((gone, "LeftSemi"), (left, "LeftAnti")):
        assert join in df._jdf.queryExecution().executedPlan().toString()
    assert rows(gone, "row", "mask") == [(i, 1) for i in range(0, 60, 3)] and rows(left, "row", "mask") == [(i, 3) for i in range(60) if i % 3]
    # Filters of the set itself remove nothing, and sets don't grow by earlier filters.
    assert filter_audit.removed(level, fails, 1).count() == 0 == filter_audit.survivors(level, fails, 1).count()


# --- lines -------------------------------------------------------------------


def brute_lines(docs):
    def line_key(x):
        k = re.sub("[A-Z]", lambda m: m[0].lower(), x.strip("\t\n\x0b\x0c\r "))
        return k if len(k) >= 10 else None

    holders = defaultdict(set)
    for d, t in docs:
        if d is not None:
            for x in (t or "").split("\n"):
                holders[line_key(x)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        left = [x for x in lines if d is None or line_key(x) is None or min(holders[line_key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return out


EXTRA = [(40, "  Shared Line Of Text \r\nshort\néééééééééé\nnine char"), (41, "shared line of text\nshort\nééééééééé\nnine char\n\n"),
         (39, "SHARED LINE OF TEXT\tx\néééééééééé"), (41, "shared line of text\nshort\nééééééééé\nnine char\n\n"),
         (None, "shared line of text"), (42, "shared line of text\nshared line of text"), (-5, "É line of twelve\n"), (43, "É LINE of twelve\né line of twelve")]


@pytest.mark.parametrize("table,bits,flush", [("odd", 0, 1 << 19), ("odd", 4, 3), ("small", None, 50), ("none", 2, 9)])
def test_lines(request, spark, monkeypatch, table, bits, flush):
    monkeypatch.setattr(line_hash, "FLUSH_ENTRIES", flush)
    df = request.getfixturevalue(table).select("doc_id", "text")
    df = df.unionAll(spark.createDataFrame(EXTRA, "doc_id long, text string")) if table == "odd" else df
    got = table_rows(line_hash.dedup(df.selectExpr("*", "1 AS key", "2 AS hashes", "3 AS shard"), bits=bits), "key", "n_lines", "n_dropped", "kept_sha256")
    assert sorted(got, key=key) == sorted(brute_lines(table_rows(df, "doc_id", "text")), key=key)


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 100, 20000):
        h = rng.integers(0, 2 ** 63, (n, 2), dtype=np.uint64)
        h[: n // 2, 0] = 5  # equal high halves are told apart by the low ones
        found = line_hash.PerfectHash(*line_hash.build_hash(h))
        assert sorted(found.positions(h).tolist()) == list(range(n))


def test_foreign_lines_are_not_in_the_arrays(spark):
    docs = spark.createDataFrame([(i, f"line number {i % 50} of them") for i in range(100)], "doc_id long, text string")
    index = line_hash.build_index(line_hash.entries(docs, "doc_id", "text", 0)).collect()
    arrays = line_hash.Arrays(index[0].asDict())
    n, first = arrays.probe(line_hash.line_hashes([b"line number 7 of them", b"not a line of any text"]))
    assert n.tolist() == [2, 0] and first.tolist() == [7, line_hash.NONE]
