import datetime as dt
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF0001, rows
from pitchlake import catalog
from pitchlake.operators import incremental
from pitchlake.sinks.landing import land_days, landed_days, log_days, read_log, write_landing
from pitchlake.sources import fixtures
from pitchlake.sources.drift import DriftError, wider
from pitchlake.sources.landing import read_landing, tree_range
from pitchlake.sources.local import from_local_batches
from pitchlake.sources.lookup import read_lookup_csv, with_source_file, write_lookup_csv


def test_landing_tree_zero_padded_and_string_partitions(spark, tmp_root):
    ev = fixtures.read_table(spark, SF0001, "events")
    write_landing(ev, tmp_root, "ts")
    local = tmp_root.replace("file:", "")
    assert os.path.isdir(f"{local}/y=2024/m=01/d=05")
    back = read_landing(spark, tmp_root)
    assert dict(back.dtypes)["m"] == "string"
    assert back.count() == ev.count()
    assert "y" not in spark.read.parquet(f"{tmp_root}/y=2024/m=01/d=05").columns  # values live in the path only


def test_date_range_prunes_partitions(spark, tmp_root):
    ev = fixtures.read_table(spark, SF0001, "events")
    write_landing(ev, tmp_root, "ts")
    df = read_landing(spark, tmp_root, start="2024-01-10", end="2024-01-12", date_col="ts")
    assert {f.split("/d=")[1][:2] for f in df.inputFiles()} == {"10", "11", "12"}
    assert read_landing(spark, tmp_root, start="2031-01-10", end="2031-01-12").count() == 0
    want = ev.filter(F.to_date("ts").between("2024-01-10", "2024-01-12")).count()
    assert df.count() == want


def test_dynamic_overwrite_replaces_one_day(spark, tmp_root):
    ev = fixtures.read_table(spark, SF0001, "events")
    write_landing(ev, tmp_root, "ts")
    day = ev.filter(F.to_date("ts") == "2024-01-05").withColumn("value", F.lit(-1.0))
    write_landing(day, tmp_root, "ts", mode="dynamic")
    back = read_landing(spark, tmp_root)
    assert back.count() == ev.count()
    assert back.filter("value = -1.0").count() == day.count()


def test_latest_missing_and_range(spark, tmp_root):
    ev = fixtures.read_table(spark, SF0001, "events")
    kept = ev.filter(F.dayofmonth("ts") <= 20).filter(F.dayofmonth("ts") != 7)
    write_landing(kept, tmp_root, "ts")
    landed = read_landing(spark, tmp_root)
    assert incremental.latest_date(landed) == dt.date(2024, 1, 20)
    empty = landed.filter(F.lit(False))
    assert incremental.latest_date(empty) == dt.date(2024, 3, 28)
    log_path = tmp_root + "-log"
    log_days(spark, log_path, spark.createDataFrame([(dt.date(2024, 1, 21),)], "day date"))
    miss = rows(incremental.missing_days(landed, "2024-01-01", "2024-01-23", log=read_log(spark, log_path)))
    assert miss == [(dt.date(2024, 1, 7),), (dt.date(2024, 1, 22),), (dt.date(2024, 1, 23),)]
    rng = incremental.landed_range(landed).first()
    assert (rng["start_date"], rng["end_date"], rng["has_new"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 20), True)
    assert incremental.landed_range(empty).first()["has_new"] is False
    assert incremental.run_if_new(incremental.landed_range(empty).first(), lambda a, b: 1) is None
    assert incremental.run_if_new(rng, lambda a, b: (a, b)) == (dt.date(2024, 1, 1), dt.date(2024, 1, 20))


def test_read_log_missing_path_is_empty(spark, tmp_root):
    assert read_log(spark, tmp_root + "-nolog").count() == 0


def test_csv_roundtrip_keeps_whitespace_and_source(spark, tmp_root):
    look = fixtures.lookup(spark, SF0001)
    write_lookup_csv(look, tmp_root)
    back = with_source_file(read_lookup_csv(spark, f"{tmp_root}/part-*.csv"))
    assert rows(back.select("key_mlbam", "name_first", "name_last")) == rows(look)
    assert back.filter(~F.col("source_file").endswith(".csv")).count() == 0


def test_land_days_logs_empty_days(spark, tmp_root):
    ev = fixtures.read_table(spark, SF0001, "events").filter(F.to_date("ts").between("2024-01-01", "2024-01-03"))
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 6)], "day date")
    log_path = tmp_root + "-log"
    land_days(spark, ev, tmp_root, log_path, days, "ts")
    logged = rows(read_log(spark, log_path).select("day", "n_rows"))
    assert [d for d, _ in logged] == [dt.date(2024, 1, d) for d in range(1, 6)]
    assert [n for _, n in logged][3:] == [0, 0] and sum(n for _, n in logged) == ev.count()
    assert rows(landed_days(spark, tmp_root)) == [(dt.date(2024, 1, d),) for d in range(1, 4)]
    assert sorted(n for _, n in logged) == sorted([0, 0, *(r["count"] for r in ev.groupBy(F.to_date("ts")).count().collect())])
    landed = read_landing(spark, tmp_root)
    assert landed.count() == ev.count()
    assert incremental.missing_days(landed, "2024-01-01", "2024-01-06", log=read_log(spark, log_path)).count() == 1


def test_land_days_opens_no_landed_file(spark, tmp_root, monkeypatch):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "event_id long, ts timestamp")
    days = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "day date")
    reads = []
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths, **_: reads.append(paths))
    land_days(spark, ev, tmp_root, tmp_root + "-log", days, "ts")
    assert reads == []
    monkeypatch.undo()
    assert rows(read_log(spark, tmp_root + "-log").select("n_rows")) == [(0,), (1,)]


def test_range_of_a_tree_from_folders_log_and_single_rows(spark, tmp_root):
    ev = fixtures.read_table(spark, SF0001, "events").filter(F.to_date("ts").between("2024-01-03", "2024-01-08"))
    write_landing(ev, tmp_root, "ts")
    # An empty day at the end, as a fetch without rows leaves it.
    spark.createDataFrame([], "event_id long").write.parquet(f"{tmp_root}/y=2024/m=01/d=09")
    found = tree_range(spark, tmp_root).first()
    assert tuple(found) == (dt.date(2024, 1, 3), dt.date(2024, 1, 8), True)
    assert tuple(tree_range(spark, tmp_root, "2024-01-05", "2024-01-06").first()) == (dt.date(2024, 1, 5), dt.date(2024, 1, 6), True)
    assert tuple(tree_range(spark, tmp_root, "2024-01-09").first()) == (None, None, False)
    assert tuple(tree_range(spark, tmp_root + "-none").first()) == (None, None, False)
    log_path = tmp_root + "-log"
    log_days(spark, log_path, spark.createDataFrame([(dt.date(2024, 1, 8), 0)], "day date, n long"), n_rows_col="n")
    assert tree_range(spark, tmp_root, log=read_log(spark, log_path)).first()["end_date"] == dt.date(2024, 1, 7)


def test_days_that_gain_columns_and_widen_types(spark, tmp_root):
    write_landing(spark.sql("SELECT 1 AS id, CAST(1.5 AS FLOAT) AS x, DATE '2024-01-01' AS day"), tmp_root, "day")
    write_landing(spark.sql("SELECT 5000000000 AS id, 2.5D AS x, 'new' AS note, DATE '2024-01-02' AS day"), tmp_root, "day")
    write_landing(spark.sql("SELECT CAST(3 AS SMALLINT) AS id, 7 AS x, DATE '2024-01-03' AS day"), tmp_root, "day")
    back = read_landing(spark, tmp_root)
    assert back.drop("y", "m", "d").schema.simpleString() == "struct<id:bigint,x:double,day:date,note:string>"
    assert rows(back, "id", "x", "note") == [(1, 1.5, None), (3, 7.0, None), (5000000000, 2.5, "new")]
    with pytest.raises(DriftError):
        write_landing(spark.sql("SELECT 'text' AS id, DATE '2024-01-04' AS day"), tmp_root, "day")
    assert read_landing(spark, tmp_root).count() == 3  # nothing was written


def test_widening():
    t = {n: T.StructType.fromDDL(f"c {n}").fields[0].dataType for n in ("tinyint", "int", "bigint", "float", "double", "decimal(10,2)", "decimal(8,4)", "string")}
    assert wider(t["tinyint"], t["int"]) == t["int"] and wider(t["bigint"], t["int"]) == t["bigint"]
    assert wider(t["int"], t["double"]) == t["double"] == wider(t["double"], t["float"])
    assert wider(t["decimal(10,2)"], t["decimal(8,4)"]) == T.DecimalType(12, 4)
    for a, b in (("bigint", "double"), ("string", "int"), ("float", "int")):
        with pytest.raises(DriftError):
            wider(t[a], t[b], "c")


def test_local_batches(spark, tmp_root):
    schema = T.StructType.fromDDL("k long, x double")
    batches = (pa.record_batch({"x": [float("nan"), 1.0 * n], "k": pa.array([n, n], pa.int32())}) for n in range(3))
    assert rows(from_local_batches(spark, batches, f"{tmp_root}/a", schema)) == [(0, 0.0), (0, None), (1, 1.0), (1, None), (2, 2.0), (2, None)]
    assert from_local_batches(spark, [], f"{tmp_root}/b", schema).count() == 0


def test_local_roundtrip_takes_no_events_through_the_driver(spark, monkeypatch):
    import duckdb

    def refuse(*_):
        raise AssertionError("rows pulled to the driver")

    monkeypatch.setattr(type(spark.range(1)), "toPandas", refuse)
    got = catalog.QUERIES["local_roundtrip"](spark, SF0001)
    con = duckdb.connect()
    for name in ("events", "nation"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF0001}/{name}.parquet')")
    want = con.sql(catalog.ORACLES["local_roundtrip"]).fetchall()
    assert want and sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
