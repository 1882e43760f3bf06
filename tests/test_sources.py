"""Sources and sinks."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from trailmark.sources import readers, tables, writers


def test_csv_folder_unites_columns_and_skips_litter(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "__MACOSX").mkdir()
    (tmp_path / "a" / "x.csv").write_text("session_id,platform\ns1,ios\n")
    (tmp_path / "y.csv").write_text('platform,session_id,extra\nAndroid,s2,"a,b"\n')
    (tmp_path / "._z.csv").write_text("junk\n1\n")
    (tmp_path / "__MACOSX" / "w.csv").write_text("junk\n1\n")
    rows = readers.csv_folder(spark, str(tmp_path))
    assert {(r.session_id, r.platform, r.extra) for r in rows.collect()} == {("s1", "ios", None), ("s2", "Android", "a,b")}
    assert readers.csv_file(spark, str(tmp_path / "y.csv"), "ANDROID").count() == 1
    with pytest.raises(ValueError, match="no events"):
        readers.csv_file(spark, str(tmp_path / "y.csv"), "ios")


def test_event_store_keeps_sessions_together(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i % 9}", "Android" if i % 2 else "ios", i) for i in range(90)], "session_id string, platform string, n int")
    path = str(tmp_path / "store")
    writers.event_store(rows, path, 4)
    back = readers.parquet(spark, path)
    assert back.count() == 90 and {r.platform for r in back.select("platform").distinct().collect()} == {"android", "ios"}
    assert back.groupBy("platform", "session_id").agg(F.count_distinct("bucket").alias("n")).where("n > 1").count() == 0
    with pytest.raises(Exception, match="exists"):
        writers.event_store(rows, path, 4)


def test_summary_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "summary")
    rows = lambda day, n: spark.range(n).select(F.lit(day).alias("batch_date"), F.lit("v1").alias("model_version"), "id")
    for day, n in (("2026-01-01", 5), ("2026-01-02", 7), ("2026-01-01", 3), ("2026-01-01", 3)):
        writers.daily_summary(rows(day, n), path)
    assert {str(r.batch_date): r["count"] for r in spark.read.parquet(path).groupBy("batch_date").count().collect()} == {"2026-01-01": 3, "2026-01-02": 7}


def test_day_dedupe_and_order(spark, tmp_path):
    folder = tmp_path / "date=2026-03-25"
    folder.mkdir()
    (folder / "e.csv").write_text("record_id,kafka_partition,kafka_offset,kafka_timestamp\nb-1,0,2,20\na-0,0,1,10\nb-1,0,3,30\nc-0,1,1,40\n")
    got = readers.day(spark, str(tmp_path), "2026-03-25", "t").orderBy(F.col("kafka_timestamp").cast("long")).collect()
    assert [(r.record_id, r.kafka_offset) for r in got] == [("t:a-0", "1"), ("t:b-1", "2"), ("t:c-0", "1")]


def test_json_and_text_events(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps([{"a": {"b": 1, "c": {"d": "x"}}, "e": [1]}]))
    flat = readers.json(spark, str(tmp_path / "x.json"))
    assert flat.columns == ["a.b", "a.c.d", "e"]
    rows = spark.createDataFrame([('{"session_id": "s", "platform": "ios"}',), ("junk",)], "t string")
    assert [r.session_id for r in readers.parse_events(rows, "t").collect()] == ["s", None]
    csv = spark.createDataFrame([('s,ios,view,"a,b",,12',)], "t string")
    assert readers.parse_events(csv, "t", "csv").first().segmentation_name == "a,b"


def test_taxonomies(spark, tmp_path):
    (tmp_path / "t.csv").write_text("taxonomy_id,business_family,business_submodule,business_detail\nM01.01.01,a,b,c\n")
    (tmp_path / "t.md").write_text("# Taxonomy\n| id | family |\n| M01.01.02 | x | y | z |\n")
    (tmp_path / "bad.csv").write_text("id\n1\n")
    assert tuple(readers.taxonomy(spark, str(tmp_path / "t.csv")).first()) == ("M01.01.01", "a", "b", "c")
    assert tuple(readers.taxonomy(spark, str(tmp_path / "t.md")).first()) == ("M01.01.02", "x", "y", "z")
    with pytest.raises(ValueError, match="missing taxonomy columns"):
        readers.taxonomy(spark, str(tmp_path / "bad.csv"))


def test_summary_shape(spark):
    rows = spark.createDataFrame([("android::J1", "6039276.0", "android", "s", ["a", "b"], "True", 3), ("android::J2", None, "android", "s", [], "false", -1)], "journey_id string, customer_id string, platform string, session_id string, sequence_tokens array<string>, severe_anomaly string, cluster int")
    rows = rows.withColumns({"start_ts": F.timestamp_millis(F.lit(1774396800123)), "end_ts": F.timestamp_millis(F.lit(1774396800000)), "taxonomy_id": F.lit("M01.01.01")})
    a, b = writers.summary(rows, "2026-03-25", "v1").collect()
    assert (a.journey_id, a.customer_id, a.sequence, a.severe_anomaly, a.effective_cluster_key, a.taxonomy_id) == ("2026-03-25_android::J1", "6039276", "a,b", 1, "C:3", "M01.01.01")
    assert (a.start_time, a.end_time) == ("2026-03-25 00:00:00.123", "2026-03-25 00:00:00")
    assert (b.effective_cluster_key, b.taxonomy_id, b.severe_anomaly) == ("UNKNOWN", None, 0)


def test_large_buckets_are_split_by_session(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i % 50}", "ios", i) for i in range(500)], "session_id string, platform string, n int")
    writers.event_store(rows, str(tmp_path / "store"), 2, rows_per_file=60)
    back = readers.parquet(spark, str(tmp_path / "store")).withColumn("file", F.input_file_name())
    files = back.groupBy("bucket", "file").agg(F.count("*").alias("n")).collect()
    assert len(files) > 4 and sum(r.n for r in files) == 500
    assert back.groupBy("session_id").agg(F.count_distinct("file").alias("n")).where("n > 1").count() == 0
    writers.event_store(rows.where("n < 0"), str(tmp_path / "none"))


def rows_of(database):
    with sqlite3.connect(database) as c:
        return sorted(c.execute("SELECT batch_date, version, id, name FROM summary")), [r[0] for r in c.execute("SELECT name FROM sqlite_master WHERE name LIKE '%stage%'")]


def test_batches_are_replaced_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE summary (batch_date TEXT, version TEXT, id INTEGER, name TEXT)")
    connect = {"database": path, "timeout": 60}
    batch = lambda day, ids: spark.createDataFrame([(day, "v1", i, f"n{i}" if i % 2 else None) for i in ids], "batch_date string, version string, id int, name string").repartition(3)
    put = lambda day, ids: tables.replace_batch(batch(day, ids), "summary", {"batch_date": day, "version": "v1"}, "sqlite3", connect, 2)
    put("d1", range(7))
    put("d2", range(3))
    put("d1", range(5))
    put("d1", range(5))  # a rerun
    want = sorted([("d1", "v1", i, f"n{i}" if i % 2 else None) for i in range(5)] + [("d2", "v1", i, f"n{i}" if i % 2 else None) for i in range(3)], key=repr)
    found, stages = rows_of(path)[0], rows_of(path)[1]
    assert sorted(found, key=repr) == want and stages == []
    mixed = batch("d1", range(50, 60)).union(batch("d2", [99]))  # one task fails
    with pytest.raises(Exception, match="another batch"):
        tables.replace_batch(mixed, "summary", {"batch_date": "d1", "version": "v1"}, "sqlite3", connect)
    assert sorted(rows_of(path)[0], key=repr) == want and rows_of(path)[1] == []
    put("d2", [])
    assert {r[0] for r in rows_of(path)[0]} == {"d1"}
    for table, replace in (("sum mary", {"version": "v1"}), ("summary", {"x": "1"}), ("summary", {})):
        with pytest.raises(Exception, match="not a name|replace is empty"):
            tables.replace_batch(batch("d1", [1]), table, replace, "sqlite3", connect)
