"""Scans and sinks on files written here."""

import json

from pyspark.sql import functions as F

from foliospark.sources import readers, sinks
from foliospark.streaming import events


def test_manifest_and_overrides(spark, tmp_path):
    (tmp_path / "m.csv").write_text("acNumber,total_parts\n 1 ,442.0\n2,\n,7\n3,x\n")
    got = {r.ac: r.parts for r in readers.manifest(spark, str(tmp_path / "m.csv")).collect()}
    assert got == {"1": 442, "2": None, "3": None}
    (tmp_path / "o.json").write_text(json.dumps({"2": 5, "9": 1}))
    assert {(r.ac, r.parts) for r in readers.json_map(spark, str(tmp_path / "o.json")).collect()} == {("2", 5), ("9", 1)}
    (tmp_path / "bad.json").write_text("{")
    assert readers.json_map(spark, str(tmp_path / "bad.json")).count() == 0
    assert readers.json_map(spark, str(tmp_path / "none.json")).count() == 0


def test_inventory_and_keys(spark, tmp_path):
    d = tmp_path / "AC_001"
    d.mkdir()
    (d / "AC_001_PART_0007.pdf").write_bytes(b"%PDF-" + b"x" * 1019)
    (d / "12_8.pdf").write_bytes(b"%PDF-" + b"x" * 1018)
    inv = readers.inventory(spark, str(tmp_path)).select(readers.keys_of_path().alias("k"), readers.is_valid_file().alias("ok"))
    assert {(r.k.ac, r.k.part, r.ok) for r in inv.collect()} == {(1, 7, True), (12, 8, False)}
    (tmp_path / "keys.txt").write_text("001, 2 # not 3\n010\n2\n")
    assert sorted(r.key for r in readers.key_list(spark, str(tmp_path / "keys.txt")).collect()) == ["1", "10", "2"]


def test_csv_upsert_and_info(spark, tmp_path):
    df = spark.createDataFrame([(1, "=x", ["a", "b"]), (2, None, [])], "k int, t string, why array<string>")
    sinks.write_csv(df, str(tmp_path / "c"), rows_per_file=1, compress=True, guard=True)
    back = spark.read.csv(str(tmp_path / "c"), header=True)
    assert {(r.k, r.t, r.why) for r in back.collect()} == {("1", " =x", "a|b"), ("2", None, None)} and len(list((tmp_path / "c").glob("*.gz"))) >= 2
    sinks.write_csv(df.coalesce(1), str(tmp_path / "m"), mark=True)
    assert next((tmp_path / "m").glob("part-*.csv")).read_bytes().startswith(b"\xef\xbb\xbfk,t,why")
    assert [r.path.rsplit("/", 1)[1] for r in readers.listing(spark, str(tmp_path), "part-*", recursive=True).collect()] and readers.listing(spark, str(tmp_path / "m"), "part-*").count() == 1
    root = str(tmp_path / "t")
    sinks.upsert(spark, root, None, "1", df.select("k", "t"), ["k"])
    new = sinks.upsert(spark, root, "1", "2", spark.createDataFrame([(2, "n"), (3, "m")], "k int, t string"), ["k"])
    assert {(r.k, r.t) for r in new.collect()} == {(1, "=x"), (2, "n"), (3, "m")}
    s = spark.createDataFrame([(10, 5, True), (10, 12, True), (10, 5, False)], "a int, b int, same boolean")
    assert [r.verdict for r in sinks.smaller_of(s, "a", "b", "same").collect()] == ["shrunk", "kept", "differs"]


def test_stream_in_two_batches(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = tmp_path / "e"
    e.where("event_id % 2 = 0").coalesce(1).write.parquet(str(src))
    e.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(str(src))
    stream = events.latest_status(events.read_events(spark, str(src), files_per_trigger=1, schema=e.schema))
    out = events._drained(spark, stream, "update", "test")
    got = {r.user_id: r.s.event_id for r in out.groupBy("user_id").agg(F.max_by(F.struct("status", "event_id"), "batch").alias("s")).collect()}
    want = {r.user_id: r.event_id for r in e.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id")).collect()}
    assert got == want
