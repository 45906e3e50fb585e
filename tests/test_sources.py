"""File sources and sinks on scratch folders."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sidweave.operators import batches as BT
from sidweave.operators import quality
from sidweave.sources import files, sinks
from sidweave.streaming import period_counters as SC


def test_missing_and_plain_paths(spark, tmp_path, sf):
    with pytest.raises(FileNotFoundError):
        files.find_parquet_files(spark, str(tmp_path / "none"))
    with pytest.raises(NotADirectoryError):
        files.find_parquet_files(spark, f"{sf}/orders.parquet")
    (tmp_path / "a.txt").write_text("x")
    assert files.collect_parquet_files(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b"), f"{sf}/part.parquet"])[0].endswith("part.parquet")


def test_corrupt_files_are_skipped(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "good.parquet"))
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 not really PAR1")
    good = [p for p in files.find_parquet_files(spark, str(tmp_path)) if "good" in p]
    assert files.load_parquet_files(spark, good).count() == 5
    spark.read.schema("id bigint").option("ignoreCorruptFiles", True).parquet(*good, str(tmp_path / "bad.parquet")).count()


def test_exact_shards(spark, tmp_path):
    out = str(tmp_path / "shards")
    names = sinks.write_shards(spark.range(1050).withColumnRenamed("id", "k"), out, 500, [F.col("k")])
    assert [os.path.basename(n) for n in names] == [f"part-0000{i}-of-00003.parquet" for i in range(3)]
    sizes = [spark.read.parquet(n).count() for n in names]
    assert sizes == [500, 500, 50]
    manifest = sinks.write_manifest(spark, out)
    assert files.load_manifest(spark, manifest).agg(F.sum("k")).first()[0] == sum(range(1050))
    with pytest.raises(ValueError):
        sinks.write_shards(spark.range(3), out, 0, [F.col("id")])
    assert sinks.write_shards(spark.range(0), str(tmp_path / "empty"), 5, [F.col("id")]) == []
    with pytest.raises(ValueError):
        sinks.merge_and_shard(None, None, out, 5, [])


def test_shards_by_two_keys(spark, tmp_path):
    """Text keys beyond ASCII, ties in the first key, rows that come in any order; every row is in its shard, in order."""
    rows = [(t, n) for t in ("b", "é", "a", "日本", "", "Z") for n in range(-20, 17)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "t string, n bigint").repartition(5)
    names = sinks.write_shards(df, str(tmp_path / "two"), 50, [F.col("t"), F.col("n")])
    want = sorted(rows, key=lambda r: (r[0].encode(), r[1]))
    assert [[tuple(r) for r in spark.read.parquet(n).collect()] for n in names] == [want[k:k + 50] for k in range(0, len(want), 50)]


def test_single_document_results(spark, tmp_path):
    doc = {"model_name": "m", "task_name": "t", "split": "s", "samples": {"1": {"generations": ["a"], "ground_truth": "b"},
                                                                         "2": {"generations": []}}}
    (tmp_path / "ok.json").write_text(json.dumps(doc, indent=1))
    assert {r.sample_id for r in files.load_generations(spark, str(tmp_path / "ok.json")).collect()} == {"1", "2"}
    (tmp_path / "bad.json").write_text(json.dumps({"model_name": "m"}))
    with pytest.raises(Exception, match="without samples"):
        files.load_generations(spark, str(tmp_path / "bad.json")).collect()


def test_whole_mapping_document(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"7": [{"pid": 3, "count": 2, "count_after_downsample": 1}, {"iid": 4, "count": 1}]}))
    got = files.load_pid_mapping(spark, str(tmp_path / "m.json")).orderBy("ord").collect()
    assert [(r.code, r.ord, r.pid) for r in got] == [(7, 0, 3), (7, 1, 4)]


def test_escape_repair(spark):
    df = spark.createDataFrame([('{"a": "\\u00e9", "n": null}', "\\u00e9"), ('{"a": 1}', None)], "messages string, other string")
    got = [r.messages for r in quality.repair_escapes(df).collect()]
    assert got == ['{"a":"é","n":null}', '{"a": 1}']
    bad = spark.createDataFrame([("{\\u00e9",)], "segments string")
    assert quality.repair_escapes(bad).first().segments == "{\\u00e9"
    assert quality.repair_escapes(df, ["nothing"]).collect() == df.collect()


def test_union_conflict(spark):
    a = spark.createDataFrame([(0, 1), (1, 2)], "row_id bigint, x int")
    assert BT.union_columns(a, a.withColumn("y", F.lit(3))).count() == 2
    with pytest.raises(Exception, match="batches differ"):
        BT.union_columns(a, a.withColumn("x", F.lit(9))).collect()
    with pytest.raises(Exception, match="batches differ"):
        BT.union_columns(a, a.where("row_id = 0")).collect()
    with pytest.raises(Exception, match="equal chunks"):
        BT.chunk(spark.range(5).withColumnRenamed("id", "row_id"), 2).collect()
    padded = BT.pad_to_multiple(a, 4)
    assert padded.count() == 4 and BT.unpad(padded).count() == 2


def test_stream_keeps_every_window(spark, tmp_path):
    """Two runs over a growing log give the rows of one batch, open windows included."""
    src, out = str(tmp_path / "log"), str(tmp_path / "out")
    rows = spark.sql("SELECT id AS step, timestamp_seconds(id * 600) AS ts, 1.0D AS loss, 10L AS tokens, 1 AS samples, 5L AS valid_tokens, "
                     "0.5D AS seconds FROM range(60)")
    for part in (rows.where("step < 33"), rows.where("step >= 33")):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(rows.schema).parquet(src)
        SC.start(stream, 2, out, str(tmp_path / "ck")).awaitTermination()
    done = {r.period_start: r.steps for r in spark.read.parquet(out).collect()}
    assert done == {r.period_start: r.steps for r in SC.windowed(rows, 2).collect()} and len(done) == 10


def test_a_second_run_lists_its_own_shards(spark, tmp_path):
    out = str(tmp_path / "twice")
    for n in (100, 50):
        manifest = sinks.merge_and_shard(spark.range(n).withColumnRenamed("id", "k"), None, out, 20, [F.col("k")])
        assert files.load_manifest(spark, manifest).count() == n


def test_broken_bytes_are_dropped(spark):
    df = spark.createDataFrame([(1, bytearray(b"a\xff\xc3b\xef\xbf\xbd")), (2, bytearray("é".encode())), (3, None)], "id int, segments binary")
    assert [r.segments for r in quality.repair_escapes(df).orderBy("id").collect()] == ["ab\ufffd", "é", None]
