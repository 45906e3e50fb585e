"""Sinks: exact shards with a manifest, task tables, rollout dumps, result upserts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import first_keys, shard_of
from .files import _fs, find_parquet_files


RENAMES = 32  # file moves asked for at a time


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_shards(df: DataFrame, out: str, max_rows: int, order: list[Column], prefix: str = "part") -> list[str]:
    """Write contiguous shards of exactly max_rows rows (the last one may be shorter) as
    `prefix-iiiii-of-nnnnn.parquet`, one file each, in a folder of this run under `out`; returns their
    paths in order. Files of an earlier run stay in that run's folder and are in no later list; a
    manifest written from the returned paths makes a finished run visible. Empty input writes nothing.

    `order` is a unique key without NULL. Shards are cut by the keys of their first rows, so whole rows move and are written once;
    the writer's files are then given their names. `df` is read twice and must give the same rows again.
    """
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    spark = df.sparkSession
    bounds = first_keys(df, max_rows, order)
    if not bounds:
        return []
    total = len(bounds)
    run = f"{out}/run-{uuid.uuid4().hex}"
    staged = f"{run}/_staged"
    rows = df.withColumn("_shard", shard_of(bounds, spark, order))
    rows.repartition(total, "_shard").sortWithinPartitions("_shard", *order).write.option("compression", "snappy").partitionBy("_shard").parquet(staged)
    fs, _ = _fs(spark, out)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def place(path: str) -> str:
        number = int(path.split("_shard=")[1].split("/")[0])
        target = f"{run}/{prefix}-{number:05d}-of-{total:05d}.parquet"
        if not fs.rename(path_of(path), path_of(target)):
            raise OSError(f"could not place {target}")
        return target

    with ThreadPoolExecutor(RENAMES) as pool:
        final = sorted(pool.map(place, spark.read.parquet(staged).inputFiles()))
    fs.delete(path_of(staged), True)
    return final


def write_manifest(spark: SparkSession, out: str, paths: list[str] | None = None, name: str = "file_list.json") -> str:
    """The given Parquet paths, or all under a folder, as one JSON array."""
    path = f"{out}/{name}"
    write_text(spark, path, json.dumps(find_parquet_files(spark, out) if paths is None else paths, indent=2))
    return path


def merge_and_shard(general: DataFrame | None, recommendation: DataFrame | None, out: str, max_rows: int,
                    order: list[Column]) -> str:
    """General corpus plus recommendation corpus, exact shards and a manifest."""
    parts = [p for p in (general, recommendation) if p is not None]
    if not parts:
        raise ValueError("at least one corpus is needed")
    merged = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return write_manifest(merged.sparkSession, out, write_shards(merged, out, max_rows, order))


def run_tasks(jobs: dict[str, Callable[[], DataFrame]], switches: dict[str, bool], kind: str, out: str) -> list[str]:
    """Write `{kind}_{task}.parquet` for every switched-on task."""
    written = []
    for task, build in jobs.items():
        if switches.get(task, False):
            path = f"{out}/{kind}_{task}.parquet"
            build().write.mode("overwrite").parquet(path)
            written.append(path)
    return written


def dump_rollouts(rollouts: DataFrame, out: str) -> None:
    """JSON lines per step."""
    rollouts.write.mode("overwrite").partitionBy("step").json(out)


def write_generations(samples: DataFrame, out: str, chunk: int = 200) -> None:
    """Generation results as JSON documents of a bounded number of samples each.

    `samples`: model, task, split, sample_id, payload (struct). Chunks are hash buckets of the
    sample id, sized from the row count, so no document holds a whole split.
    """
    keys = ["model", "task", "split"]
    sizes = samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # One row for each split goes to the samples: dealt out by these few keys, a whole split would meet in one task.
    spread = samples.join(F.broadcast(sizes), keys).withColumn(
        "_chunk", F.pmod(F.xxhash64("sample_id"), F.ceil(F.col("_n") / chunk).cast("bigint")))
    docs = spread.groupBy(*keys, "_chunk").agg(
        F.map_from_entries(F.collect_list(F.struct("sample_id", "payload"))).alias("samples"))
    docs.select(F.col("model").alias("model_name"), F.col("task").alias("task_name"), "split", "samples",
                F.col("model").alias("m"), F.col("task").alias("t"), F.col("split").alias("s")).write.mode(
        "overwrite").partitionBy("m", "t", "s").json(out)


def write_pid_mapping(long_rows: DataFrame, out: str, chunk: int = 1000) -> None:
    """Ordered id lists as JSON lines; a long list continues on further lines (`code@first`)."""
    part = F.floor(F.col("ord") / chunk) * chunk
    entry = F.struct("ord", F.struct("pid", "count", F.col("count_ds").alias("count_after_downsample")).alias("v"))
    lists = long_rows.groupBy("code", part.alias("first")).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["v"]).alias("items"))
    key = F.concat_ws("@", F.col("code").cast("string"), F.col("first").cast("string"))
    lists.select(F.to_json(F.create_map(key, F.col("items"))).alias("value")).write.mode("overwrite").text(out)


def debug_sample(samples: DataFrame, n: int = 100) -> DataFrame:
    """First samples by id in string order."""
    return samples.orderBy("sample_id").limit(n)


def bucket_counts(rows: DataFrame, bucket: Column) -> DataFrame:
    return rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def upsert_results(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keep old (model, task, split) entries except those evaluated again."""
    keys = ["model", "task", "split"]
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
