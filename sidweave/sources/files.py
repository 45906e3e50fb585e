"""File sources: directory scans, manifests, JSON corpora, generation results, id mappings."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

SAMPLE_SCHEMA = (
    "struct<prompt:string,generations:array<string>,ground_truth:string,logprobs:array<double>,"
    "input_tokens:array<bigint>,output_tokens:array<bigint>,times:array<double>,user_id:string,"
    "metadata:string>"
)
RESULT_SCHEMA = (
    "model_name string, task_name string, split string, total_time double, avg_time_per_sample double,"
    f"hardware_info string, num_params double, samples map<string,{SAMPLE_SCHEMA}>"
)
PID_LIST = "map<string,array<struct<pid:bigint,iid:bigint,count:bigint,count_after_downsample:bigint>>>"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def find_parquet_files(spark: SparkSession, directory: str, recursive: bool = True) -> list[str]:
    """Sorted Parquet paths below a directory; a missing path or a plain file is an error."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        raise FileNotFoundError(directory)
    if not fs.getFileStatus(p).isDirectory():
        raise NotADirectoryError(directory)
    it = fs.listFiles(p, recursive)
    found = []
    while it.hasNext():
        name = it.next().getPath().toString()
        if name.endswith(".parquet"):
            found.append(name)
    return sorted(found)


def collect_parquet_files(spark: SparkSession, paths: list[str], recursive: bool = True) -> list[str]:
    """Files and directories to one de-duplicated path list; what cannot be used is logged."""
    found: list[str] = []
    for path in paths:
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            log.warning("skipping missing path %s", path)
        elif fs.getFileStatus(p).isDirectory():
            found += find_parquet_files(spark, path, recursive)
        elif path.endswith(".parquet"):
            found.append(fs.getFileStatus(p).getPath().toString())
        else:
            log.warning("skipping %s: not a Parquet file", path)
    return list(dict.fromkeys(found))


def load_parquet_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One table over many files: column union, unreadable files are skipped."""
    if not paths:
        raise ValueError("no Parquet files to load")
    reader = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True)
    return reader.parquet(*paths)


def read_text(spark: SparkSession, path: str) -> str:
    """Contents of one small driver-side configuration file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifest_paths(spark: SparkSession, manifest: str) -> list[str]:
    """Parquet entries of a JSON path list."""
    return [p for p in json.loads(read_text(spark, manifest)) if p.endswith(".parquet")]


def load_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    return spark.read.parquet(*manifest_paths(spark, manifest))


def load_corpus(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON-lines passage corpus."""
    return spark.read.schema(schema).json(path)


def task_path(base: str, task: str, split: str, sample_size: int | None = None) -> str:
    suffix = "" if sample_size is None else f"_sample_{sample_size}"
    return f"{base}/{task}/{task}_{split}{suffix}.parquet"


def load_task(spark: SparkSession, base: str, task: str, split: str, row_id: str,
              sample_size: int | None = None) -> DataFrame:
    """Task table of a split; a sample is the first rows by id, kept as a cached table."""
    full = task_path(base, task, split)
    if sample_size is None:
        return spark.read.parquet(full)
    cached = task_path(base, task, split, sample_size)
    fs, p = _fs(spark, cached + "/_SUCCESS")
    if not fs.exists(p):
        spark.read.parquet(full).orderBy(row_id).limit(sample_size).write.mode("overwrite").parquet(cached)
    return spark.read.parquet(cached)


def load_generations(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Generation results, one row per sample; a document without `samples` is an error."""
    docs = spark.read.schema(RESULT_SCHEMA).option("multiLine", multiline).json(path)
    checked = F.when(F.col("samples").isNull(), F.raise_error(F.lit("results without samples"))).otherwise(
        F.col("samples"))
    return docs.select("model_name", "task_name", "split", F.explode(checked).alias("sample_id", "s")).select(
        "model_name", "task_name", "split", "sample_id", "s.*")


def load_pid_mapping(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Id collision lists in long form; `ord` keeps the list order.

    With whole_file=False every line is a JSON object of its own; `first` tells where a
    line's part of the list starts.
    """
    docs = spark.read.option("wholetext", whole_file).text(path)
    entries = docs.select(F.explode(F.from_json("value", PID_LIST)).alias("key", "items"))
    place = F.split("key", "@")
    return entries.select(
        place[0].cast("bigint").alias("code"),
        F.coalesce(F.get(place, 1).cast("int"), F.lit(0)).alias("first"),
        F.posexplode("items").alias("at", "x"),
    ).select(
        "code", (F.col("first") + F.col("at")).alias("ord"), F.coalesce("x.pid", "x.iid").alias("pid"),
        F.col("x.count").alias("count"), F.col("x.count_after_downsample").alias("count_ds"))


def source_totals(config: DataFrame) -> DataFrame:
    """Loader configuration (source, shardlist of path + nsamples) to per-source totals."""
    shards = config.select("source", F.explode("shardlist").alias("x")).select("source", "x.*")
    return shards.groupBy("source").agg(
        F.count(F.lit(1)).alias("shards"), F.sum("nsamples").alias("nsamples"))
