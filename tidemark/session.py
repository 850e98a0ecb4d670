"""Session settings, the shared scratch folder, and checks on the size of a table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# A join side of at most this many bytes is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 16 << 20
_FILES_A_CORE = 4
_FILE_BYTES = 64 << 20


def build_session(
    app: str = "tidemark", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Set the run-time settings results depend on, on a session built elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, SETTINGS[key])
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; without one, a folder in the warehouse, if that is
    shared too: on a cluster, a folder of each machine's own is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the scratch folder, which goes when the application ends."""
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    files, at = _files(spark, path)
    files.deleteOnExit(at)
    return path


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def few_files(df: DataFrame) -> DataFrame:
    """`df` in no more partitions than a few for each core, or one for each 64 MB that it reads:
    small files cost a write and a read each, and more so the larger the cluster."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(min(max(_FILES_A_CORE * cores, -(-read // _FILE_BYTES)), 1 << 30))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table once and read it back, so that it has no lineage."""
    path = scratch_path(df.sparkSession, label)
    few_files(df).write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def stage_evenly(df: DataFrame, label: str) -> DataFrame:
    """`stage`, with the rows dealt out evenly to a file for each core: for tables that are small in
    bytes but dear to work on, which would else be read by a task or two."""
    return stage(df.repartition(df.sparkSession.sparkContext.defaultParallelism), label)


def release(*staged: DataFrame) -> None:
    """Drop staged tables that nothing will read again."""
    for df in staged:
        files, at = _files(df.sparkSession, df._staged_at)
        files.delete(at, True)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory: texts and nested values by their length, eight
    for any other value."""
    width = F.lit(8)
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            width = width + 8 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            width = width + 8 + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            width = width + 8
    return width.cast("long")


def shuffled(side: DataFrame) -> DataFrame:
    """A join side that is never broadcast. Spark's guess of a table's size can be far too low: it
    counts no rows that an explode or a Python step adds, no long arrays, and files as compressed.
    By such a guess it would collect a table of any size to the driver."""
    return side.hint("merge")


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A join side, computed once and measured on the way: broadcast if its rows take at most
    `most` bytes, else left to the shuffle join, whatever Spark guesses of its size."""
    seen = Observation()
    side = stage(df.observe(seen, F.sum(row_bytes(df)).alias("bytes")), "side")
    return F.broadcast(side) if (seen.get["bytes"] or 0) <= most else shuffled(side)
