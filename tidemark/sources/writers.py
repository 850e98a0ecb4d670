"""Writers for tables, lists, logs and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Replace a table; CSV carries a header and doubles inner quotes."""
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        )
    writer.format(form).save(path)


def exists(df_or_spark, path: str) -> bool:
    """Whether a whole table is there: a write that failed leaves no mark of success."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    files = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(mark)


def table_if_absent(df: DataFrame, path: str) -> None:
    """Build a table only where there is no whole one; that is kept as it is."""
    if not exists(df, path):
        df.write.mode("overwrite").parquet(path)


def config(df: DataFrame, path: str) -> None:
    """One JSON object per entry."""
    df.write.mode("overwrite").json(path)


def tuning_log(trials: DataFrame, path: str) -> None:
    """Append trials (target, params) to a JSON-lines log."""
    trials.select("target", "params").write.mode("append").json(path)


def predictions(df: DataFrame, path: str) -> None:
    picked = df.select("installation_id", F.col("accuracy_group").cast("int"))
    table(picked, path, "csv")
