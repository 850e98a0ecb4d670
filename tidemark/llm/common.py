"""What the operators share: the columns they read, and batches of rows on their way to Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_ROWS = 512


def small_batches(df: DataFrame) -> DataFrame:
    """Have the session send at most 512 rows to Python at a time, as a row may be a long text."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= _BATCH_ROWS:
        conf.set(_BATCH, _BATCH_ROWS)
    return df


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text), whatever else the table has; other columns cannot clash with ours."""
    return small_batches(docs).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def told_apart(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, row): `row` tells rows apart, equal ones too, and is the same each time the
    table is read; a null text is empty.

    It is a hash of the row's place in a parquet file. A table that does not come straight from
    such files is written to the scratch folder first.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row")
    texts = texts_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    try:
        if "_metadata" in docs.columns:
            raise AnalysisException("hidden by a column of that name")
        return texts.select("doc_id", "text", place)
    except AnalysisException:
        return stage(texts, "texts").select("doc_id", "text", place)


def as_bytes(texts: DataFrame) -> DataFrame:
    """The text as its UTF-8 bytes; a null one is empty."""
    return texts.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def map_batches(
    df: DataFrame, work: Callable[[dict[str, list]], dict[str, list] | None], schema: str
) -> DataFrame:
    """`work` turns the columns of a batch, as lists, into those of its result."""
    names = df.columns
    # an empty frame tells the result's Arrow types
    arrow = _arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work({n: batch.column(i).to_pylist() for i, n in enumerate(names)})
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))
