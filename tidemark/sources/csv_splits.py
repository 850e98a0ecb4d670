"""Records of CSV files whose quoted fields may hold line breaks, read in many splits a file.

A split cannot tell whether its first line starts inside a quoted field. It counts: a line with an
odd number of quotes opens or closes a field, so each line knows whether it starts inside one if
the split starts outside. The quotes of the splits before say whether that is so. A line that
starts outside and has an even number of quotes is a record; only the lines of other records are
brought together, over the border between splits too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import small_side, stage

_LINES = "file string, block long, nth long, inside boolean, odd boolean, opened long, opened_turned long, line string"


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a split come in their order; a task may read several splits, one after another.

    opened: the last line of the split, up to this one, that opens a field if the split starts outside
    of one; opened_turned: the same if it starts inside; -1 for none.
    """
    at, nth, inside, opened = None, 0, False, [-1, -1]
    for batch in batches:
        file, block, line = batch.columns
        if not len(line):
            continue
        odd = pc.count_substring(line, '"').to_numpy(zero_copy_only=False) % 2 == 1
        names, starts = file.dictionary_encode(), block.to_numpy()
        ids = names.indices.to_numpy()
        first = np.flatnonzero(np.concatenate(([True], (starts[1:] != starts[:-1]) | (ids[1:] != ids[:-1]))))
        number, before = np.zeros(len(odd), np.int64), np.zeros(len(odd), bool)
        last = [np.zeros(len(odd), np.int64) for _ in range(2)]
        for low, high in zip(first, [*first[1:], len(odd)], strict=True):
            here = (names.dictionary[int(ids[low])].as_py(), int(starts[low]))
            if here != at:
                at, nth, inside, opened = here, 0, False, [-1, -1]
            turned = np.cumsum(odd[low:high]) % 2 == 1
            number[low:high] = np.arange(nth, nth + high - low)
            before[low:high] = np.concatenate(([False], turned[:-1])) ^ inside
            for turned_in in (0, 1):
                opens = odd[low:high] & (before[low:high] == bool(turned_in))
                seen = np.maximum.accumulate(np.where(opens, number[low:high], opened[turned_in]))
                last[turned_in][low:high], opened[turned_in] = seen, int(seen[-1])
            nth, inside = nth + int(high - low), bool(turned[-1]) ^ inside
        yield pa.RecordBatch.from_arrays(
            [file, block, pa.array(number), pa.array(before), pa.array(odd), *map(pa.array, last), line],
            names=["file", "block", "nth", "inside", "odd", "opened", "opened_turned", "line"],
        )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, record): the records of CSV files, the first one of each marked as `header`.

    Lines end with a line feed, before which a carriage return is dropped where a record ends; a
    field that holds a quote is quoted, with the quote doubled. Empty lines between records are
    left out. The text is written once, with what each line knows, as splits may change from one
    look at a file to the next. A record whose last quote is missing ends with its file.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")
    )
    lines = stage(lines.mapInArrow(_parities, _LINES), "lines")

    # one row for each split: whether it starts inside a field, and where the one before that has
    # the start of a record of several lines
    key = ["file", "block"]
    blocks = lines.groupBy(*key).agg(F.sum(F.col("odd").cast("int")).alias("odd"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    turned = small_side(blocks.select(*key, turned.alias("turned")))
    opened = F.when(F.col("turned"), F.col("opened_turned")).otherwise(F.col("opened"))
    told = lines.join(turned, key).withColumn("inside", F.col("inside") != F.col("turned"))
    told = told.withColumn("opened", F.when(opened >= 0, opened)).drop("turned", "opened_turned")
    alone = told.where("NOT inside AND NOT odd").select(
        "file", (F.expr("block = 0 AND nth = 0")).alias("header"), F.col("line").alias("record")
    )
    pieces = told.where("inside OR odd")
    starts = pieces.groupBy(*key).agg(F.max("opened").alias("last_start"))
    # a split without a start in it hands on the record it is inside of
    carried = F.last(F.when(F.col("last_start").isNotNull(), F.struct(F.col("block").alias("home"), F.col("last_start").alias("home_nth"))), True)
    carried = small_side(starts.select(*key, carried.over(before).alias("carried")))
    own = F.when(F.col("opened").isNotNull(), F.struct(F.col("block").alias("home"), F.col("opened").alias("home_nth")))
    placed = (
        pieces.withColumn("own", own)
        .join(carried, key)
        .select("file", "block", "nth", "line", F.coalesce("own", "carried").alias("of"))
    )
    # whole-file readers make one of both characters in the fields of a file whose lines end so
    ends = lines.where("block = 0 AND nth = 0").select("file", F.col("line").endswith("\r").alias("both"))
    text = F.array_join("parts.line", "\n")
    joined = (
        placed.groupBy("file", "of")
        .agg(F.array_sort(F.collect_list(F.struct("block", "nth", "line"))).alias("parts"))
        .join(small_side(ends), "file")
        .select(
            "file",
            (F.expr("of.home = 0 AND of.home_nth = 0")).alias("header"),
            F.when(F.col("both"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text).alias("record"),
        )
    )
    whole = alone.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return whole.where("record <> ''")
