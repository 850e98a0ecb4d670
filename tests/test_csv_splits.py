import csv
import random

import pytest

from tidemark.sources import readers as rd
from tidemark.sources.csv_splits import records

SCHEMA = "a string, b string, c string"


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "64")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(path, rows, end="\n", columns="abc"):
    with open(path, "w", newline="") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(columns)
        out.writerows(rows)


def rows_of(draw, n):
    def field():
        return "".join(draw.choices(["x", "yé", ",", '"', '""', "\n", "\n\n", "\r\n", " ", "1"], k=draw.choice([0, 1, 3, 40])))

    return [(f"{i}", field(), field()) for i in range(n)]


def split_rows(spark, path):
    return sorted(map(tuple, rd.csv_text(spark, str(path), SCHEMA).collect()), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(2))
def test_splits_read_what_one_task_reads(spark, tmp_path, end, seed, request):
    rows = rows_of(random.Random(seed), 120)
    written(tmp_path / "t.csv", rows, end)
    whole = split_rows(spark, tmp_path / "t.csv")
    assert whole == sorted([tuple(x.replace(end, "\n") or None for x in r) for r in rows], key=repr)
    request.getfixturevalue("small_splits")
    parts = spark.read.option("lineSep", "\n").text(str(tmp_path / "t.csv")).rdd.getNumPartitions()
    assert parts > 20 and split_rows(spark, tmp_path / "t.csv") == whole


def test_a_field_longer_than_many_splits_and_several_files(spark, tmp_path, small_splits):
    long = "line, of \"text\"\n" * 100
    folder = tmp_path / "t"
    folder.mkdir()
    made = []
    for name in "pqr":
        rows = [(name, "1", long), (name, "2", ""), (name, "3", "\n" * 300), (name, "4", "end")]
        written(folder / f"{name}.csv", rows)
        made += rows
    assert split_rows(spark, folder) == sorted([tuple(x or None for x in r) for r in made], key=repr)


def test_no_line_is_read_by_one_task_alone(spark, tmp_path, small_splits):
    written(tmp_path / "t.csv", [(str(i), "x", "y\nz") for i in range(400)])
    found = records(spark, str(tmp_path / "t.csv"))
    assert found.count() == 401 and found.where("header").collect()[0].record == "a,b,c"
    assert found.where("record = '7,x,\"y\nz\"'").count() == 1


def test_headers_and_order_of_columns(spark, tmp_path, small_splits):
    folder = tmp_path / "t"
    folder.mkdir()
    with open(folder / "1.csv", "w", newline="") as file:
        file.write("﻿c,\"a\",extra,b\n" + "3,1,0,\"2\n2\"\n" * 50 + "\n\n3,1,0,2")
    assert split_rows(spark, folder) == sorted([("1", "2\n2", "3")] * 50 + [("1", "2", "3")], key=repr)
    with pytest.raises(ValueError, match="no column d"):
        rd.csv_text(spark, str(folder), "d string")
    written(folder / "2.csv", [("1", "2", "3")] * 50)
    with pytest.raises(ValueError, match="different headers"):
        rd.csv_text(spark, str(folder), SCHEMA)


def test_a_record_of_another_width_is_an_error(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_text("a,b,c\n" + "1,2,3\n" * 50 + "1,2\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        rd.csv_text(spark, str(tmp_path / "t.csv"), SCHEMA).collect()
