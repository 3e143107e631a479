"""Delimited files with line breaks, split among many tasks, against the reader that takes a file whole."""

import random

import pytest

from review_lens.schema import CSV_SCHEMA
from review_lens.sources.delimited import read_records, read_split_csv
from review_lens.sources.reviews import CSV_FORMAT, read_review_csv


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def write(path, rows, end):
    lines = ["comment,n_star,date_time,label"]
    for comment, star, label in rows:
        plain = comment if not set(comment) & set('",\r\n') and comment.strip() == comment and comment else quoted(comment)
        lines.append(f"{plain},{star},2024-01-01 00:00:00,{label}")
    path.write_bytes((end.join(lines) + end).encode())


def comments(draw, end, count):
    pieces = ["word", ' say "this" ', ",", end, f"{end}{end}", "é漢", '""', "a,b", "end. "]
    return [("c" + "".join(draw.choices(pieces, k=draw.randint(0, 12))), k % 5, "{OTHERS};") for k in range(count)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_equal_the_whole_file_reader(spark, tmp_path, end):
    draw = random.Random(len(end))
    for name in ("one.csv", "two.csv"):
        write(tmp_path / name, comments(draw, end, 400), end)
    expected = sorted(map(tuple, read_review_csv(spark, str(tmp_path)).collect()))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = read_split_csv(spark, str(tmp_path), CSV_SCHEMA, CSV_FORMAT)
        found = rows.collect()
        one = spark.read.option("lineSep", "\n").text(str(tmp_path / "one.csv")).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert one >= 8
    assert sorted(tuple(r)[:4] for r in found) == expected and len(expected) == 800
    for file in {r.file for r in found}:
        assert sorted(r.place for r in found if r.file == file) == list(range(2, 402))


def test_one_record_over_many_splits(spark, tmp_path):
    long = "\n".join(f"line {k} with some words" for k in range(500))
    write(tmp_path / "f.csv", [("first", 1, "x"), (long, 2, "y"), ("last", 3, "z")], "\n")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = read_split_csv(spark, str(tmp_path), CSV_SCHEMA, CSV_FORMAT).orderBy("place").collect()
        empty = tmp_path / "empty"
        empty.mkdir()
        (empty / "e.csv").write_text("")
        assert read_records(spark, str(empty)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert [(r.comment, r.n_star, r.place) for r in rows] == [("first", 1, 2), (long, 2, 3), ("last", 3, 4)]
