"""CSV files with line breaks inside fields, read in splits, against the one-task reader."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from hostlens.sources import csv_split, io

SCHEMA = "id STRING, n INT, note STRING, day DATE"


def drawn(rng, rows):
    pieces = ["a", "word", '"', '""', "\n", "\n\n", ",", ",,", "é", " ", "x" * 40, '",', ',"', "'", "\\", ""]
    return [[f"r{i}", rng.choice(["1", "2", "", "bad", "99999999999"]), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))).rstrip("\\"),
             rng.choice(["2024-02-29", "", "2023-02-30", "no"])] for i in range(rows)]


def both(spark, path, split_bytes, **options):
    one = io.read_csv_table(spark, str(path), SCHEMA, **options)
    many = csv_split.read_csv_split(spark, str(path), SCHEMA, split_bytes=split_bytes, **options)
    assert [(f.name, f.dataType) for f in one.schema] == [(f.name, f.dataType) for f in many.schema]
    key = lambda r: tuple(str(x) for x in r)
    return sorted(one.collect(), key=key), sorted(many.collect(), key=key)


@pytest.mark.parametrize("split_bytes,end", [(13, "\n"), (64, "\n"), (997, "\r\n"), (1 << 20, "\n")])
def test_equals_the_one_task_reader(spark, tmp_path, split_bytes, end):
    rng = random.Random(split_bytes)
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator=end)
            w.writerow(["id", "n", "note", "day"])
            w.writerows(drawn(rng, 40))
    one, many = both(spark, tmp_path, split_bytes)
    assert len(one) == 80 and one == many


@pytest.mark.parametrize("split_bytes", [11, 50, 4000])
def test_stray_quotes_blank_lines_short_and_long_rows(spark, tmp_path, split_bytes):
    text = ('id,n,note,day\n1,2,5" tall,2024-01-01\n\n2,3,"two\nlines",2024-01-02\n3,4,say ""hi"",\n"4",5,"a ""b"" c"\n'
            '5,6,"q",2024-01-03,extra,more\n6,7,"' + "long, line\n" * 30 + 'end",2024-01-04\n7,8, "spaced",2024-01-05\n\n8,9,"",\n9,1,last,2024-01-06')
    (tmp_path / "x.csv").write_text(text)
    one, many = both(spark, tmp_path, split_bytes)
    assert one == many and len(one) == 9
    one, many = both(spark, tmp_path, split_bytes, corrupt_column="_bad")
    assert one == many


@pytest.mark.parametrize("text", ["", "id,n,note,day\n", 'id,n,note,day\n1,2,"never closed\n2,3,x,\n3,4', '"id","n\nn","note","day"\n1,2,x,2024-01-01\n'])
def test_empty_header_only_and_open_end(spark, tmp_path, text):
    (tmp_path / "x.csv").write_text(text)
    for split_bytes in (5, 1000):
        one, many = both(spark, tmp_path, split_bytes)
        assert one == many


def test_backslash_escapes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,n,note,day\n1,2,"he said \\"no,\nnever\\" twice",2024-01-01\n2,3,"ends in \\\\",2024-01-02\n3,4,plain,\n' * 1)
    for split_bytes in (9, 30, 1000):
        one, many = both(spark, tmp_path, split_bytes, escape=None)
        assert one == many and len(one) == 3


def test_one_file_in_many_tasks_without_empty_ones(spark, tmp_path):
    rng = random.Random(5)
    with open(tmp_path / "x.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(["id", "n", "note", "day"])
        w.writerows(drawn(rng, 3000))
    size = (tmp_path / "x.csv").stat().st_size
    own = csv_split._own_session(spark, size // 12, None)
    lines = own.read.option("lineSep", "\n").text(str(tmp_path / "x.csv"))
    parts = lines.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 8 and min(r["count"] for r in parts) > 0
    one, many = both(spark, tmp_path / "x.csv", size // 12)
    assert one == many and len(one) == 3000
    assert io.read_csv_table(spark, str(tmp_path / "x.csv"), SCHEMA).rdd.getNumPartitions() == 1


def test_states_of_splits(spark):
    """Keep, flip and set in any order against plain composition."""
    rng = random.Random(2)
    rows = [(f, b * 10, *rng.choice([(False, True), (True, False), (True, True), (False, False)]), rng.random() < 0.5) for f in range(4) for b in range(30)]
    got = {(r["file"], r["block"]): (r["inside"], r["owner"]) for r in csv_split.split_states(spark.createDataFrame(rows, csv_split.SPLITS)).collect()}
    for f in range(4):
        inside, owner = False, 0
        for _, b, if_out, if_in, starts in sorted(r for r in rows if r[0] == f):
            assert got[(f, b)] == (inside, owner)
            if not inside or starts:
                owner = b
            inside = if_in if inside else if_out
