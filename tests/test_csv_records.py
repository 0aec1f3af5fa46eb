"""CSV files with line breaks in quoted cells: many small splits against the multi-line reader."""

import csv
import io
import random
import re

import pytest

from qalam.sources import readers as R
from qalam.sources.csv_records import csv_records, split_lines


def cells(rng):
    pool = ["a", "é", ",", '"', "\n", "\r\n", "\r", " ", "مر", "x" * 30, "'", "\\"]
    return "".join(rng.choices(pool, k=rng.randrange(12)))


def written(rows, end, quoting):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    return out.getvalue().encode()


def multi_line(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, str(v)) for k, v in zip(old, (size, 1), strict=True)]
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("size", "end"), [(64, "\n"), (300, "\n"), (150, "\r\n"), (1 << 20, "\n")])
def test_splits_against_the_multi_line_reader(spark, tmp_path, small_splits, size, end):
    rng = random.Random(size)
    rows = [("row_id", "en", "ar")] + [(i, cells(rng), cells(rng)) for i in range(250)] + [(900, "one\n" * 400, "x"), (901, "a", "b")]
    for k in range(3):
        (tmp_path / f"part-{k}.csv").write_bytes(written(rows[:1] + rows[1 + k :: 3], end, csv.QUOTE_ALL if k else csv.QUOTE_MINIMAL))
    want = sorted(map(tuple, multi_line(spark, str(tmp_path)).collect()))
    small_splits(size)
    assert split_lines(spark, str(tmp_path)).select("file", "block").distinct().count() > (3 if size < 1000 else 2)
    got = R.read_pairs_csv(spark, str(tmp_path), na_values=[])
    assert got.columns == ["row_id", "en", "ar"]
    rows_read = [tuple(r) for r in got.collect()]
    if end == "\r\n":  # where lines end so, the multi-line reader changes it inside cells too
        assert any("\r\n" in c for r in rows_read for c in r if c)
        rows_read, want = ([tuple(c and re.sub("\r+\n", "\n", c) for c in r) for r in x] for x in (rows_read, want))
    assert sorted(rows_read, key=repr) == sorted(want, key=repr)
    assert len(want) == len(rows) - 1


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    rows = [("en", "ar")] + [(f"line {i}\nand more", f"cell {i}") for i in range(4000)]
    (tmp_path / "one.csv").write_bytes(written(rows, "\n", csv.QUOTE_ALL))
    small_splits(8192)
    got = R.read_pairs_csv(spark, str(tmp_path / "one.csv"))
    assert split_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    assert sorted(map(tuple, got.collect())) == sorted(rows[1:])


def test_edges(spark, tmp_path, small_splits):
    small_splits(40)
    cases = {
        "empty.csv": b"",
        "header.csv": b"en,ar\n",
        "no_end.csv": b'en,ar\n1,"two\nthree"',
        "blank.csv": b'en,ar\n\n1,2\n\n\n"3\n\n4",5\n',
        "quotes.csv": b'en,ar\n"a ""quoted"" word, and ""another""\n""third""","b"\n""""\n',
        "long_header.csv": b'"en\nen en en en en en en en en en en en en en","ar"\n1,2\n',
    }
    for name, data in cases.items():
        path = tmp_path / name
        path.write_bytes(data)
        want = multi_line(spark, str(path))
        if not want.columns:
            assert csv_records(spark, str(path)).collect() == []
            continue
        got = R.read_pairs_csv(spark, str(path), na_values=[])
        assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), name
