"""CSV with quoted line breaks cut by many tasks, against Spark's own reader of whole files."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tillwise.sources import files, records

SCHEMA = "a STRING, b STRING, c STRING"
CHARS = ["x", "y", '"', ",", "\n", "\r\n", " ", "ä", "漢", "'", ";"]


@pytest.fixture
def splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def text(rng):
    return "".join(rng.choice(CHARS) for _ in range(rng.randrange(9)))


def written(rows, **options):
    out = io.StringIO()
    csv.writer(out, **options).writerows(rows)
    return out.getvalue()


def both(spark, path, schema=SCHEMA, **options):
    """Rows cut by many tasks, and rows of files that are read whole."""
    got, want = (files.read_csv(spark, path, schema, multi_line=True, split=split, **options) for split in (True, False))
    assert got.schema == want.schema
    return [sorted(map(repr, df.collect())) for df in (got, want)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_reader_of_whole_files(spark, tmp_path, splits, seed):
    rng = random.Random(seed)
    header = seed % 2 == 0
    for name in "ab":
        rows = [[text(rng) for _ in range(3)] for _ in range(60)]
        if header:
            rows.insert(0, ["first", "the\nsecond, long" * 40 if name == "a" else "s", "third"])
        end = rng.choice(["\n", "\r\n"])
        (tmp_path / f"{name}.csv").write_text(written(rows, lineterminator=end), newline="")
    got, want = both(spark, str(tmp_path), header=header)
    assert got == want and len(got) == 120


@pytest.mark.parametrize(
    "line", ['a,b"c,d', 'a "b" c,d,e', '"a"b,c,d', '"a" ,"b\nc"x,d', ',,', '"","",""', "", '"only', 'x,"y""\nz",w']
)
def test_stray_quotes(spark, tmp_path, splits, line):
    plain = [["1", "two\nlines", "3"]] * 20
    (tmp_path / "a.csv").write_text(written(plain, lineterminator="\n") + line + "\n" + written(plain, lineterminator="\n"), newline="")
    got, want = both(spark, str(tmp_path), header=False, mode="PERMISSIVE")
    if line == '"only':
        # the rest of the file alternates between fields and text between them, for both readers
        assert len(got) > 20
    else:
        assert got == want


def test_a_field_longer_than_many_splits(spark, tmp_path, splits):
    rows = [["a", "b", "c"], ["1", 'line "quoted",\n' * 200, "2"], ["3", "4", "5"], ["6", "\n" * 900, "7"]]
    (tmp_path / "a.csv").write_text(written(rows, lineterminator="\n"), newline="")
    got, want = both(spark, str(tmp_path))
    assert got == want and len(got) == 3


def test_inferred_types_and_names(spark, tmp_path, splits):
    rows = [["id", "odd name, `x`", "pay", "day"]] + [[i, f"n\n{i}", i / 2 if i % 3 else "", "2024-01-02"] for i in range(60)]
    (tmp_path / "a.csv").write_text(written(rows, lineterminator="\n"), newline="")
    got, want = both(spark, str(tmp_path), schema=None)
    assert got == want and len(got) == 60


def test_typed_rows_fail_as_before(spark, tmp_path, splits):
    rows = [["1", "a\nb"]] * 60 + [["x", "c"]]
    (tmp_path / "a.csv").write_text(written(rows, lineterminator="\n"), newline="")
    df = files.read_csv(spark, str(tmp_path), "id INT, v STRING", header=False, multi_line=True, split=True)
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        df.collect()
    lenient = files.read_csv(spark, str(tmp_path), "id INT, v STRING", header=False, multi_line=True, mode="PERMISSIVE", split=True)
    assert lenient.filter("id is null").count() == 1 and lenient.count() == 61


def test_partition_columns_stay(spark, tmp_path, splits):
    for part in "12":
        (tmp_path / f"p={part}").mkdir()
        (tmp_path / f"p={part}" / "x.csv").write_text(written([["a", "b\nc", part]] * 40, lineterminator="\n"), newline="")
    got, want = both(spark, str(tmp_path), header=False)
    assert got == want and len(got) == 80


def test_only_large_files_are_cut(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text("x,y\n" * 100)
    assert not files._has_large_file(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("x,y\n" * 1000)
    assert files._has_large_file(spark, str(tmp_path))
    (tmp_path / "b.csv").unlink()
    for i in range(9):
        (tmp_path / f"c{i}.csv").write_text("x,y\n" * 100)
    assert not files._has_large_file(spark, str(tmp_path))


def test_one_large_file_uses_many_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        (tmp_path / "a.csv").write_text(written([[i, f"l\n{i}", ""] for i in range(20000)], lineterminator="\n"), newline="")
        df = files.read_csv(spark, str(tmp_path), "id BIGINT, v STRING, w STRING", header=False, multi_line=True)
        assert df.agg(F.sum("id"), F.count("v")).first()[:] == (sum(range(20000)), 20000)
        assert files.read_pieces(spark.read, str(tmp_path), "\n").select("_block").distinct().count() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_against_a_slow_walk():
    def slow(line, inside, escape):
        start, i = not inside, 0
        while i < len(line):
            c = line[i]
            if inside:
                if escape != '"' and c == escape:
                    i += 1
                elif c == '"':
                    if escape == '"' and line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        inside, start = False, False
            elif start and c == '"':
                inside = True
            else:
                start = c == ","
            i += 1
        return inside

    rng = random.Random(1)
    for _ in range(4000):
        line = "".join(rng.choice('ab",,""\\') for _ in range(rng.randrange(14)))
        for inside in (False, True):
            for escape in '"\\':
                want = slow(line, inside, escape)
                assert records._ends_inside(line.encode(), inside, b",", escape.encode()) == want, (line, inside, escape)
