from __future__ import annotations

import random
import tempfile

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newsloom.sources import readers, writers
from newsloom.sources.csv_split import csv_records

SCHEMA = "id long, text string, note string"


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="csv-")


@pytest.fixture
def split_at(spark):
    """Sets the bytes of a split, and puts the session's own back."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}

    def change(size: int) -> None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


def _rows(seed, n, most):
    rng = random.Random(seed)
    signs = ['"', "\n", "\r\n", ",", "a", "é", " ", '""', "\n\n", "\\", "word", "😀"]
    text = lambda: "".join(rng.choice(signs) for _ in range(rng.randint(0, most))) or None
    return [(i, text(), rng.choice([None, "x", text()])) for i in range(n)]


@pytest.mark.parametrize(("size", "most"), [(64, 6), (300, 60), (10**8, 40)])
def test_rows_equal_those_of_one_task(spark, folder, split_at, size, most):
    rows = _rows(size, 25, most)
    path = writers.write_csv(spark.createDataFrame(rows, SCHEMA), folder + "/one", parts=1)
    want = tuples(readers.read_csv(spark, path, spark.createDataFrame([], SCHEMA).schema))
    split_at(size)
    got = readers.read_csv(spark, path, spark.createDataFrame([], SCHEMA).schema, split=True)
    assert tuples(got) == want and len(want) == 25
    if size < 10**8:
        assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 3


def test_rows_equal_when_parities_are_shuffled(spark, folder, split_at, monkeypatch):
    monkeypatch.setattr("newsloom.sources.csv_split.small_enough", lambda df: False)
    path = writers.write_csv(spark.createDataFrame(_rows(3, 25, 60), SCHEMA), folder + "/one", parts=1)
    schema = spark.createDataFrame([], SCHEMA).schema
    want = tuples(readers.read_csv(spark, path, schema))
    split_at(300)
    assert tuples(readers.read_csv(spark, path, schema, split=True)) == want


def test_several_files_blank_lines_and_an_open_end(spark, folder, split_at):
    files = {
        "a.csv": 'id,text,note\n1,"x\n\ny",n\n\n2,plain,\n',
        "b.csv": 'id,"te\nxt",note\n3,"a ""quoted"" part","\n"\n4,z,w',  # the header goes over two lines, no last line end
        "c.csv": "id,text,note\n",
        "d.csv": "",
        "e.csv": 'id,text,note\n5,"never closed\nand more\n6,x,y\n',
    }
    for name, content in files.items():
        with open(f"{folder}/{name}", "w", newline="") as file:
            file.write(content)
    split_at(16)
    got = tuples(csv_records(spark, folder))
    want = ['1,"x\n\ny",n', "2,plain,", '3,"a ""quoted"" part","\n"', "4,z,w", '5,"never closed\nand more\n6,x,y']
    assert got == sorted(((w,) for w in want), key=repr)
    rows = readers.read_csv(spark, folder, spark.createDataFrame([], SCHEMA).schema, split=True)
    assert tuples(rows.where("id < 5")) == [(1, "x\n\ny", "n"), (2, "plain", None), (3, 'a "quoted" part', "\n"), (4, "z", "w")]


def test_a_field_longer_than_many_splits(spark, folder, split_at):
    rows = [(1, "first", "x"), (2, "\n".join(f'line "{i}", more' for i in range(400)), "y"), (3, "last", None)]
    path = writers.write_csv(spark.createDataFrame(rows, SCHEMA), folder + "/one", parts=1)
    split_at(128)
    got = readers.read_csv(spark, path, spark.createDataFrame([], SCHEMA).schema, split=True)
    assert tuples(got) == rows



def test_large_tables_are_written_in_more_files(spark, tmp_path):
    """No task writes (and none that reads whole files reads) more than a bounded share of a table."""
    texts = spark.range(200).select(F.col("id").alias("n"), F.repeat(F.lit('a "b",\n'), 100).alias("text"))
    for number, source in enumerate((texts.coalesce(1), texts.repartition(64))):
        path = writers.write_csv(source, str(tmp_path / str(number)), 1, file_bytes=20_000)
        sizes = [p.stat().st_size for p in (tmp_path / str(number)).glob("*.csv")]
        assert 7 <= len(sizes) <= 12 and max(sizes) < 60_000
        for split in (False, True):
            read = readers.read_csv(spark, path, texts.schema, split=split)
            assert sorted(map(tuple, read.collect())) == sorted(map(tuple, texts.collect()))
    one = writers.write_csv(texts, str(tmp_path / "one"), 1, file_bytes=1 << 30)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1 and readers.read_csv(spark, one, texts.schema).count() == 200
