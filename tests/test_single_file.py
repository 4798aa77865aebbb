"""One file written by many tasks."""

import glob

import pytest

from fundscape.plans.queries import QUERIES
from fundscape.session import scratch_path
from fundscape.sources import read_table, write_single_file
from fundscape.sources.tables import CSV_OPTIONS


def the_file(path):
    found = [f for f in glob.glob(f"{path}/*") if not f.rsplit("/", 1)[1].startswith("_")]
    assert len(found) == 1
    return found[0]


def lines(spark, n=1000):
    text = "concat('a \"quoted\", ', id, '\n é', repeat('x', id % 50)) AS t"
    return spark.range(0, n, 1, 7).selectExpr("id", text).filter(f"id > {n // 4}")  # the first part is empty


@pytest.mark.parametrize("fmt, block", [("csv", 1000), ("csv", 1 << 20), ("json", 7001), ("text", 70)])
def test_bytes_are_those_of_one_writing_task(spark, tmp_path, fmt, block):
    df = lines(spark, 1000 if block > 70 else 100).select(*(["id"] if fmt != "text" else []), "t")
    path = f"{tmp_path}/in blocks"
    write_single_file(df, path, fmt, block)
    df.coalesce(1).write.options(**(CSV_OPTIONS if fmt == "csv" else {})).format(fmt).save(f"{tmp_path}/own")
    with open(the_file(path), "rb") as got, open(the_file(f"{tmp_path}/own"), "rb") as expected:
        assert got.read() == expected.read()


def test_empty_tables_and_used_folders(spark, tmp_path):
    none = lines(spark).filter("id < 0")
    write_single_file(none, f"{tmp_path}/csv", "csv")
    write_single_file(none.select("t"), f"{tmp_path}/text", "text")
    assert open(the_file(f"{tmp_path}/csv")).read() == "id,t\n" and open(the_file(f"{tmp_path}/text")).read() == ""
    assert read_table(spark, f"{tmp_path}/csv", none.schema, "csv", multiline=True).count() == 0
    with pytest.raises(Exception):
        write_single_file(lines(spark), f"{tmp_path}/csv", "csv")
    with pytest.raises(ValueError):
        write_single_file(none, f"{tmp_path}/parquet", "parquet")


@pytest.mark.parametrize("name, kept", [("csv_single_file", "csv-file"), ("json_single_document", "json-list")])
def test_no_task_writes_the_whole_table(spark, tmp_path, name, kept):
    docs = [(i, f"text {i}, \"it\" says [{{\n" + "word " * (i % 90), None if i % 5 == 0 else f"s{i % 3}") for i in range(400)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(8)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    sizes = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "6000", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in sizes}
    folders = lambda: set(glob.glob(scratch_path(spark, kept).removeprefix("file://").rsplit("-", 1)[0] + "-*"))
    there = folders()
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        got = QUERIES[name](spark, str(tmp_path))
        rows = sorted(tuple(r) for r in got.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    expected = [(i, 'He said "a,b"\n\n' + t) if name.startswith("csv") else (i, t, s) for i, t, s in docs]
    assert rows == expected
    (folder,) = folders() - there
    size = len(open(the_file(folder), "rb").read())
    parts = [len(open(f, "rb").read()) for f in glob.glob(f"{folder}/_parts/rows/part-*")]
    assert len(parts) >= 3 and max(parts) < size / 2 and 0 <= size - sum(parts) < 100
