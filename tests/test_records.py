"""Large single files cut into records by many tasks."""

import csv
import io
import json
import random

import pytest

from fundscape.plans import queries
from fundscape.sources import read_json_shape, read_table, records
from fundscape.sources.records import cut_records, csv_effects, read_csv_records
from fundscape.sources.tables import CSV_OPTIONS

BITS = ["plain", 'a "quoted" word', "two\nlines", "three\n\nlines, with commas", "", '"', '\r\nwindows', "back\\slash", "été", ",", " blanks ", '"\n"']


@pytest.fixture()
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def rows_of(n, seed):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choice(BITS) for _ in range(rnd.randrange(0, 6))) or None, rnd.choice(["x", None, "long " * 30])) for i in range(n)]


def write_csv(path, rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["i", "t", "u"])
    writer.writerows([["" if v is None else v for v in r] for r in rows])
    path.write_bytes(out.getvalue().encode())


@pytest.mark.parametrize("size, end", [(150, "\n"), (300, "\r\n")])
def test_csv_in_ranges_of_any_size(spark, tmp_path, small_ranges, size, end):
    rows = rows_of(20, size)
    write_csv(tmp_path / "t.csv", rows, end)
    small_ranges(size)
    df = read_table(spark, str(tmp_path / "t.csv"), _schema(), "csv", multiline=True)
    assert sorted(tuple(r) for r in df.collect()) == rows
    ranges = spark.read.text(str(tmp_path / "t.csv"), lineSep="\n").rdd.getNumPartitions()
    assert ranges > 3


def _schema():
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string("i int, t string, u string")


def test_more_ranges_than_are_broadcast(spark, tmp_path, small_ranges):
    rows = rows_of(15, 7)
    write_csv(tmp_path / "t.csv", rows)
    small_ranges(300)
    df = read_csv_records(spark, str(tmp_path / "t.csv"), _schema(), CSV_OPTIONS, most_ranges=3)
    assert sorted(tuple(r) for r in df.collect()) == rows


def test_several_files_with_headers_and_empty_ones(spark, tmp_path, small_ranges):
    folder = tmp_path / "many"
    folder.mkdir()
    rows = rows_of(24, 3)
    for k in range(3):
        write_csv(folder / f"{k}.csv", rows[8 * k : 8 * k + 8])
    write_csv(folder / "head.csv", [])
    (folder / "none.csv").write_text("")
    small_ranges(300)
    assert sorted(tuple(r) for r in read_table(spark, str(folder), _schema(), "csv", multiline=True).collect()) == rows


def test_first_is_the_header_even_where_it_has_line_breaks(spark, tmp_path, small_ranges):
    (tmp_path / "t.csv").write_text('"i","a long\nname of\na column"\n1,x\n2,"y\nz"\n')
    small_ranges(8)
    found = cut_records(spark, str(tmp_path / "t.csv"), "\n", csv_effects).collect()
    assert {r["record"]: r["first"] for r in found} == {'"i","a long\nname of\na column"': True, "1,x": False, '2,"y\nz"': False}


DOCS = [
    {"k": "a,b", "v": [1, 2, {"x": "]"}]}, {"k": 'quote " and \\ back', "v": []}, {"k": "{[", "v": [3]}, {"k": "", "v": None},
    {"k": "ends in \\", "v": [4]}, {"k": "line\nbreak, été", "v": [5, 6]},
]


@pytest.mark.parametrize("size, indent", [(40, None), (150, 2)])
def test_json_list_in_ranges_of_any_size(spark, tmp_path, small_ranges, size, indent):
    docs = [dict(DOCS[i % len(DOCS)], n=i) for i in range(18)]
    (tmp_path / "d.json").write_text("\n " + json.dumps(docs, indent=indent) + "\n")
    small_ranges(size)
    df = read_json_shape(spark, str(tmp_path / "d.json"), "records", {"k": "string", "n": "int"}, lines=False)
    assert sorted(tuple(r) for r in df.select("n", "k").collect()) == [(d["n"], d["k"]) for d in docs]


@pytest.mark.parametrize("size", [40])
def test_json_map_in_ranges_of_any_size(spark, tmp_path, small_ranges, size):
    lists = {f"id, {i}": [f"te\"rm {j}, [x" for j in range(i % 4)] for i in range(16)}
    (tmp_path / "m.json").write_text(json.dumps(lists))
    small_ranges(size)
    df = read_json_shape(spark, str(tmp_path / "m.json"), "map", lines=False)
    assert sorted(tuple(r) for r in df.collect()) == sorted((k, t) for k, ts in lists.items() for t in ts)


def test_empty_documents(spark, tmp_path):
    for name, text in (("a", "[]"), ("b", " {} \n"), ("c", "[ ]")):
        (tmp_path / name).write_text(text)
    assert read_json_shape(spark, str(tmp_path / "a"), "records", {"k": "string"}, lines=False).count() == 0
    assert read_json_shape(spark, str(tmp_path / "c"), "records", {"k": "string"}, lines=False).count() == 0
    assert read_json_shape(spark, str(tmp_path / "b"), "map", lines=False).count() == 0


def test_large_list_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    n = 30_000
    (tmp_path / "big.json").write_text(json.dumps([{"feature": f"f{i}", "importance": i / 2} for i in range(n)]))
    small_ranges(1 << 18)
    path = str(tmp_path / "big.json")
    assert spark.read.text(path, lineSep=",").rdd.getNumPartitions() > 3
    df = read_json_shape(spark, path, "records", {"feature": "string", "importance": "double"}, lines=False)
    assert df.count() == n and df.agg({"importance": "sum"}).first()[0] == n * (n - 1) / 4


def test_csv_rows_are_parsed_once_and_stored_without_their_text(spark, tmp_path, small_ranges, monkeypatch):
    rows = [(i, f"word {i}\nand more", "x") for i in range(40)]
    write_csv(tmp_path / "t.csv", rows)
    small_ranges(200)
    kept, store = {}, records.stored
    monkeypatch.setattr(records, "stored", lambda df, name, *more: kept.setdefault(name, store(df, name, *more)))
    got = read_table(spark, str(tmp_path / "t.csv"), _schema(), "csv", multiline=True)
    assert sorted(map(tuple, got.collect())) == rows
    whole = kept["records"].filter(f"kind = {records.WHOLE}")
    assert whole.count() > 0 and whole.filter("record IS NOT NULL").count() == 0


def test_raw_texts_are_read_for_the_projects_filter_only(spark, monkeypatch):
    """No text goes on into what is stored after the merge."""
    kept, store = [], queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, name, *more: (kept.append(df.columns), store(df, name, *more))[1])
    assert queries.QUERIES["raw_text_features"](spark, "/root/testdata/sf0.001").count() > 0
    assert kept and not any("objective" in columns for columns in kept)
