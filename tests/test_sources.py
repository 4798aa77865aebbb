import json

import pytest
from pyspark.sql import functions as F

from fundscape.operators.relevance import distinct_values
from fundscape.plans import analysis
from fundscape.session import scratch_path
from fundscape.sources import (
    mark_missing,
    read_json_shape,
    read_stage,
    read_table,
    schemas,
    small_table,
    write_artifact,
)


def test_gdp_csv_quotes_and_empty_values(spark, tmp_path):
    path = tmp_path / "gdp.csv"
    path.write_text(
        "Country Name,Country Code,Indicator Name,Indicator Code,2023\n"
        'Aruba,ABW,GDP (current US$),NY.GDP.MKTP.CD,3648573136\n"Bahamas, The",BHS,GDP (current US$),NY.GDP.MKTP.CD,\n'
    )
    df = read_table(spark, str(path), schemas.GDP, "csv")
    assert [tuple(r)[:2] + (r["2023"],) for r in df.collect()] == [("Aruba", "ABW", "3648573136"), ("Bahamas, The", "BHS", None)]


def test_csv_roundtrip_keeps_awkward_text(spark, tmp_path):
    rows = [(1, ' outer blanks '), (2, 'two\nlines'), (3, 'a "quoted", text'), (4, "back\\slash"), (5, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    path = str(tmp_path / "t")
    write_artifact(df, path, "csv")
    assert sorted(tuple(r) for r in read_table(spark, path, df.schema, "csv", multiline=True).collect()) == rows


def test_missing_markers(spark):
    df = spark.createDataFrame([("NA", 1), ("NAM", 2), ("", 3), (None, 4)], "c string, n int")
    assert [r["c"] for r in mark_missing(df).orderBy("n").collect()] == [None, "NAM", None, None]


def test_json_shapes(spark, tmp_path):
    def put(name, doc):
        (tmp_path / name).write_text(json.dumps(doc))
        return str(tmp_path / name)

    records = put("a.json", [{"feature": "x", "importance": 0.5}, {"feature": "y", "importance": None}])
    fields = {"feature": "string", "importance": "double"}
    assert [tuple(r) for r in read_json_shape(spark, records, "records", fields, lines=False).collect()] == [("x", 0.5), ("y", None)]
    columns = put("b.json", {"country": ["MT", "CY"], "score": [0.1, 0.2]})
    got = read_json_shape(spark, columns, "columns", {"country": "string", "score": "double"}, lines=False)
    assert got.columns == ["country", "score"] and [tuple(r) for r in got.collect()] == [("MT", 0.1), ("CY", 0.2)]
    lists = put("c.json", {"1": ["a", "b"], "2": [], "3": ["c"]})
    assert [tuple(r) for r in read_json_shape(spark, lists, "map", lines=False).collect()] == [("1", "a"), ("1", "b"), ("3", "c")]
    even = put("d.json", {"1": ["a", "b"], "2": ["c", "d"]})
    assert read_json_shape(spark, even, "map", lines=False).columns == ["project_id", "term"]
    assert read_json_shape(spark, lists, "raw", lines=False).count() == 1
    with pytest.raises(ValueError):
        read_json_shape(spark, lists, "guess")


def test_distinct_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "status string")
    assert distinct_values(df, "status").count() == 2


def test_small_table_is_broadcast_up_to_a_size(spark):
    for n, hinted in ((10_000, True), (10_001, False)):
        table = small_table(spark, [(i,) for i in range(n)], "i int")
        assert table.count() == n
        assert ("broadcast" in table._jdf.queryExecution().logical().toString()) == hinted



def test_scratch_path_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "nothing"), schemas.PROJECT)


def inputs(spark):
    members = ["MT", "CY", "HR", "ES", "DE", "GR"]
    orgs, projects = [], []
    for p in range(1, 61):
        topic = "HORIZON-CL5-2021" if p % 3 else "HORIZON-CL4-2021"
        text = f"Carbon capture number w{p} with clean energy and green hydrogen {'growth' * (p % 2)} plant x{p % 7}"
        projects.append((p, topic, text, ["SIGNED", "Closed", "TERMINATED"][p % 3], f"{p}.000,50"))
        for i in range(1 + p % 4):
            country = members[(p * (i + 1) + i * i) % len(members)]
            orgs.append((p, 100 + (p * 7 + i) % 40, country, f"{p * 10 + i * 3},25", "1"))
    orgs.append((1, 500, "EL", "1,00", "1"))
    return (
        spark.createDataFrame(projects, "id long, topics string, objective string, status string, totalCost string"),
        spark.createDataFrame(orgs, "projectID long, organisationID long, country string, ecContribution string, totalCost string"),
        spark.createDataFrame(
            [("Malta", "MLT", "20"), ("Cyprus", "CYP", "30"), ("Croatia", "HRV", "80"), ("Spain", "ESP", "1600"),
             ("Germany", "DEU", "4500"), ("Greece", "GRC", None), ("World", "WLD", "9")],
            "`Country Name` string, `Country Code` string, `2023` string",
        ),
    )


def test_whole_analysis_and_single_stage(spark, tmp_path):
    out = str(tmp_path / "out")
    analysis.run(spark, out, *inputs(spark))
    scores = read_stage(spark, out, "country_scores").collect()
    assert len(scores) == 7 and sum(r["is_average"] for r in scores) == 1
    weighted = read_stage(spark, out, "country_features_weighted")
    assert {"Weighted_Score", "Score", "x_2d", "y_2d", "quintile", "ramp"} <= set(weighted.columns)
    assert read_stage(spark, out, "projects_preprocessed").filter("country = 'EL'").count() == 1
    assert read_stage(spark, out, "gdp_preprocessed").filter("iso2 IS NULL").count() == 1
    assert read_stage(spark, out, "project_statuses").count() == 3
    assert read_stage(spark, out, "eu_iso2").count() == 27
    importance = read_stage(spark, out, "feature_importance")
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    fits = {r["label"]: r for r in read_stage(spark, out, "score_models").collect()}
    assert set(fits) == {"Score", "Weighted_Score"} and all(1 <= r["kept"] <= r["trees"] == 20 for r in fits.values())
    phrases = read_stage(spark, out, "project_keyphrases")
    assert phrases.count() > 0 and phrases.filter(F.size("phrases") > 5).count() == 0
    before = sorted(map(str, read_stage(spark, out, "country_projections").collect()))
    assert len(before) == 2 and "Malta is compared to Cyprus" in "".join(before)
    analysis.run(spark, out, stages=["future_projections"])
    assert sorted(map(str, read_stage(spark, out, "country_projections").collect())) == before
    with pytest.raises(ValueError):
        analysis.run(spark, out, stages=["nothing"])
