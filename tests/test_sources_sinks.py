from __future__ import annotations

import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import ArrayType, FloatType

from images import LABELS, draw_tree
from tessera import sinks, sources
from tessera.session import get_session, list_settings, register_view


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    return draw_tree(spark, tmp_path_factory.mktemp("images"))


def test_image_files_takes_images_only(spark, tree):
    files = sources.labelled_images(spark, str(tree))
    assert files.columns == ["path", "modificationTime", "length", "content", "label"]
    assert files.count() == 13
    counted = {r.label: r["count"] for r in files.groupBy("label").count().collect()}
    assert counted == {LABELS[0]: 4, LABELS[1]: 5, LABELS[2]: 4}


def test_labels_do_not_read_the_contents(spark, tree):
    plan = (
        sources.labelled_images(spark, str(tree))
        .select("path", "label")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "content" not in plan.split("ReadSchema")[1]


def test_list_files_by_extension(spark, tree):
    def names(**options):
        return sorted(r.name for r in sources.list_files(spark, str(tree), **options).collect())

    assert len(names(recursive=True)) == 14
    assert names(ext="txt", recursive=True) == [f"{LABELS[0]}/notes.txt"]
    flat = sources.list_files(spark, str(tree / LABELS[1]), ext="jpg").collect()
    assert sorted(r.name for r in flat) == [f"{i}_100.jpg" for i in range(4)] + ["broken.jpg"]
    assert all(r.length > 0 for r in flat)


def test_decoded_images_mark_the_corrupt_one(spark, tree):
    images = sources.decode_images(spark, str(tree))
    broken = images.where("image.height < 0").collect()
    assert [(r.label, r.path.rsplit("/", 1)[1]) for r in broken] == [("Kiwi", "broken.jpg")]
    assert {r.label for r in images.select("label").distinct().collect()} == set(LABELS)
    whole = sources.decode_images(spark, str(tree), drop_invalid=True)
    assert whole.count() == 12
    assert whole.select("image.height", "image.width", "image.nChannels").distinct().collect() == [
        (100, 100, 3)
    ]


def test_csv_schema_modes(spark, tmp_path):
    (tmp_path / "users.csv").write_text(
        "name,age,gender\njon,45,male\nsarah,32,female\njane,65,female\njim,70,male\njoe,22,male\n"
    )
    path = str(tmp_path / "users.csv")
    assert sources.read_csv(spark, path).columns == ["_c0", "_c1", "_c2"]
    assert sources.read_csv(spark, path).count() == 6
    untyped = sources.read_csv(spark, path, header=True)
    assert [t for _, t in untyped.dtypes] == ["string"] * 3
    users = sources.read_csv(spark, path, header=True, infer=True)
    assert dict(users.dtypes)["age"] == "int"

    register_view(users, "users")
    average = spark.sql("SELECT gender, avg(age) AS average_age FROM users GROUP BY gender")
    assert {r.gender: r.average_age for r in average.collect()} == {
        "female": 48.5,
        "male": 45.666666666666664,
    }


def test_declared_csv_schema_is_positional_and_permissive(spark, tmp_path):
    (tmp_path / "prices.csv").write_text(
        ",symbol,data,open,market.cap\n1,AA,2019-01-02,3.5,$4B\n2,XX,bad,zz,$1M\n"
    )
    schema = "_c0 int, symbol string, data date, open double, `market.cap` string"
    prices = sources.read_csv(spark, str(tmp_path / "prices.csv"), header=True, schema=schema)
    with pytest.raises(AnalysisException):
        prices.select("market.cap")
    with pytest.raises(AnalysisException):
        prices.describe()
    plain = sources.rename_dotted(prices)
    assert plain.columns == ["_c0", "symbol", "data", "open", "market_cap"]
    assert [tuple(r) for r in plain.orderBy("_c0").collect()] == [
        (1, "AA", datetime.date(2019, 1, 2), 3.5, "$4B"),
        (2, "XX", None, None, "$1M"),
    ]


def test_json_scan_and_save(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    sinks.write_json(df, str(tmp_path / "j"))
    assert sorted(sources.read_json(spark, str(tmp_path / "j")).collect()) == [(1, "a"), (2, None)]


def test_save_fails_on_an_existing_path_and_overwrite_does_not(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "p")
    sinks.save(df, path, "parquet")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.save(df, path, "parquet")
    sinks.write_parquet(spark.range(5), path)
    assert sources.read_parquet(spark, path).count() == 5


def test_csv_write_of_selected_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5)], "k long, v string, w double")
    sinks.write_csv(df, str(tmp_path / "c"), ["w", "k"])
    assert sources.read_csv(spark, str(tmp_path / "c"), header=True).collect() == [("2.5", "1")]


def test_text_lines_and_whole_files(spark, tmp_path):
    lines = spark.createDataFrame([("one two",), ("drei",)], "value string").coalesce(1)
    sinks.write_text(lines, str(tmp_path / "t"))
    assert sorted(r.value for r in sources.read_text_lines(spark, str(tmp_path / "t")).collect()) == [
        "drei",
        "one two",
    ]
    whole = sources.read_text_files(spark, str(tmp_path / "t")).collect()
    assert [r.value for r in whole] == ["one two\ndrei\n"]


def test_legacy_parquet_layout_round_trip(spark, tmp_path):
    key = "spark.sql.parquet.writeLegacyFormat"
    try:
        assert get_session(legacy_parquet=True).conf.get(key) == "true"
        df = spark.createDataFrame([("a", [1.5, 2.5])], "label string, features array<float>")
        sinks.write_parquet(df, str(tmp_path / "legacy"))
    finally:
        spark.conf.unset(key)
    back = sources.read_parquet(spark, str(tmp_path / "legacy"))
    assert back.schema["features"].dataType == ArrayType(FloatType())
    assert back.collect() == [("a", [1.5, 2.5])]


def test_session_options(spark):
    keys = ["spark.sql.caseSensitive", "spark.sql.execution.arrow.maxRecordsPerBatch"]
    try:
        session = get_session(case_sensitive=True, arrow_batch_rows=512)
        assert session.conf.get(keys[0]) == "true"
        assert session.conf.get(keys[1]) == "512"
        df = session.createDataFrame([(1, 2)], "a int, A int")
        assert df.select("A").collect() == [(2,)]
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert list_settings(spark)["spark.app.name"]


def test_write_by_label_spreads_a_large_class(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id < 900 THEN 'big' ELSE 'small' END AS label")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        sinks.write_by_label(df, str(tmp_path / "s"), files_per_label=4, spread_by="id")
    finally:
        spark.conf.set(coalesce, "true")
    big = list((tmp_path / "s" / "label=big").glob("*.parquet"))
    assert 1 < len(big) <= 4
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 1000
    assert {r.label: r["count"] for r in back.groupBy("label").count().collect()} == {
        "big": 900,
        "small": 100,
    }


def test_text_with_line_ends_is_refused_or_replaced(spark, tmp_path):
    df = spark.createDataFrame([("one\ntwo\r\nthree",), ("four",)], "value string")
    with pytest.raises(Exception, match="line end"):
        sinks.write_text(df, str(tmp_path / "refused"))
    sinks.write_text(df, str(tmp_path / "replaced"), line_end=r" $1\ ")
    lines = sources.read_text_lines(spark, str(tmp_path / "replaced")).collect()
    assert sorted(r.value for r in lines) == ["four", r"one $1\ two $1\ three"]


def test_labels_keep_their_type(spark, tmp_path):
    rows = [(1, "001"), (2, ""), (3, None), (4, "7")]
    df = spark.createDataFrame(rows, "id long, label string")
    sinks.write_by_label(df, str(tmp_path / "labels"))
    assert sorted(map(tuple, sinks.read_by_label(spark, str(tmp_path / "labels")).collect())) == rows
