"""Delimited files, typed tables, catalog and staging."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.sources import delimited, staging, tables


def test_latin1_text_and_quoted_separators(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_bytes('Order Country,Product Name,n\nMéxico,"Bike, red ""XL""",1\nPerú,plain,2\n'.encode("latin-1"))
    rows = delimited.read_delimited(
        spark, str(path), "`Order Country` string, `Product Name` string, n int", delimited.LATIN_1)
    assert [tuple(r) for r in rows.filter(F.col("`Order Country`") == "México").collect()] == [
        ("México", 'Bike, red "XL"', 1)]


def test_header_must_match_the_schema(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        delimited.read_delimited(spark, str(path), "a int, b int").collect()
    text = delimited.read_delimited_text(spark, str(path))
    assert text.select("a").first().a == "2"


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(PySparkException):
        delimited.read_delimited(spark, str(tmp_path / "none.csv"), "a int").collect()


def test_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a,b", 0.1), (2, None, 1e-17)], "i int, s string, x double")
    delimited.write_delimited(rows, str(tmp_path / "out"))
    back = delimited.read_delimited(spark, str(tmp_path / "out"), rows.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_staging_uses_the_configured_folder(spark):
    root = staging.staging_root(spark)
    assert root == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    staged = staging.stage(spark.range(5), "five")
    assert staged.count() == 5 and all(root.split(":")[-1] in f for f in staged.inputFiles())


def test_wide_keys_only_widen_identifiers():
    assert tables.wide_keys("order_id INT, order_year INT, price DECIMAL(10,2)") == (
        "order_id BIGINT, order_year INT, price DECIMAL(10,2)")


def test_named_view(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert tables.named_table(spark, "three_rows").count() == 3


def test_missing_texts_never_become_numbers(spark, tmp_path):
    from millrace.functions.numeric import clip
    from millrace.sources.delimited import read_delimited_text

    with open(tmp_path / "rows.csv", "w") as out:
        out.write("a,b\n1.5,x\nNaN,N/A\nN/A,y\n,null\n")
    rows = read_delimited_text(spark, str(tmp_path / "rows.csv"))
    got = rows.select(clip(F.col("a").cast("double"), 0.0, 1.0).alias("a"), "b").collect()
    assert [tuple(r) for r in got] == [(1.0, "x"), (None, None), (None, "y"), (None, None)]
    assert spark.range(1).select(clip(F.lit(float("nan")), 0.0, 9.0).alias("c")).first().c is None


def test_rejects_neither_raise_nor_vanish(spark, tmp_path):
    from millrace.operators.columns import accepted, reject_counts, rejected

    (tmp_path / "rows.csv").write_text("id,price,made,name\n1,2.5,2024-01-05,x\n2,abc,2024-13-05,NaN\n3.0,N/A,,\"a,b\"\n"
                                       "4,1\n5,1,2024-01-01,y,z\n6.5,1e3,2024-01-01,nan\n")
    checked = delimited.read_checked(spark, str(tmp_path / "rows.csv"), "id int, price double, made date, name string")
    stored = staging.stage(checked, "checked")
    assert [(r.id, r.price, str(r.made), r.name) for r in accepted(stored).orderBy("id", "name").collect()] == [
        (None, 1000.0, "2024-01-01", None), (1, 2.5, "2024-01-05", "x"), (2, None, "None", None), (3, None, "None", "a,b")]
    assert sorted(map(tuple, rejected(stored).collect())) == [
        ("", "fields", "4,1"), ("", "fields", "5,1,2024-01-01,y,z"), ("id", "no int", "6.5"), ("made", "no date", "2024-13-05"),
        ("price", "no double", "abc")]
    assert {(r.column, r.cause): r.n for r in reject_counts(stored).collect()}["", "fields"] == 2
    # The typed and the text read share one rule for missing values.
    typed = delimited.read_delimited(spark, str(tmp_path / "rows.csv"), "id string, price string, made string, name string")
    text = delimited.read_delimited_text(spark, str(tmp_path / "rows.csv"))
    whole = lambda rows: sorted((tuple(r) for r in rows.collect() if r.id not in ("4", "5")), key=str)
    assert whole(typed) == whole(text)


def test_compressed_files_read_back_the_same(spark, tmp_path, monkeypatch):
    """Rows with quotes, accents, nulls and copies; files are cut at the given number of rows."""
    monkeypatch.setattr(delimited, "FILE_ROWS", 300)
    data = [(i, 'a "quoted", México' if i % 3 else None, i / 7) for i in range(1000)] * 2
    rows = spark.createDataFrame(data, "id bigint, name string, x double").coalesce(1)
    for encoding in ("UTF-8", delimited.LATIN_1):
        path = tmp_path / encoding
        delimited.write_delimited(rows, str(path), encoding, compression="gzip")
        assert len(list(path.glob("*.csv.gz"))) == 7
        got = delimited.read_delimited(spark, str(path), rows.schema, encoding)
        assert sorted(got.collect(), key=str) == sorted(rows.collect(), key=str)


@pytest.mark.parametrize("name", ["latin1_scan", "enforced_types"])
def test_queries_store_delimited_copies_compressed(spark, tmp_path, monkeypatch, name):
    from millrace.plans.warehouse import Warehouse
    from millrace.queries import intake

    monkeypatch.setattr(intake, "new_location", lambda spark, label: str(tmp_path / label))
    work = Warehouse(spark, "/root/testdata/sf0.001")
    assert getattr(intake, name)(work).count() > 0
    files = [f.name for f in tmp_path.glob("*/part-*")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert "extract" not in vars(work)  # the extract is written once, as the delimited copy
