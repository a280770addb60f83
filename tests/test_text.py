"""Delimited text in and out."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from facetrank.functions import split_items
from facetrank.schemas import COUNTRIES, INPUTS, MISSING
from facetrank.sinks import (
    clean_versions,
    drop_table,
    is_writable,
    overwrite_table,
    write_delimited,
)
from facetrank.sources import load_titles, open_titles, read_delimited, read_titles
from tests import micro
from tests.conftest import rows

SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("title", StringType()),
        StructField("year", IntegerType()),
        StructField("score", DoubleType()),
        StructField("tags", ArrayType(StringType())),
    ]
)
LINES = [
    "id\ttitle\tyear\tscore\ttags",
    'a1\t"Quoted" start\t2001\t1.5\tA,B',
    'a2\t"unbalanced\t2002\t2.5\tA',
    "a3\tback\\slash\t2003\t3.5\tA",
    "a4\tmarker\t\\N\t\\N\t\\N",
    "a5\tbad number\tbad\tworse\tA",
    "a6\tempty list\t2006\t6.5\t",
    "a7\tshort\t2007",
    "a8\tlong\t2008\t8.5\tA\textra",
    "a9\tempty token\t2009\t9.5\tA,,B",
    "b1\t\t\t\t A, B ",
]
EXPECTED = [
    ("a1", '"Quoted" start', 2001, 1.5, ("A", "B")),
    ("a2", '"unbalanced', 2002, 2.5, ("A",)),
    ("a3", "back\\slash", 2003, 3.5, ("A",)),
    ("a4", "marker", None, None, None),
    ("a5", "bad number", None, None, ("A",)),
    ("a6", "empty list", 2006, 6.5, ()),
    ("a7", "short", 2007, None, None),
    ("a8", "long", 2008, 8.5, ("A",)),
    ("a9", "empty token", 2009, 9.5, ("A", "", "B")),
    ("b1", "", None, None, (" A", " B ")),
]


def test_edge_lines(spark, tmp_path):
    path = tmp_path / "edge.tsv"
    path.write_text("\n".join(LINES) + "\n")
    assert rows(read_delimited(spark, str(path), SCHEMA, header=True)) == EXPECTED


def test_header_is_skipped_in_every_file_and_kept_if_there_is_none(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"{part}.tsv").write_text(f"titleId\tcountry\nt{part}\tPeru,Chad\n")
    path = str(tmp_path)
    with_header = rows(read_delimited(spark, path, COUNTRIES, header=True))
    assert with_header == [(f"t{part}", ("Peru", "Chad")) for part in range(3)]
    assert len(rows(read_delimited(spark, path, COUNTRIES, header=False))) == 6


def test_quoted_mode(spark, tmp_path):
    path = tmp_path / "quoted.tsv"
    path.write_text('a1\t"tab\there ""x"""\t2001\t1.5\tA\n')
    got = rows(read_delimited(spark, str(path), SCHEMA, header=False, quoted=True))
    assert got == [("a1", 'tab\there "x"', 2001, 1.5, ("A",))]


def test_short_quoted_rows_lack_fields(spark, tmp_path):
    path = tmp_path / "quoted.tsv"
    path.write_text('a1\t"two\t""tabs\t\t\t"\na2\t"x"\t\n')
    got = rows(read_delimited(spark, str(path), SCHEMA, header=False, quoted=True), "id", "title", "tags")
    assert got == [("a1", 'two\t"tabs\t\t\t', None), ("a2", "x", None)]


@pytest.mark.parametrize("header", [False, True])
@pytest.mark.parametrize("quoted", [False, True])
def test_blank_lines_are_rows(spark, tmp_path, header, quoted):
    path = tmp_path / "blank.tsv"
    path.write_text("id\tcountry\n" * header + "t1\tPeru\n\n\t\n \nt2\tChad\n\n")
    got = rows(read_delimited(spark, str(path), COUNTRIES, header=header, quoted=quoted))
    assert got == [(" ", None), ("", ()), ("", None), ("", None), ("t1", ("Peru",)), ("t2", ("Chad",))]


@pytest.mark.parametrize("value", [("a\tb", []), ("a\nb", []), ("a\rb", []), ("a", ["x,y"]), ("a", ["x\ty"])])
def test_values_that_would_tear_a_row_are_errors(spark, tmp_path, value):
    df = spark.createDataFrame([value, ("fine", ["x", None])], "id string, tags array<string>")
    assert df.where(is_writable(df)).count() == 1
    with pytest.raises(Exception, match="separator or a line break"):
        write_delimited(df, str(tmp_path / "torn"))


def test_a_failed_or_wrong_rewrite_keeps_the_old_rows(spark):
    old = spark.range(3)
    overwrite_table(old, "kept_rows")
    failing = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="no"):
        overwrite_table(failing, "kept_rows")
    assert rows(spark.table("kept_rows")) == [(0,), (1,), (2,)]
    with pytest.raises(ValueError, match="columns"):
        overwrite_table(spark.range(1).withColumnRenamed("id", "other"), "kept_rows")
    assert rows(overwrite_table(spark.range(1), "kept_rows")) == [(0,)]
    spark.sql("DROP TABLE kept_rows")


def _versions(spark, table):
    root = Path(spark.catalog.getDatabase("default").locationUri.removeprefix("file:"))
    return len(list((root / f"{table}.versions").iterdir()))


def test_a_replace_spares_open_readers_and_the_table(spark):
    spark.sql("CREATE TABLE swapped (id BIGINT) USING parquet TBLPROPERTIES ('desk' = 'ann')")
    first = overwrite_table(spark.range(3), "swapped")
    second = overwrite_table(first.select((F.col("id") + 10).alias("id")), "swapped")  # reads itself
    third = overwrite_table(spark.range(1), "swapped")
    assert [rows(df) for df in (first, second, third)] == [
        [(0,), (1,), (2,)], [(10,), (11,), (12,)], [(0,)]
    ]
    properties = dict(tuple(r) for r in spark.sql("SHOW TBLPROPERTIES swapped").collect())
    assert properties["desk"] == "ann"
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("swapped_")]
    assert _versions(spark, "swapped") == 3
    assert clean_versions(spark, "swapped") == 0  # all are young
    assert clean_versions(spark, "swapped", older_than=0) == 2
    assert rows(spark.table("swapped")) == [(0,)] and _versions(spark, "swapped") == 1
    drop_table(spark, "swapped")
    assert not spark.catalog.tableExists("swapped")


def test_buckets_follow_the_stored_bytes_and_stay(spark, monkeypatch):
    from facetrank.sinks import tables

    monkeypatch.setattr(tables, "BUCKET_BYTES", 4096)
    # Spark expects a product of sizes for a join; what counts is what is stored.
    joined = spark.range(3000).join(spark.range(3000), "id")
    size = len(overwrite_table(joined, "by_bytes", bucket_by="id").inputFiles())
    assert 2 <= size <= 16
    kept = overwrite_table(spark.range(10), "by_bytes", bucket_by="id")
    assert rows(kept) == [(i,) for i in range(10)]
    with pytest.raises(ValueError, match="buckets"):
        overwrite_table(spark.range(10), "by_bytes", bucket_by="id", buckets=1000)
    with pytest.raises(ValueError, match="bucketed"):
        overwrite_table(spark.range(10), "by_bytes")
    with pytest.raises(ValueError, match="maxBuckets"):
        tables.bucket_count(spark, 10**12)
    drop_table(spark, "by_bytes")


def test_a_table_of_another_format_is_not_replaced(spark):
    spark.sql("CREATE TABLE lines_of_text (value STRING) USING text")
    with pytest.raises(ValueError, match="parquet"):
        overwrite_table(spark.createDataFrame([("a",)], "value string"), "lines_of_text")
    spark.sql("DROP TABLE lines_of_text")


def test_trimmed_items(spark, tmp_path):
    path = tmp_path / "c.tsv"
    path.write_text("t1\t A, B \n")
    plain = read_delimited(spark, str(path), COUNTRIES, header=False)
    assert rows(plain) == [("t1", (" A", " B "))]
    trimmed = read_delimited(spark, str(path), COUNTRIES, header=False, trim_items=True)
    assert rows(trimmed) == [("t1", ("A", "B"))]


def test_split_items(spark):
    df = spark.createDataFrame([("A|B",), ("",), (None,), ("|",)], "c string")
    assert rows(df.select(split_items("c", "|"))) == [((),), (("", ""),), (("A", "B"),), (None,)]


def test_round_trip_with_and_without_header(spark, tmp_path):
    data = [
        ("a1", ' "q" \\ ', 1, 0.1, ["x", "y"]),
        ("a2", None, None, None, None),
        ("a3", "", 3, 7.20909090909091, []),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    expected = rows(df)
    for header in (False, True):
        path = str(tmp_path / f"h{header}")
        write_delimited(df.repartition(2), path, header=header)
        assert rows(read_delimited(spark, path, SCHEMA, header=header)) == expected
    assert MISSING in spark.read.text(str(tmp_path / "hFalse")).toPandas()["value"].str.cat()


def test_five_inputs_from_text_to_bucketed_tables(spark, tmp_path):
    tables = micro.micro_tables(spark)
    paths = {name: str(tmp_path / name) for name in INPUTS}
    for name, form in INPUTS.items():
        write_delimited(getattr(tables, name), paths[name], header=form.header)
    text = read_titles(spark, paths)
    load_titles(text, database="inputs_db", buckets=2)
    load_titles(text, database="inputs_db", buckets=2)
    stored = open_titles(spark, "inputs_db")
    for name in INPUTS:
        assert rows(getattr(stored, name)) == rows(getattr(tables, name)), name
    # One table may turn out to have a header after all.
    skipped = read_titles(spark, paths, header={"countries": True})
    assert skipped.countries.count() < stored.countries.count()
    spark.sql("DROP DATABASE inputs_db CASCADE")
