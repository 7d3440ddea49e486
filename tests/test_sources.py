from __future__ import annotations

import datetime as dt
import sqlite3
from collections import Counter

import pytest

from bazar.sources import (
    Lake,
    describe_csv,
    infer_csv_schema,
    preview_csv,
    publish_layer,
    publish_table,
    query,
    read_csv,
    read_sqlite,
    register_views,
)
from bazar.sources.csv import TEXT_FORMS


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_csv_with_line_breaks_quotes_and_bom(spark, tmp_path):
    file = tmp_path / "reviews.csv"
    file.write_bytes('﻿id,text,zip\n1,"first\nsecond ""quoted""",02403\n2,,1\n'.encode())
    got = read_csv(spark, str(file), "id int, text string, zip string", multi_line=True)
    assert [tuple(r) for r in got.collect()] == [(1, 'first\nsecond "quoted"', "02403"), (2, None, "1")]
    assert got.columns == ["id", "text", "zip"]


def test_inferred_types_cover_every_value(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text(
        "n,code,x,flag,day,at,word,nothing,late\n"
        "1,02403,1.5,true,2018-01-01,2018-01-01 10:00:00,a,,1\n"
        "-7,12,2,FALSE,2018-02-28,2018-01-02 00:00:00,,,2\n"
        "0,7,1e3,true,,,c,,not a number\n"
    )
    assert dict(read_csv(spark, str(file), multi_line=False).dtypes) == {
        "n": "bigint",
        "code": "string",
        "x": "double",
        "flag": "boolean",
        "day": "date",
        "at": "timestamp_ntz",
        "word": "string",
        "nothing": "string",
        "late": "string",
    }
    first = read_csv(spark, str(file), multi_line=False).first()
    assert (first.code, first.at, first.flag) == ("02403", dt.datetime(2018, 1, 1, 10), True)
    assert len(TEXT_FORMS) == 5


def test_invalid_dates_and_wide_numbers_stay_text(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("day,n\n2018-13-01,123456789012345678901\n")
    assert [f.dataType.simpleString() for f in infer_csv_schema(spark, str(file), multi_line=False)] == ["string", "double"]


def test_csv_preview_and_describe(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("a,b\n" + "".join(f"{i},x\n" for i in range(30)))
    assert preview_csv(spark, str(file), 4, multi_line=False).count() == 4
    assert preview_csv(spark, str(file), multi_line=False).count() == 10
    assert [tuple(r) for r in describe_csv(spark, str(file), multi_line=False).collect()] == [("a", "bigint"), ("b", "string")]


def test_csv_columns_go_by_their_names(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("b,a\nx,1\ny,2\n")
    assert [tuple(r) for r in read_csv(spark, str(file), "a int, b string", multi_line=False).collect()] == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="columns"):
        read_csv(spark, str(file), "a int, c string", multi_line=False)


@pytest.mark.parametrize("body", ["a,b\n1,x\nbad,y\n", "a,b\n1,x\n2,y,z\n", 'a,b\n1,"x\ny"\n2,z\n'])
def test_csv_rows_that_do_not_fit_stop_the_job(spark, tmp_path, body):
    file = tmp_path / "t.csv"
    file.write_text(body)
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed|FAILED_READ_FILE"):
        read_csv(spark, str(file), "a int, b string", multi_line=False).collect()


def test_large_csv_is_read_by_several_tasks(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("a,b\n" + "1,x\n" * 200_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = read_csv(spark, str(file), "a int, b string", multi_line=False)
        assert df.rdd.getNumPartitions() > 4 and df.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_folder(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(f"a\n{i}\n")
    assert sorted(r.a for r in read_csv(spark, str(tmp_path), "a int", multi_line=False).collect()) == [0, 1, 2]


@pytest.fixture
def database(tmp_path):
    file = tmp_path / "leads.sqlite"
    con = sqlite3.connect(file)
    con.execute('CREATE TABLE t (id INTEGER, name TEXT, x REAL, day DATE, at TIMESTAMP, raw BLOB, "odd ""name" VARCHAR(5))')
    rows = [(i, f"n{i}" if i % 3 else None, i / 4, "2018-01-05", "2018-01-05 06:07:08", b"\x01", "o") for i in range(1000)]
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?, ?)", rows)
    con.execute("DELETE FROM t WHERE id BETWEEN 100 AND 899")
    con.execute("CREATE TABLE nobody (a INTEGER)")
    con.commit()
    con.close()
    return str(file)


def test_sqlite_table_is_read_in_ranges(spark, database):
    df = read_sqlite(spark, database, "t", partitions=4)
    assert df.dtypes == [
        ("id", "bigint"),
        ("name", "string"),
        ("x", "double"),
        ("day", "date"),
        ("at", "timestamp_ntz"),
        ("raw", "binary"),
        ('odd "name', "string"),
    ]
    assert df.rdd.getNumPartitions() == 4
    got = {r.id: r for r in df.collect()}
    assert sorted(got) == [*range(100), *range(900, 1000)]
    assert (got[1].name, got[3].name, got[1].x) == ("n1", None, 0.25)
    assert (got[5].day, got[5].at, bytes(got[5].raw)) == (dt.date(2018, 1, 5), dt.datetime(2018, 1, 5, 6, 7, 8), b"\x01")


def test_sqlite_empty_and_missing_tables(spark, database):
    assert read_sqlite(spark, database, "nobody").count() == 0
    with pytest.raises(Exception, match="no table 'absent'"):
        read_sqlite(spark, database, "absent").count()


def test_sqlite_folder_of_parts(spark, tmp_path):
    for part in range(3):
        con = sqlite3.connect(tmp_path / f"part{part}.sqlite")
        con.execute("CREATE TABLE t (a INTEGER)")
        con.executemany("INSERT INTO t VALUES (?)", [(part * 10 + i,) for i in range(10)])
        con.commit()
        con.close()
    assert sorted(r.a for r in read_sqlite(spark, str(tmp_path), "t", partitions=2).collect()) == list(range(30))


def test_write_modes(spark, lake):
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "a int")
    lake.write(one, "bronze", "t")
    lake.write(two, "bronze", "t", mode="append")
    assert sorted(r.a for r in lake.read("bronze", "t").collect()) == [1, 2]
    lake.write(two, "bronze", "t", mode="ignore")
    assert lake.read("bronze", "t").count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        lake.write(two, "bronze", "t", mode="error")
    lake.write(two, "bronze", "t")
    assert [r.a for r in lake.read("bronze", "t").collect()] == [2]
    assert lake.tables("bronze") == ["t"] and lake.exists("bronze", "t") and not lake.exists("bronze", "u")
    assert lake.tables("gold") == []


def test_table_rebuilt_from_itself(spark, lake):
    lake.write(spark.range(10), "bronze", "t")
    lake.write(lake.read("bronze", "t").filter("id > 6"), "bronze", "t")
    assert sorted(r.id for r in lake.read("bronze", "t").collect()) == [7, 8, 9]


def test_failed_overwrite_keeps_the_old_table(spark, lake):
    lake.write(spark.range(3), "bronze", "t")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        lake.write(spark.range(5).selectExpr("id div 0 as id"), "bronze", "t")
    assert lake.read("bronze", "t").count() == 3
    assert lake.tables("bronze") == ["t"]


def test_preview_and_describe(spark, lake):
    lake.write(spark.range(30).selectExpr("id", "cast(id as string) as name"), "gold", "t")
    assert lake.preview("gold", "t").count() == 10
    assert [r.id for r in lake.preview("gold", "t", 2, order=["-id"]).collect()] == [29, 28]
    assert [tuple(r) for r in lake.describe("gold", "t").collect()] == [("id", "bigint"), ("name", "string")]


def test_publish_and_query(spark, lake, tmp_path):
    lake.write(spark.range(3), "gold", "t")
    lake.write(spark.range(4), "gold", "u")
    assert publish_layer(lake, "gold", "shop", location=str(tmp_path / "shop")) == ["shop.t", "shop.u"]
    assert query(spark, "select count(*) as n from shop.t join shop.u using (id)").first().n == 3
    # published again after a change
    lake.write(spark.range(9), "gold", "t")
    assert publish_table(lake, "gold", "t", "shop") == "shop.t"
    assert query(spark, "select count(*) as n from shop.t").first().n == 9


def test_views(spark, lake):
    lake.write(spark.range(3), "bronze", "seen")
    lake.write(spark.range(5), "silver", "seen")
    assert register_views(lake) == ["seen", "seen"]
    assert Counter(query(spark, "select count(*) as n from seen").first()) == Counter([5])


def test_unfinished_and_later_writers(spark, lake):
    lake.write(spark.range(3), "bronze", "t")
    whole = lake.path("bronze", "t")
    # a writer that was killed leaves a folder without its end mark
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{lake.root}/bronze/t/99999999999999999999-killed")
    assert lake.path("bronze", "t") == whole and lake.read("bronze", "t").count() == 3
    # a reader of the table as it was goes on while another writer replaces it
    reader = lake.read("bronze", "t")
    Lake(spark, lake.root).write(spark.range(5), "bronze", "t")
    assert reader.count() == 3 and lake.read("bronze", "t").count() == 5 and lake.tables("bronze") == ["t"]


def test_failed_publish_leaves_the_old_table(spark, lake, tmp_path):
    lake.write(spark.range(4), "gold", "t")
    publish_table(lake, "gold", "t", "kept", location=str(tmp_path / "kept"))
    broken = Lake(spark, str(tmp_path / "absent"))
    with pytest.raises(Exception):
        publish_table(broken, "gold", "t", "kept")
    assert spark.table("kept.t").count() == 4
