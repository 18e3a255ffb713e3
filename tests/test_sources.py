"""Readers and writers on temporary delimited files."""

import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from retailflow.schemas import ADJUSTMENT_HEADERS, schema
from retailflow.sources import readers, writers


def put(path, text, enc="utf-8"):
    path.write_bytes(text.encode(enc))
    return str(path)


def test_headered_csv_with_positions(spark, tmp_path):
    p = put(tmp_path / "points_a.csv", 'email,points\n"a,b@x",1\nb@x,\n\nc@x,x\n')
    df = readers.read_table(spark, p, schema("points_file"), pos=True, source="file")
    got = sorted(map(tuple, df.collect()), key=lambda r: r[2])
    assert [r[:2] for r in got] == [("a,b@x", 1), ("b@x", None), ("c@x", None)]
    assert len({r[2] for r in got}) == 3 and {r[3] for r in got} == {"points_a.csv"}


def test_columns_are_found_by_their_header(spark, tmp_path):
    """Extra and reordered columns, other spellings, two files of different layout; a missing column is an error."""
    a = put(tmp_path / "a.csv", "PO TYPE,Points,E-mail\nRegular,1,a@x\nRegular,,b@x\n")
    b = put(tmp_path / "b.csv", "email,note,points\nc@x,n,3\n")
    df = readers.read_many(spark, [a, b], schema("points_file"), "file", headers={"email": "E-mail"}, pos=True)
    got = sorted(map(tuple, df.collect()), key=lambda r: r[2])
    assert [(r[0], r[1], r[3]) for r in got] == [("a@x", 1, "a.csv"), ("b@x", None, "a.csv"), ("c@x", 3, "b.csv")]
    with pytest.raises(ValueError, match="points"):
        readers.read_table(spark, put(tmp_path / "c.csv", "email,amount\nx,1\n"), schema("points_file"))
    assert rows(readers.read_table(spark, put(tmp_path / "d.csv", "d@x,4\n"), schema("points_file"), header=False)) == [("d@x", 4)]


def test_only_named_columns_are_read(spark, tmp_path):
    p = put(tmp_path / "wide.csv", "a,email,b,points,c\n1,x,2,3,4\n")
    plan = readers.read_table(spark, p, schema("points_file"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<email:string,points:string>" in plan


def test_positions_follow_the_file_across_splits(spark, tmp_path):
    put(tmp_path / "big.csv", "email,points\n" + "".join(f"user{i}@example.com,{i}\n" for i in range(200_000)))
    put(tmp_path / "big2.csv", "email,points\n" + "".join(f"user{i}@example.com,{i}\n" for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        df = readers.read_many(spark, [str(tmp_path / "big.csv"), str(tmp_path / "big2.csv")], schema("points_file"), "f", pos=True)
        assert df.rdd.getNumPartitions() > 3
        got = [(r["f"], r["_pos"], r["points"]) for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for f in ("big.csv", "big2.csv"):
        mine = [n for _, _, n in sorted((x for x in got if x[0] == f), key=lambda x: x[1])]
        assert mine == list(range(len(mine)))


def test_tab_encoding_and_preamble(spark, tmp_path):
    t = put(tmp_path / "t.txt", "email\tpoints\né@x\t3\n", "latin-1")
    assert rows(readers.read_table(spark, t, schema("points_file"), sep="\t", encoding="ISO-8859-1")) == [("é@x", 3)]
    p = put(tmp_path / "p.csv", 'Report,"for, you"\nall,lines,here\n\ntype,sku,quantity,state\nOrder,"A,1",2,BC\n\nRefund,B,1,ON\n')
    df = readers.read_after_preamble(spark, p, schema("amz_transaction"), "type,sku")
    assert sorted(tuple(r)[:4] for r in df.collect()) == [("Order", "A,1", 2, "BC"), ("Refund", "B", 1, "ON")]


def test_newest_file_and_only_file(spark, tmp_path):
    a, b = put(tmp_path / "x-1.csv", "a\n"), put(tmp_path / "x-2.csv", "a\n")
    os.utime(a, (time.time() + 50, time.time() + 50))
    assert readers.latest_file(spark, str(tmp_path / "x-*.csv")).endswith("x-1.csv")
    with pytest.raises(ValueError):
        readers.only_file(spark, str(tmp_path / "x-*.csv"))
    assert readers.only_file(spark, str(tmp_path / "x-2*.csv")).endswith("x-2.csv")


def test_snapshots_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "email string, points int")
    root = str(tmp_path / "snap")
    writers.write_snapshot(df, root, date(2024, 1, 1))
    writers.write_snapshot(df.withColumn("points", df.points + 1), root, date(2024, 1, 2))
    out = readers.read_snapshot(spark, root, date(2024, 1, 2))
    assert rows(out) == [("a", 2)]
    assert "PartitionFilters: [isnotnull(snapshot_date" in out._jdf.queryExecution().executedPlan().toString()


def test_cleaning(spark):
    df = spark.createDataFrame([(" a ", None, 1), ("", None, 2), ("Summary", 3, 3), (None, None, 4)], "c string, n int, _pos int")
    assert rows(readers.drop_empty(df).select("c")) == [(" a ",), ("Summary",)]
    assert rows(readers.trim_strings(df).select("c").limit(1)) == [("a",)]
    assert [r["n"] for r in readers.blank_to_zero(df, ["n"]).collect()] == [0, 0, 3, 0]
    assert readers.drop_marker_rows(df, "c", ["Summary"]).count() == 3


def test_folder_names(spark):
    df = spark.createDataFrame([("P12 - AAA -  Best Co - note - sent 5/1",), ("P13- BBB - v",)], "f string")
    assert rows(readers.parse_folder_name(df, "f").select("po", "category", "vendor", "memo")) == [
        ("P12", "AAA", "Best Co", "P12 - AAA -  Best Co - note"), ("P13", "BBB", "v", "P13- BBB - v")]


def test_export_spelling_and_blanks(spark, tmp_path):
    df = spark.createDataFrame([(date(2024, 5, 6), "A-é", None)], "date date, item string, adjust_qty_by int")
    out = str(tmp_path / "out")
    writers.write_export(df, out, ADJUSTMENT_HEADERS)
    lines = {x for f in os.listdir(out) if f.endswith(".csv") for x in open(os.path.join(out, f), encoding="utf-8").read().splitlines()}
    assert lines == {"Date,ITEM,ADJUST QTY. BY", "05/06/2024,A-é,"}


def test_one_folder_per_category(spark, tmp_path):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "category string, n int")
    out = str(tmp_path / "cats")
    writers.write_partitioned(df, out, "category")
    assert sorted(d for d in os.listdir(out) if d.startswith("category")) == ["category=a", "category=b"]
    assert spark.read.parquet(out).count() == 51


def scans(df):
    return len([x for x in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n") if "FileScan" in x])


def test_a_pattern_reads_every_file_by_its_own_header(spark, tmp_path):
    put(tmp_path / "m1.csv", "sku,qty\nA,1\nB,2\n")
    put(tmp_path / "m2.csv", "qty,note,sku\n7,x,C\n,,D\n")
    put(tmp_path / "m3.csv", "sku,qty\nE,5\n")
    put(tmp_path / "m4.csv", "")
    put(tmp_path / "m 5,%.csv", "sku,qty\nF,6\n")
    df = readers.read_table(spark, str(tmp_path / "m*.csv"), readers.T.StructType.fromDDL("sku string, qty int"), pos=True, source="f")
    got = sorted(map(tuple, df.collect()), key=lambda r: r[2])
    assert [(r[0], r[1], r[3]) for r in got] == [("F", 6, "m 5,%.csv"), ("A", 1, "m1.csv"), ("B", 2, "m1.csv"), ("C", 7, "m2.csv"), ("D", None, "m2.csv"), ("E", 5, "m3.csv")]
    assert scans(df) == 2  # distinct headers


def test_any_number_of_files(spark, tmp_path):
    for i in range(1100):
        put(tmp_path / f"n{i:05d}.csv", f"email,points\nu{i},{i}\n" if i % 2 else f"points,email\n{i},u{i}\n")
    paths = [str(tmp_path / f"n{i:05d}.csv") for i in reversed(range(1100))]
    df = readers.read_many(spark, paths, schema("points_file"), "f", pos=True)
    assert scans(df) == 2
    assert [r["points"] for r in sorted(df.collect(), key=lambda r: r["_pos"])] == list(reversed(range(1100)))


def test_blank_and_repeated_header_cells(spark, tmp_path):
    p = put(tmp_path / "h.csv", "﻿email,,Email,points,\na,1,b,2,3\n")
    assert rows(readers.read_table(spark, p, schema("points_file"))) == [("a", 2)]
    with pytest.raises(ValueError, match="header"):
        readers.read_table(spark, put(tmp_path / "none.csv", ""), schema("points_file"))


def test_census_stops_at_the_header(spark, tmp_path):
    p = put(tmp_path / "long.csv", "email,points\n" + "someone@example.com,1\n" * 400_000)
    assert [(f.head, f.size) for f in readers.census(spark, p)] == [("email,points", os.path.getsize(p))]
    assert [f.head for f in readers.census(spark, p, "some")] == ["someone@example.com,1"]
    assert readers.read_table(spark, p, schema("points_file")).count() == 400_000


def test_preambles_of_files_of_one_name(spark, tmp_path):
    for folder, text in (("a", "note\ntype,sku,quantity,order state\nOrder,A,1,BC\n"), ("b", "x\ny\nz\ntype,sku,order state,quantity\nRefund,B,ON,2\n")):
        (tmp_path / folder).mkdir()
        put(tmp_path / folder / "p.csv", text)
    df = readers.read_after_preamble(spark, str(tmp_path / "*" / "p.csv"), schema("amz_transaction"), "type,sku")
    assert [tuple(r)[:4] for r in sorted(df.collect(), key=lambda r: r["_pos"])] == [("Order", "A", 1, "BC"), ("Refund", "B", 2, "ON")]
    put(tmp_path / "a" / "q.csv", "nothing of the kind\n")
    with pytest.raises(ValueError, match="q.csv"):
        readers.read_after_preamble(spark, str(tmp_path / "a"), schema("amz_transaction"), "type,sku")


def test_ordered_export(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("n"), F.concat(F.lit("A-B-"), F.lpad((F.col("id") % 9).cast("string"), 2, "0")).alias("item")).repartition(7)
    for name, kw, key in (("n", {"order": ["-n"]}, lambda r: -int(r[0])), ("s", {"sku_order": "item"}, lambda r: r[1])):
        out = str(tmp_path / name)
        writers.write_export(df, out, {"n": "N", "item": "ITEM"}, **kw)
        lines = [line.split(",") for f in writers.ordered_files(spark, out) for line in open(f).read().splitlines()[1:]]
        assert len(lines) == 1000 and [key(r) for r in lines] == sorted(key(r) for r in lines)
        assert spark.read.option("header", True).csv(out).count() == 1000
    with pytest.raises(ValueError, match="item"):
        writers.write_export(df, str(tmp_path / "x"), {"n": "N"})


def test_totals_are_checked_while_writing(spark, tmp_path):
    df = spark.range(10)
    checks = {"total": (F.sum("id"), 45), "n": (F.count("*"), None)}
    assert writers.write_checked(df, str(tmp_path / "a"), checks) == {"total": 45, "n": 10}
    with pytest.raises(writers.TotalsDiffer, match="total: 45 written, 44 stated"):
        writers.write_checked(df, str(tmp_path / "b"), {"total": (F.sum("id"), 44)})
    assert spark.read.parquet(str(tmp_path / "b")).count() == 10
    assert writers.write_checked(df, str(tmp_path / "c"), {"total": (F.sum("id"), 44)}, fail=False) == {"total": 45}


def test_a_table_read_and_replaced_in_one_job(spark, tmp_path, monkeypatch):
    t = writers.VersionedTable(spark, str(tmp_path / "t"), readers.T.StructType.fromDDL("k int, v string"))
    assert t.version() == 0 and t.read().collect() == []
    assert t.replace(spark.createDataFrame([(1, "a")], "k int, v string")) == 1
    assert t.replace(t.read().unionByName(spark.createDataFrame([(2, "b")], "k int, v string"))) == 2
    assert rows(t.read()) == [(1, "a"), (2, "b")] and rows(t.read(1)) == [(1, "a")]

    def lost(self, version, folder):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(writers.VersionedTable, "_commit", lost)
    with pytest.raises(RuntimeError):
        t.replace(t.read().filter("k = 1"))
    monkeypatch.undo()
    assert t.version() == 2 and rows(t.read()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="version 9"):
        t.read(9)


def test_percent_text_in_an_export(spark, tmp_path):
    out = str(tmp_path / "pct")
    writers.write_export(spark.createDataFrame([("a", 0.255)], "item string, share double").coalesce(1), out, {"item": "ITEM", "share": "Share"}, percents=["share"])
    assert rows(spark.read.option("header", True).csv(out)) == [("a", "25.5%")]


def test_uploads_have_headers_for_all_their_columns(spark):
    """Layouts and jobs agree: what a job returns is what its header map names, in its order."""
    from retailflow import schemas
    from retailflow.jobs import orders, stock
    assert orders.SALES_ORDER == tuple(schemas.SALES_ORDER_HEADERS) and len(schemas.MARKET_ORDER_HEADERS) == 48
    tpl = spark.createDataFrame([], "extra_note_1 string, shipment_order_date string, sku string, total_quantity int, shipping_service string, billing_state string")
    assert stock.tpl_log_rows(tpl).columns == list(schemas.STATUS_LOG_HEADERS)
    assert {*stock.transfer(date(2024, 1, 1), "s", "a", "b", "r", "m", "by", "t"), "item", "quantity"} == set(schemas.TRANSFER_HEADERS)
