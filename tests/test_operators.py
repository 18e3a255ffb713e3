"""Operators on small frames with the awkward rows, and against brute force."""

import random

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from retailflow.operators import bins, groups, keys, lookup as lk, reshape, rules, scan


def test_lookup_keeps_row_count_and_matched_nulls(spark):
    df = spark.createDataFrame([("A",), ("B",), ("AB",), (None,), ("Z",)], "k string")
    dim = spark.createDataFrame([("A", 1, 1), ("A", 9, 2), ("B", None, 3)], "k string, v int, p int")
    out = lk.lookup(df, dim, "k", {"v": "x"}, order="p", defaults={"x": -1})
    assert rows(out) == rows(spark.createDataFrame([("A", 1), ("B", None), ("AB", -1), (None, -1), ("Z", -1)], "k string, x int"))


def test_salted_lookup_equals_plain(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = lk.lookup(df, dim, "k", ["v"], unique=True)
    salted = lk.lookup(df, dim, "k", ["v"], unique=True, salt=8)
    assert rows(plain) == rows(salted) and salted.count() == 3000


def test_salted_copies_are_not_broadcast(spark):
    df = spark.range(3000).select((F.col("id") % 50).alias("k"), "id")
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = lk.lookup(df, dim, "k", ["v"], unique=True, salt=8)
    out._jdf.queryExecution().toRdd().count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_lookup_chain_first_dimension_with_the_key_decides(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "k string")
    d1 = spark.createDataFrame([("A", None)], "k string, v string")
    d2 = spark.createDataFrame([("A", "no"), ("B", "yes")], "k string, v string")
    out = lk.lookup_chain(df, [(d1, "k"), (d2, "k")], ["v"], unique=True)
    assert rows(out) == [("A", None), ("B", "yes"), ("C", None)]


def test_rows_update_and_upsert(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "new"), (3, "none")], "k int, v string")
    assert rows(lk.rows_update(a, b, "k", ["v"])) == [(1, "x"), (2, "new")]
    s1 = spark.createDataFrame([(2,), (5,)], "k int")
    s2 = spark.createDataFrame([(1,), (2,), (6,)], "k int")
    out = keys.upsert_status(a, "k", "v", [(s1, "Synced"), (s2, "Shipped")])
    assert rows(out) == [(1, "Shipped"), (2, "Synced"), (5, "Synced"), (6, "Shipped")]


def test_upsert_sees_a_notice_once_per_key(spark):
    log = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, v string")
    notices = spark.createDataFrame([(2,), (2,), (1,), (1,), (None,), (None,)], "k int")
    out = keys.upsert_status(log, "k", "v", [(notices, "Synced"), (notices, "Shipped")])
    assert rows(out) == [(1, "Synced"), (1, "Synced"), (2, "Shipped"), (2, "Synced"), (None, "Shipped"), (None, "Synced"), (None, "z")]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    wide = spark.createDataFrame([(2, "b"), (2, "a")], "k int, w string")
    out = keys.upsert_status(spark.createDataFrame([(1, "x", "c")], "k int, v string, w string"), "k", "v", [(wide, "Synced")])
    assert rows(out) == [(1, "x", "c"), (2, "Synced", "a")]


def test_unions_by_key(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    b = spark.createDataFrame([(2, "b"), (3, "b"), (3, "c")], "k int, v string")
    assert rows(keys.union_prefer(a, b, "k")) == [(1, "a"), (2, "a"), (3, "b"), (3, "c")]
    assert rows(keys.union_first(a, b, "k", "v")) == [(1, "a"), (2, "a"), (3, "b")]
    want = spark.createDataFrame([(2,), (4,)], "k int")
    assert rows(keys.densify(a, want, {"v": "0"})) == [(1, "a"), (2, "a"), (4, "0")]
    ch = spark.createDataFrame([("g", "All", 1), ("g", "Web", 2), ("h", "Web", 3), ("i", "Shop", 4)], "g string, c string, n int")
    assert rows(keys.prefer_rows(ch, "g", "c", ["All", "Web"])) == [("g", "All", 1), ("h", "Web", 3)]


RULES = [("^A", 1.0, 1), ("AB", 2.0, 2), ("Z$", 3.0, 3), (None, 9.0, 4)]


def test_first_rule_wins_whatever_the_number_of_rules(spark):
    df = spark.createDataFrame([("ABZ",), ("XAB",), ("Z",), ("n",), (None,)], "t string")
    want = [("ABZ", 1.0), ("XAB", 2.0), ("Z", 3.0), ("n", None), (None, None)]
    shapes = []
    for more in (0, 2_000):
        r = spark.createDataFrame(RULES + [(f"none{i}", 5.0, 10 + i) for i in range(more)], "item string, price double, pos int")
        out = rules.regex_lookup(df, r, "t", "item", "pos", ["price"])
        assert rows(out) == rows(spark.createDataFrame(want, "t string, price double"))
        plan = out._jdf.queryExecution().sparkPlan().toString()
        shapes.append(re.findall(r"[A-Z]\w+(?= |$)", re.sub(r"[\[\(].*", "", plan)))
    assert shapes[0] == shapes[1]
    none = spark.createDataFrame([], "item string, price double, pos int")
    assert {r.price for r in rules.regex_lookup(df, none, "t", "item", "pos", ["price"]).collect()} == {None}


def brute_runs(data):
    out, prev, n = [], {}, {}
    for pos, day, v in sorted(data):
        if day not in prev or prev[day] != v:
            n[day] = n.get(day, 0) + 1
        prev[day] = v
        out.append((pos, n[day]))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_run_id_across_blocks(spark, block):
    rnd = random.Random(5)
    data = [(p, rnd.choice(["d1", "d1", None]), rnd.choice(["a", "b", None])) for p in range(400)]
    df = spark.createDataFrame(data, "pos bigint, day string, v string")
    out = scan.run_id(df, "v", "pos", ["day"], block_rows=block).select("pos", "run_id")
    assert sorted(map(tuple, out.collect())) == brute_runs([(p, str(d), v) for p, d, v in data])


@pytest.mark.parametrize("block", [1 << 20, 5])
def test_fill_down_across_blocks(spark, block):
    rnd = random.Random(6)
    data = [(p, rnd.choice([None, None, None, "x", "y"]), None if p < 300 else "z") for p in range(320)]
    df = spark.createDataFrame(data, "pos bigint, a string, b string")
    got = {r["pos"]: (r["a"], r["b"]) for r in scan.fill_down(df, ["a", "b"], "pos", block_rows=block).collect()}
    a = b = None
    for p, x, y in data:
        a, b = x or a, y or b
        assert got[p] == (a, b)


def test_blank_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "pos bigint, c string")
    assert rows(scan.blank_repeats(df, ["c"], "pos")) == [(1, "a"), (2, ""), (3, "b"), (4, "")]


@pytest.mark.parametrize("blocks", [64, 3])
def test_exact_quantiles(spark, blocks):
    df = spark.createDataFrame([(float(i),) for i in range(1, 5)], "x double")
    q = bins.exact_quantiles(df, "x", [0, .25, .5, .75, 1], blocks).first()["q"]
    assert q == [1.0, 1.75, 2.5, 3.25, 4.0]
    rnd = random.Random(1)
    vals = [round(rnd.expovariate(1), 1) for _ in range(2000)] + [0.3] * 900
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    want = df.agg(F.percentile("x", [.1, .2, .5, .77, .99])).first()[0]
    assert bins.exact_quantiles(df, "x", [.1, .2, .5, .77, .99], blocks).first()["q"] == pytest.approx(want)


def test_equal_count_bins_keep_ties_and_merge_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 2, 3, 4, 5]], "x double")
    got = {r["x"]: r["bin"] for r in bins.equal_count_bin(df, "x", 4).collect()}
    assert got[1.0] == 1 and got[5.0] == max(got.values())
    only = bins.equal_count_bin(df, "x", 2, where=F.col("x") > 1)
    assert {r["x"]: r["bin"] for r in only.collect()} == {1.0: None, 2.0: 1, 3.0: 1, 4.0: 2, 5.0: 2}
    assert {r["x"] for r in bins.impute_median(spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double"), ["x"]).collect()} == {1.0, 2.0, 3.0}


def test_rank_bands(spark):
    df = spark.range(10).withColumn("y", -F.col("id"))
    out = bins.assign_by_rank(df, ["id"], [F.col("y")], [(2, .4), (5, .3)], F.lit(.0), "d")
    got = {r["id"]: r["d"] for r in out.collect()}
    assert [got[i] for i in range(9, 3, -1)] == [.4, .4, .3, .3, .3, .0]


def test_joined_text_in_source_order(spark):
    df = spark.createDataFrame([(1, "k", "b"), (2, "k", None), (3, "k", "a"), (9, "k", "c"), (4, "j", None)], "p bigint, k string, t string")
    got = rows(groups.join_text(df, ["k"], {"t": "o"}, " | ", "p", block_rows=3))
    assert got == [("j", None), ("k", "b | a | c")]


def test_joined_text_is_whole(spark):
    data = [(i, "k", str(i % 7)) for i in range(500)] + [(1, "j", "abc")]
    df = spark.createDataFrame(data, "p bigint, k string, t string")
    got = dict(map(tuple, groups.collapse(df, ["k"], "p", " | ", {"t": "o"}, block_rows=37, fan=3).collect()))
    full = " | ".join(str(i % 7) for i in range(500))
    assert got == {"k": full, "j": "abc"}


def test_group_total_keeps_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 0)], "k string, v int")
    assert rows(groups.share_of(df, "v", "k", "s")) == rows(spark.createDataFrame(
        [(None, 1, .25), (None, 3, .75), ("a", 0, None)], "k string, v int, s double"))


def test_ranges_and_regions(spark):
    df = spark.createDataFrame([(3, 6), (5, 5), (2, 1)], "a int, b int")
    assert [r["n"] for r in reshape.explode_range(df, "a", "b", "n").collect()] == [3, 4, 5, 6, 5, 2, 1]
    w = spark.createDataFrame([("p", 1, None)], "po string, qty_ca int, qty_uk int")
    assert rows(reshape.unpivot_regions(w, ["po"], {"qty_ca": "CA", "qty_uk": "UK"})) == [("p", "CA", 1)]
    t = spark.createDataFrame([("A / B",), (None,)], "c string")
    assert rows(reshape.split_rows(t, "c", "/")) == [("A",), ("B",), (None,)]


def test_hot_key_is_pruned_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = keys.first_per_key(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_small_table_verbs(spark):
    df = spark.createDataFrame([("B-A-2", None, 1), ("A-A-9", 2, None), ("A-A-10", 1, 3)], "sku string, a int, b int")
    assert reshape.rename_all(df, lambda c: c.upper()).columns == ["SKU", "A", "B"]
    assert [r["a"] for r in reshape.sort_r(df, ["-a"]).collect()] == [2, 1, None]
    assert [r["a"] for r in reshape.sort_r(df, ["a"]).collect()] == [1, 2, None]
    assert [r["sku"] for r in reshape.sort_sku(df, "sku").collect()] == ["A-A-10", "A-A-9", "B-A-2"]
    out = reshape.across(reshape.with_constants(df, {"k": "x"}), ["a", "b"], lambda c: F.coalesce(c, F.lit(0)))
    assert rows(out.select("k", "a", "b")) == [("x", 0, 1), ("x", 1, 3), ("x", 2, 0)]
    assert rows(keys.append_rows(df.select("sku", "a"), [("z", 5)]).filter("sku = 'z'")) == [("z", 5)]


def test_a_key_listed_twice_is_an_error_not_a_second_row(spark):
    """Also where no column of the dimension is asked for, and with several keys; null keys may repeat."""
    df = spark.createDataFrame([("A", 1), ("B", 1), (None, 1)], "k string, j int")
    good = spark.createDataFrame([("A", 1, "x"), (None, 1, "y"), (None, 1, "z"), ("A", 2, "w")], "k string, j int, v string")
    assert rows(lk.lookup(df, good, ["k", "j"], ["v"], unique=True)) == [("A", 1, "x"), ("B", 1, None), (None, 1, None)]
    bad = good.union(spark.createDataFrame([("A", 1, "again")], good.schema))
    for out in (lk.lookup(df, bad, ["k", "j"], ["v"], unique=True), lk.lookup(df, bad, ["k", "j"], {}, unique=True, flag="hit"),
                lk.lookup(df, bad, "k", {}, unique=True, flag="hit").select("j")):
        with pytest.raises(Exception, match="is not unique"):
            out.collect()
    assert rows(lk.lookup(df, bad, ["k", "j"], ["v"], order="v"))[0] == ("A", 1, "again")


def test_checked_lookup_reads_its_dimension_once(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "d"))
    out = lk.lookup(spark.range(10).select(F.col("id").alias("k")), spark.read.parquet(str(tmp_path / "d")), "k", ["v"], unique=True)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


PATTERNS = [r"^AB-", r"abc|def", r"a.c", r"x{0,2}yzw", r"q*uvw+t", r"[a-c]def", r"\d{3}-9", r"(abc)?def", r"(?i)ABC", r"zz$", r"\.com", r"a\|b", r"foo|", r"\x41BC", r"abcd", r"", r"ab+c+d", r"[^a]+bcd", r"s?hop", r"\Qa|b\E"]


def test_rule_index_equals_trying_every_rule(spark):
    rnd = random.Random(9)
    parts = ["AB-", "abc", "def", "a|b", "yzw", "uvwt", "123-9", ".com", "ABC", "zz", "bcd", "hop", "ab", "", "shop", "abbccd"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 3))) for _ in range(300)] + [None, "zz"]
    order = list(range(len(PATTERNS)))
    rnd.shuffle(order)
    table = list(zip(order, PATTERNS)) + [(None, "AB"), (99, None)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    r = spark.createDataFrame(table[:-2] + table[-1:], "pos int, item string")
    got = {x.t: x.pos2 for x in rules.regex_lookup(df, r.withColumn("pos2", F.col("pos")), "t", "item", "pos", ["pos2"]).collect()}
    pairs = df.distinct().crossJoin(r).filter(F.regexp_like("t", F.col("item"))).groupBy("t").agg(F.min("pos").alias("p"))
    want = {x.t: x.p for x in pairs.collect()}
    assert got == {t: want.get(t) for t in texts}


def test_literals_are_required(spark):
    df = spark.createDataFrame([(p,) for p in PATTERNS], "p string")
    got = {r.p: r.l for r in df.select("p", rules.literals(F.col("p")).alias("l")).collect()}
    assert got[r"^AB-"] == ["AB-"] and got["abc|def"] == ["abc", "def"] and got["ab+c+d"] is None and got[r"[a-c]def"] == ["def"] and got[r"q*uvw+t"] == ["uvw"]
    assert all(got[p] is None for p in (r"(abc)?def", "(?i)ABC", "foo|", "", r"\x41BC", r"a\|b", r"\Qa|b\E"))


def test_many_rules_are_never_one_value(spark):
    r = spark.range(50_000).select(F.concat(F.lit("^K"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("-")).alias("item"), F.col("id").alias("pos"))
    df = spark.range(0, 2_000).select(F.concat(F.lit("K"), F.lpad((F.col("id") * 31 % 60_000).cast("string"), 6, "0"), F.lit("-X")).alias("t"), (F.col("id") * 31 % 60_000).alias("n"))
    out = rules.regex_lookup(df, r.withColumn("v", F.col("pos")), "t", "item", "pos", ["v"])
    assert out.filter("(n < 50000 AND v <> n) OR (n < 50000 AND v IS NULL) OR (n >= 50000 AND v IS NOT NULL)").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "scalar-subquery" not in plan


def one_scan(df):
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return plan.count("FileScan")


def test_scans_and_quantiles_read_their_input_once(spark, tmp_path):
    spark.range(5000).select("id", (F.col("id") % 5).alias("d"), F.when(F.col("id") % 7 > 2, F.col("id") % 11).alias("v"), F.lit("more").alias("x")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert one_scan(scan.run_id(df, "v", "id", ["d"], block_rows=100)) == 1
    assert one_scan(scan.fill_down(df, ["v"], "id", block_rows=100)) == 1
    assert one_scan(bins.column_quantiles(df, ["v", "id"], [.1, .5])) == 1


def test_quantiles_of_many_columns_and_of_nothing(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.expovariate(1) * 10 ** rnd.randint(-3, 6), rnd.choice([None, 1.0, 2.0, 2.0]), None) for _ in range(3000)], "a double, b double, c double")
    probs = [0, .01, .25, 1 / 3, .5, .999, 1]
    got = {r.c: r.q for r in bins.column_quantiles(df, ["a", "b", "c"], probs, blocks=16).collect()}
    for i, c in enumerate("ab"):
        assert got[i] == pytest.approx(df.agg(F.percentile(c, probs)).first()[0])
    assert set(got) == {0, 1} and bins.exact_quantiles(df, "c", [.5]).first()["q"] == [None]
    assert bins.impute_median(df, ["b", "c"]).filter("b IS NULL").count() == 0


def test_rank_bands_sort_missing_values_and_join_nothing(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3.0, None, 5.0, 5.0, 1.0, None])], "id int, y double")
    out = bins.assign_by_rank(df, ["id"], ["-y"], [(2, "a"), (4, "b")], F.lit("c"), "d")
    assert {r.id: r.d for r in out.collect()} == {2: "a", 3: "a", 0: "b", 4: "b", 1: "c", 5: "c"}
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_shared_frames_are_dropped_with_their_owner(spark):
    from retailflow.session import SharedFrames
    with SharedFrames(spark) as shared:
        kept = shared.keep(spark.range(10), "numbers")
        assert kept.count() == 10
        names = [t.name for t in spark.catalog.listTables() if t.name.startswith("shared_numbers")]
        assert len(names) == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("shared_numbers")]
