"""Dataframe operators on toy tables, with pandas semantics worked out by hand or by pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablecraft.operators import aggregate, features, joins, missing, ordered, profile, reshape, select, setops
from tablecraft.sources import tables


@pytest.fixture(scope="module")
def staff(spark):
    return (spark.createDataFrame([("Bob", "Accounting"), ("Jake", "Engineering"), ("Lisa", "Engineering"), ("Sue", "HR")], "employee string, team string"),
            spark.createDataFrame([("Lisa", 2004), ("Bob", 2008), ("Jake", 2012), ("Sue", 2014)], "employee string, hired int"),
            spark.createDataFrame([("Accounting", "math"), ("Accounting", "spreadsheets"), ("Engineering", "coding"),
                                   ("Engineering", "linux"), ("HR", "spreadsheets"), ("HR", "organization")], "team string, skill string"))


def test_natural_join_uses_all_shared_columns(staff, rows):
    a, b, c = staff
    assert joins.join_natural(a, b).count() == 4
    assert joins.join_natural(a, c).count() == 8
    with pytest.raises(ValueError):
        joins.join_natural(b, c)


def test_null_safe_join_matches_missing_keys(spark, rows):
    a = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    b = spark.createDataFrame([(None, "c"), (2, "d")], "k int, y string")
    assert rows(joins.join_null_safe(a, b, ["k"])) == [(None, "b", "c")]
    assert len(rows(joins.join_null_safe(a, b, ["k"], "full_outer"))) == 3


def test_suffixes(spark):
    a = spark.createDataFrame([("Bob", 1)], "name string, rank int")
    assert joins.join_suffixes(a, a, ["name"], suffixes=("_l", "_r")).columns == ["name", "rank_l", "rank_r"]


def test_alignment_and_fill(spark, rows):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("w", None)], "k string, v double")
    b = spark.createDataFrame([("y", 10.0), ("z", 20.0), ("w", None)], "k string, v double")
    plain = joins.align_binary(a, b, ["k"], "v", "v", lambda x, y: x + y, "s")
    assert rows(plain) == sorted([("x", None), ("y", 12.0), ("z", None), ("w", None)], key=repr)
    filled = joins.align_binary(a, b, ["k"], "v", "v", lambda x, y: x + y, "s", fill=0)
    assert rows(filled) == sorted([("x", 1.0), ("y", 12.0), ("z", 20.0), ("w", None)], key=repr)


def test_subtract_row_gives_missing_for_absent_columns(spark, rows):
    df = spark.createDataFrame([(1, 3.0, 8.0), (2, 2.0, 4.0)], "id int, q double, s double")
    half = df.filter("id = 1").select("q")
    assert rows(joins.subtract_row(df, half, ["q", "s"])) == [(1, 0.0, None), (2, -1.0, None)]


def test_pair_equality_counts_and_ignores_missing(spark, rows):
    a = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    b = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(joins.pair_equality(a, b, "k"), "id", "matches") == [(1, 2), (2, 0), (3, 0)]


def test_unions(spark, rows):
    a = spark.createDataFrame([("a1", "b1")], "A string, B string")
    b = spark.createDataFrame([("b3", "c3")], "B string, C string")
    assert setops.union_common_columns(a, b).columns == ["B"]
    assert rows(setops.union_left_columns(a, b)) == [("a1", "b1"), (None, "b3")]
    assert rows(setops.union_tagged({"x": a, "y": a}), "src") == [("x",), ("y",)]
    assert rows(setops.union_reindexed([a, a], ["A"]), "row_index") == [(0,), (1,)]
    with pytest.raises(ValueError):
        setops.assert_unique_keys(a.union(a), ["A"])


def test_key_set_algebra(spark, rows):
    a = spark.createDataFrame([(x,) for x in (1, 3, 5, 7, 9)], "k int")
    b = spark.createDataFrame([(x,) for x in (2, 3, 5, 7, 11)], "k int")
    assert rows(setops.keys_symdiff(a, b)) == sorted([(1,), (2,), (9,), (11,)], key=repr)


def test_repeat_rows_splits_big_counts(spark, monkeypatch):
    monkeypatch.setattr(setops, "COPIES_PER_ROW", 7)
    df = spark.createDataFrame([("a", 1), ("b", 50), ("c", 14)], "k string, n int")
    assert {r.k: r["count"] for r in setops.repeat_rows(df, "n").groupBy("k").count().collect()} == {"a": 1, "b": 50, "c": 14}


def test_duplicates_are_all_but_the_first(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (1, None)], "a int, b string")
    assert [tuple(r) for r in setops.duplicate_rows(df).collect()] == [(1, None), (1, None)]


def test_positions_and_argsort(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([2, 1, 4, 3, 5])], "i int, v int")
    order = select.argsort_rows(df, ["i"], ["v"]).orderBy("rank").collect()
    assert [r.position for r in order] == [1, 0, 3, 2, 4]
    assert [r[0] for r in rows(select.position_range(df, ["i"], 1, 5, 2), "v")] == [1, 3]
    back = select.position_range(df, ["i"], 0, 2, reverse=True)
    assert [r[0] for r in rows(back, "i")] == [3, 4]


def test_transpose_is_refused_for_large_tables(spark):
    with pytest.raises(ValueError):
        select.transpose_small(spark.range(501), "id")


def test_from_product_and_sequences(spark, rows):
    a, b = (spark.createDataFrame([(x,) for x in v], s) for v, s in (("ab", "a string"), ([2000, 2010, 2000], "y int")))
    assert rows(tables.from_product([a, b])) == [("a", 2000), ("a", 2010), ("b", 2000), ("b", 2010)]
    assert [r[0] for r in tables.even_spaced(spark, 0, 1, 5).orderBy("x").collect()] == list(np.linspace(0, 1, 5))


def test_csv_keeps_texts_and_turns_nan_into_null(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "quoted", text\nwith lines', float("nan")), (2, None, 1.5)], "i int, s string, x double")
    tables.sink_csv(df, str(tmp_path / "out"))
    assert rows(tables.scan_csv(spark, str(tmp_path / "out"), df.schema, multiline=True)) == [
        (1, 'a "quoted", text\nwith lines', None), (2, None, 1.5)]


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame([("A", 0, 5), ("B", 1, 0), ("C", 2, 3), ("A", 3, 3), ("B", 4, 7), ("C", 5, 9), (None, 6, 1)],
                                 "key string, data1 int, data2 int")


def test_group_filter_transform_apply(keyed, rows):
    kept = aggregate.group_filter(keyed, ["key"], [F.stddev("data2").alias("sd")], "sd > 4")
    assert sorted({r.key for r in kept.collect()}) == ["B", "C"]
    centered = aggregate.group_transform(keyed, ["key"], [F.avg("data1").alias("_m")], {"data1": F.col("data1") - F.col("_m")})
    assert rows(centered, "key", "data1")[0] == ("A", -1.5)
    assert centered.count() == 6
    share = aggregate.group_apply(keyed, ["key"], lambda g: g.assign(data1=g.data1 / g.data2.sum()), "key string, data1 double, data2 int")
    assert rows(share.filter("key = 'B'"), "data1") == [(1 / 7,), (4 / 7,)]
    with pytest.raises(ValueError):
        aggregate.group_apply(keyed, ["key"], lambda g: g, "key string, data1 int, data2 int", limit=1)


def test_mad_mode_counts(spark, keyed, rows):
    assert rows(aggregate.mean_abs_deviation(keyed.filter("key = 'A'"), ["key"], "data2")) == [("A", 1.0)]
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "g int, v string")
    assert rows(aggregate.fill_group_mode(df, ["g"], "v")) == sorted([(1, "b"), (1, "a"), (1, "a"), (2, None)], key=repr)
    assert rows(aggregate.value_counts(df, ["v"], normalize=True)) == [("a", 1, 0.5), ("b", 1, 0.5)]
    assert rows(aggregate.scatter_add(spark.createDataFrame([(2,), (2,), (0,)], "i int"), "i", 4)) == [(0, 1), (1, 0), (2, 2), (3, 0)]


def test_group_by_mapping_drops_unmapped(keyed, rows):
    out = aggregate.group_by_mapping(keyed, "key", {"A": "vowel", "B": "consonant", "C": "consonant"}, "kind", F.sum("data1").alias("s"))
    assert rows(out) == [("consonant", 12), ("vowel", 3)]


def test_pivot_margins_come_from_rows_not_cells(spark):
    df = spark.createDataFrame([("m", "x", 1.0), ("m", "x", 2.0), ("m", "y", 9.0), ("f", "y", 4.0)], "sex string, cls string, v double")
    got = {r.sex: r for r in reshape.pivot_margins(df, "sex", "cls", ["x", "y"], F.avg("v")).collect()}
    assert got["m"]["All"] == 4.0 and got["All"]["All"] == 4.0 and got["All"]["y"] == 6.5 and got["f"]["x"] is None


def test_too_many_pivot_values_are_refused(spark):
    with pytest.raises(ValueError):
        reshape.pivot_values(spark.range(20), "id", limit=10)


def test_missing_rate_rounds_half_to_even(spark, rows):
    df = spark.createDataFrame([(i if i >= 1 else None, i if i >= 3 else None, 1) for i in range(8)], "a int, b int, c int")
    assert rows(missing.missing_rate(df)) == [("a", 1, 12.0), ("b", 3, 38.0)]  # 12.5 and 37.5


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, 2, None), (2, 3, 5, None), (None, 4, 6, None)], "a int, b int, c int, d int")
    assert missing.drop_null_columns(df).columns == ["c"]
    assert missing.drop_null_columns(df, how="all").columns == ["a", "b", "c"]
    assert missing.drop_null_columns(df, thresh=3).columns == ["c"]


def test_row_backfill_and_censored(spark, rows):
    df = spark.createDataFrame([(None, 2, None), (1, None, 3)], "a int, b int, c int")
    assert rows(missing.row_backfill(df, ["a", "b", "c"])) == [(1, 3, 3), (2, 2, None)]


def test_iterative_imputer_recovers_a_linear_relation(spark):
    pdf = pd.DataFrame({"i": range(400)})
    pdf["x"] = np.sin(pdf.i) * 10
    pdf["z"] = np.cos(pdf.i * 1.7) * 5
    pdf["y"] = 3 * pdf.x - 2 * pdf.z + 7
    gappy = pdf.copy()
    gappy.loc[gappy.i % 9 == 0, "y"] = None
    gappy.loc[gappy.i % 11 == 1, "x"] = None
    df = spark.createDataFrame(gappy.astype(object).where(gappy.notna(), None), "i long, x double, z double, y double")
    out = missing.IterativeImputer(["x", "z", "y"]).fit(df).transform(df).toPandas().sort_values("i")
    assert out.isna().sum().sum() == 0
    one_gap = (pdf.i % 9 != 0) | (pdf.i % 11 != 1)  # with both gone, nothing determines them
    assert np.abs(out.y.to_numpy() - pdf.y.to_numpy())[one_gap].max() < 1e-3
    assert np.abs(out.x.to_numpy() - pdf.x.to_numpy())[one_gap].max() < 1e-3


def test_iterative_imputer_with_more_patterns_than_a_driver_should_hold(spark):
    """14 columns with gaps: nearly every row has a pattern of its own. Against regressions on the filled table."""
    draw = np.random.default_rng(6)
    full = draw.normal(size=(700, 3)) @ draw.normal(size=(3, 14)) + draw.normal(0, 0.3, (700, 14))
    gaps = draw.random((700, 14)) < np.linspace(0.1, 0.5, 14)
    names = [f"c{j:02d}" for j in range(14)]
    data = [(i, *[None if g else float(v) for v, g in zip(r, h)]) for i, (r, h) in enumerate(zip(full, gaps))]
    df = spark.createDataFrame(data, "i long, " + ", ".join(f"{n} double" for n in names))
    assert len({tuple(g) for g in gaps}) > 500
    got = missing.IterativeImputer(names, rounds=2).fit(df).transform(df).orderBy("i").toPandas()[names].to_numpy()
    now = np.where(gaps, np.nanmean(np.where(gaps, np.nan, full), axis=0), full)
    for _ in range(2):
        for j in sorted(range(14), key=lambda j: (gaps[:, j].sum(), names[j])):
            x = np.c_[np.ones(700), np.delete(now, j, axis=1)]
            theta = np.linalg.lstsq(x[~gaps[:, j]], full[~gaps[:, j], j], rcond=None)[0]
            now[gaps[:, j], j] = x[gaps[:, j]] @ theta
    assert np.allclose(got, now, atol=1e-6)


def test_iterative_imputer_of_empty_tables_and_columns(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert missing.IterativeImputer(["a", "b"]).fit(none).transform(none).count() == 0
    lost = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    got = missing.IterativeImputer(["a", "b"]).fit(lost).transform(lost).collect()
    assert [(r.a, r.b) for r in got] == [(1.0, None), (2.0, None), (3.0, None)]


def test_knn_imputation_against_brute_force(spark):
    draw = np.random.default_rng(3)
    pdf = pd.DataFrame(draw.normal(size=(60, 3)), columns=list("abc"))
    full = pdf.to_numpy()
    gappy = full.copy()
    gappy[::7, 2] = np.nan
    gappy[1::9, 0] = np.nan
    gappy[5] = np.nan
    data = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(gappy)]
    got = {r[0]: r[1:] for r in missing.impute_knn(spark.createDataFrame(data, "id long, a double, b double, c double"),
                                                   "id", ["a", "b", "c"], 4).collect()}
    donors = [i for i in range(60) if not np.isnan(gappy[i]).any()]
    assert len(got) == 60 and got[5] == (None, None, None)
    for i, r in enumerate(gappy):
        have = ~np.isnan(r)
        if have.all() or not have.any():
            continue
        near = sorted(donors, key=lambda d: (round(np.linalg.norm(gappy[d][have] - r[have]), 9), d))[:4]
        assert np.allclose(got[i], np.where(have, r, gappy[near].mean(axis=0)))


def test_knn_imputation_with_many_patterns_and_cells(spark, monkeypatch):
    from tablecraft.operators import dense
    monkeypatch.setattr(dense.knn_partial, "__defaults__", (20,))
    draw = np.random.default_rng(5)
    full = np.round(draw.normal(size=(400, 5)) * [1, 10, 0.1, 3, 1], 1)
    gappy = np.where((draw.random((400, 5)) < 0.3) & (np.arange(400) % 3 > 0)[:, None], np.nan, full)
    data = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(gappy)]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, d double, e double")
    got = {r[0]: r[1:] for r in missing.impute_knn(df, "id", list("abcde"), 3).collect()}
    donors = np.flatnonzero(~np.isnan(gappy).any(axis=1))
    assert len({tuple(np.isnan(r)) for r in gappy}) > 20
    for i, r in enumerate(gappy):
        have = ~np.isnan(r)
        if have.any() and not have.all():
            near = sorted(donors, key=lambda d: (round(np.linalg.norm(gappy[d][have] - r[have]), 9), d))[:3]
            assert np.allclose(got[i], np.where(have, r, gappy[near].mean(axis=0)))


def test_knn_imputation_without_complete_rows(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 2.0)], "id long, a double, b double")
    assert sorted(tuple(r) for r in missing.impute_knn(df, "id", ["a", "b"]).collect()) == [(1, 1.0, None), (2, None, 2.0)]


def test_sparse_indicators_for_any_number_of_levels(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 12_345).cast("string").alias("s")).union(spark.createDataFrame([(-1, None)], "id long, s string"))
    rows, levels = features.one_hot_sparse(df, "s")
    order = sorted({str(i % 12_345) for i in range(30_000)})
    assert [r.level for r in levels.orderBy("position").collect()] == order
    got = {r.id: r.onehot for r in rows.where("id < 5 or id = 20000").collect()}
    assert got[-1] == (12_345, [], [])
    assert all(v == (12_345, [order.index(str(i % 12_345))], [1.0]) for i, v in got.items() if i >= 0)


def test_rank_and_describe(spark):
    scores = spark.createDataFrame([("a", 3.0), ("b", 5.0), ("c", 5.0), ("d", 1.0)], "m string, s double")
    assert {r.m: r["rank"] for r in ordered.rank_results(scores, "s").collect()} == {"a": 3, "b": 1, "c": 1, "d": 4}
    gappy = scores.union(spark.createDataFrame([("e", None), ("f", None)], "m string, s double"))
    assert {r.m: r["rank"] for r in ordered.rank_results(gappy, "s").collect()} == {"a": 3, "b": 1, "c": 1, "d": 4, "e": 5, "f": 5}
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "n int, s string")
    got = {r.column: r for r in profile.describe_table(df).collect()}
    assert (got["n"].missing, got["n"]["mean"], got["n"].duplicates, got["s"].rows) == (1, 1.0, 1, 3)
    assert [r.dtype for r in profile.describe_table(df.select("s")).collect()] == ["string"]


def test_correlation_p_values():
    # two-sided t test, values from published tables
    assert profile.correlation_p_value(0.632, 10) == pytest.approx(0.05, abs=2e-4)
    assert profile.correlation_p_value(-0.765, 10) == pytest.approx(0.01, abs=2e-4)
    assert profile.correlation_p_value(0.0, 50) == 1.0
    assert profile.correlation_p_value(1.0, 5) == 0.0


def test_corr_vs_target_has_p_value(spark):
    df = spark.createDataFrame([(float(i), float(i % 7), float(i * 2 + i % 3)) for i in range(50)], "a double, b double, y double")
    got = profile.corr_vs_target(df, ["a", "b"], "y").collect()
    assert [r.column for r in got] == ["a", "b"] and got[0].p_value < 1e-10 < got[1].p_value


def test_encoders(spark, rows):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "c"), (4, "a")], "i int, s string")
    assert rows(features.label_encode(df, "s", "n"), "i", "n") == [(0, 1), (1, 0), (2, None), (3, 2), (4, 0)]
    assert features.binary_encode(df, "s", "bit").columns == ["i", "s", "bit_0", "bit_1"]
    assert rows(features.rare_to_other(df, "s", 2), "i", "s") == [(0, "Other"), (1, "a"), (2, None), (3, "Other"), (4, "a")]
    unseen = spark.createDataFrame([("z",), ("a",)], "s string")
    assert rows(features.rare_to_other(unseen, "s", 2, known=df)) == [("Other",), ("a",)]
    assert features.one_hot(df, ["s"], [df, unseen]).columns == ["i", "s_a", "s_b", "s_c", "s_z"]


def test_target_encoding_never_sees_its_own_fold(spark):
    df = spark.createDataFrame([("x", 0, 1.0), ("x", 1, 3.0), ("y", 0, 10.0)], "c string, fold int, y double")
    got = {(r.c, r.fold): r.e for r in features.target_encode_oof(df, "c", "y", "fold", "e").collect()}
    assert got == {("x", 0): 3.0, ("x", 1): 1.0, ("y", 0): 3.0}


def test_cut_is_right_closed(spark, rows):
    df = spark.createDataFrame([(0,), (1,), (18,), (19,), (80,), (81,)], "age int")
    assert [r[1] for r in df.select("age", features.cut(F.col("age"), [0, 18, 80])).collect()] == [
        None, "(0, 18]", "(0, 18]", "(18, 80]", "(18, 80]", None]


def test_boxcox_fit_finds_the_power(spark):
    draw = np.random.default_rng(0).normal(5, 0.5, 4000)
    df = spark.createDataFrame([(float(x**2),) for x in draw], "x double")  # square root makes it normal
    assert features.boxcox_fit(df, ["x"], shift=0.0)["x"] == pytest.approx(0.5, abs=0.15)


def test_boxcox_fit_finds_powers_beyond_the_first_grid(spark):
    draw = np.random.default_rng(0).normal(5, 0.5, 4000)
    df = spark.createDataFrame([(float(x ** 0.125), float(x ** -0.2), 3.0) for x in draw], "x double, y double, z double")
    found = features.boxcox_fit(df, ["x", "y", "z"], shift=0.0)
    assert found["x"] == pytest.approx(8, abs=2) and found["y"] == pytest.approx(-5, abs=1.5) and found["z"] == 1.0


def test_pca_first_axis_follows_the_spread(spark):
    draw = np.random.default_rng(1).normal(size=300)
    df = spark.createDataFrame([(i, float(a), float(2 * a + 0.01 * np.sin(i))) for i, a in enumerate(draw)], "i int, a double, b double")
    got = features.pca_project(df, ["a", "b"], 2, ["i"]).agg(F.var_pop("pc1"), F.var_pop("pc2")).first()
    assert got[0] == pytest.approx(2.0, abs=1e-3) and got[1] < 1e-3


def test_small_groups_share_batches_and_groups_may_span_them(spark):
    """Groups of one to many rows, batches of three rows: every group is seen whole and once, in far fewer calls of Arrow than groups."""
    import pandas as pd

    data = [(k, f"s{k % 2}", i) for k in range(40) for i in range(1 + k % 9)]
    df = spark.createDataFrame([*data, (None, "s0", 5)], "k long, s string, v long")

    def stats(group: pd.DataFrame) -> pd.DataFrame:
        assert list(group.index) == list(range(len(group)))
        return pd.DataFrame({"s": group["s"].iloc[:1], "k": group["k"].iloc[:1], "n": [len(group)], "total": [group["v"].sum()]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = aggregate.group_apply(df, ["k", "s"], stats, "k long, s string, n long, total long")
        assert "MapInPandas" in out._jdf.queryExecution().toString()
        got = sorted(tuple(r) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == [(k, f"s{k % 2}", 1 + k % 9, sum(range(1 + k % 9))) for k in range(40)]
