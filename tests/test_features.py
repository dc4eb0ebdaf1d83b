import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.operators import busy_windows, features, ordering, windows
from tallyforge.operators.busy_windows import WaveletMatrix
from tallyforge.operators.ordering import category_codes, exact_quantiles, running_totals, split_at
from tallyforge.operators.windows import prior_window


def hand_case(spark):
    items = [("SKU1001", "x", 1, 5.0)]
    rows = [
        (rid, "U1", "ST001", dt.datetime(2026, 6, 1, 10 + i), "USD", "card", "v4.0", 0.9, items, 5.0, 0.41, 5.41)
        for i, rid in enumerate("abc")
    ]
    return spark.createDataFrame(rows, S.RECEIPT)


@pytest.mark.parametrize("busy_rows", [100, 1])
def test_behaviour_never_sees_the_future(spark, busy_rows):
    rows = features.build_features(hand_case(spark), busy_rows=busy_rows).orderBy("receipt_id").collect()
    assert [r["user_receipts_prior_24h"] for r in rows] == [0.0, 1.0, 2.0]
    assert [r["same_total_prior_24h"] for r in rows] == [0.0, 1.0, 2.0]
    assert [r["user_amount_ratio_vs_prior_median"] for r in rows] == [1.0, 1.0, 1.0]


def test_unknown_user_and_empty_basket(spark):
    df = hand_case(spark).withColumns(
        {"user_id": F.lit(None).cast("string"), "items": F.filter("items", lambda _: F.lit(False)), "image_quality": F.lit(None).cast("double")}
    )
    row = features.build_features(df).first()
    assert row["user_receipts_prior_24h"] == 0 and row["user_amount_ratio_vs_prior_median"] == 1
    assert row["n_items"] == 0 and row["max_price_ratio_vs_sku_median"] == 1 and row["image_quality"] == 0.5


def brute(rows, hours):
    out = {}
    for u, ts, v, rid in rows:
        prior = [w for uu, t2, w, r2 in rows if uu == u and ts - hours * 3600 * 10**6 <= t2 and (t2, r2) < (ts, rid)]
        valued = [w for w in prior if w is not None]
        same = 0 if v is None else sum(abs(w - v) <= 0.01 + 1e-5 * abs(v) for w in valued)
        out[rid] = (len(prior), statistics.median(valued) if valued else None, same)
    return out


def test_all_limits_agree_at_the_border_and_on_missing_values(spark):
    """Totals whose distance is the slack itself, where rounding decides, and rows without a value."""
    rng = random.Random(8)
    day = 24 * 3600 * 10**6
    rows = []
    for i, v in enumerate([4000.0, 5000.0, 8000.0, 9000.0, 10000.0, 0.5, 123.45, 1e7, -4000.0, 0.0]):
        slack = 0.01 + 1e-5 * abs(v)
        for j, w in enumerate([v, v + slack, v - slack, round(v + slack, 2), round(v - slack, 2), v + 1.5 * slack, None]):
            rows.append((f"u{i % 2}", rng.randrange(0, 3 * day, day // 48), w, i * 100 + j))
    rows += [("u0", -day - 5, 7.0, 9001), ("u0", -day - 5, 7.0, 9002), ("u0", -5, 7.0, 9003), (None, 3, 1.0, 9004)]
    df = spark.createDataFrame(rows, "u string, ts bigint, v double, rid bigint")
    want = brute([r for r in rows if r[0]], 24)
    for limit in (0, 20, 2000, None):
        got = {r["rid"]: (r["n_prior"], r["median_prior"], r["n_same"]) for r in prior_window(df, "u", "ts", "v", "rid", busy_rows=limit).collect()}
        assert got.keys() == want.keys()
        for k, (n, median, same) in want.items():
            assert got[k] == (n, None if median is None else pytest.approx(median, rel=1e-12), same), (limit, k)


def test_sums_take_any_size_and_round_nothing_first(spark):
    from tallyforge.functions.exact import exact_avg, exact_sum

    small = spark.createDataFrame([(0.00004,)] * 5 + [(None,)], "v double")
    assert small.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()[:] == (0.0002, 0.00004)
    large = spark.range(2000).select(F.lit(9e11).alias("v"))
    assert large.repartition(7).agg(exact_sum(F.col("v"))).first()[0] == 1.8e15
    mixed = spark.createDataFrame([(0.1,)] * 10 + [(3e12,)], "v double")
    assert {mixed.repartition(n).agg(exact_sum(F.col("v"))).first()[0] for n in (1, 3, 8)} == {3e12 + 1}
    assert small.limit(0).agg(exact_sum(F.col("v"))).first()[0] is None


def test_repeated_ids_do_not_multiply(spark):
    three = hand_case(spark)
    rows = three.unionByName(three.where("receipt_id = 'b'")).unionByName(three.where("receipt_id = 'b'"))
    got = features.build_features(rows).collect()
    assert sorted(r["receipt_id"] for r in got) == ["a", "b", "b", "b", "c"]
    assert sorted(r["user_receipts_prior_24h"] for r in got) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("descending", [False, True])
def test_split_keeps_rows_without_a_value_and_puts_them_last(spark, descending):
    df = spark.createDataFrame([(None, "b"), (3, "c"), (None, "a"), (1, "d")], "ts int, id string")
    order = (["c", "d"] if descending else ["d", "c"]) + ["a", "b"]
    for k in range(5):
        first, rest = split_at(df, "ts", "id", k, descending=descending)
        assert {r["id"] for r in first.collect()} == set(order[:k]) and {r["id"] for r in rest.collect()} == set(order[k:])


@pytest.mark.parametrize("busy_rows", [10**6, 20])
def test_prior_window_against_brute_force_with_one_dominant_user(spark, busy_rows):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        user = "hot" if i % 3 else f"u{i % 5}"
        ts = rng.randrange(0, 5 * 24) * 3600 * 10**6  # many equal stamps
        rows.append((user, ts, rng.choice([5.0, 5.01, 5.03, 7.5, 1000.0, 1000.015, rng.random() * 9]), i))
    df = spark.createDataFrame(rows, "u string, ts bigint, v double, rid bigint")
    got = {r["rid"]: (r["n_prior"], r["median_prior"], r["n_same"]) for r in prior_window(df, "u", "ts", "v", "rid", busy_rows=busy_rows).collect()}
    want = brute(rows, 24)
    assert set(got) == set(want)
    for rid, (n, med, same) in want.items():
        assert got[rid][0] == n and got[rid][2] == same
        assert got[rid][1] == (None if med is None else pytest.approx(med, rel=1e-12))


def test_running_totals_and_quantiles_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{i % 4}", float(rng.randrange(50)) if i % 2 else 7.0) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, v double")
    q = {r["k"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, ["k"], "v", [0.0, 0.3, 0.5, 1.0]).collect()}
    for k in {k for k, _ in rows}:
        vs = sorted(v for kk, v in rows if kk == k)
        assert q[k][0] == len(vs)
        for p, got in zip([0.0, 0.3, 0.5, 1.0], q[k][1], strict=True):
            at = (len(vs) - 1) * p
            lo, hi = vs[int(at)], vs[min(int(at) + 1, len(vs) - 1)]
            assert got == pytest.approx(lo + (hi - lo) * (at - int(at)))
    total = running_totals(df, [], "v", {"n": F.lit(1)}).orderBy("v").collect()
    seen = 0
    for r in total:
        assert r["n_before"] == seen and r["n_all"] == len(rows)
        seen += r["n"]


def test_split_settles_ties_by_id(spark):
    df = spark.createDataFrame([(1, f"r{i:02d}") for i in range(20)] + [(0, "z"), (2, "a")], "ts int, id string")
    first, rest = split_at(df, "ts", "id", 11)
    assert {r["id"] for r in first.collect()} == {"z", *[f"r{i:02d}" for i in range(10)]}
    assert first.count() + rest.count() == 22
    top, _ = split_at(df, "ts", "id", 3, descending=True)
    assert {r["id"] for r in top.collect()} == {"a", "r00", "r01"}


def test_category_codes_follow_sorted_values(spark):
    df = spark.createDataFrame([("b", "y"), ("a", "y"), (None, "x"), ("c", "x")], "p string, s string")
    got = {(r["name"], r["value"]): r["code"] for r in category_codes(df, ["p", "s"]).collect()}
    assert got == {("p", "a"): 0, ("p", "b"): 1, ("p", "c"): 2, ("s", "x"): 0, ("s", "y"): 1}


def test_features_are_finite_and_split_is_chronological(spark, tables):
    from tallyforge.catalog.analytics import stored_nested
    from tallyforge.session import settle

    f = settle(features.build_features(stored_nested(tables)))
    assert set(S.FEATURE_COLUMNS) <= set(f.columns)
    bad = [F.count_if(F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))).alias(c) for c in S.FEATURE_COLUMNS]
    assert sum(f.agg(*bad).first()) == 0
    early, late = features.time_split(f)
    assert early.agg(F.max("submitted_at")).first()[0] <= late.agg(F.min("submitted_at")).first()[0]
    assert early.count() + late.count() == f.count() and early.count() == int(f.count() * 0.75)
    med = {r["k"]: r["m"] for r in f.groupBy((F.col("anomaly_type") == "arithmetic_mismatch").alias("k")).agg(F.median("arithmetic_residual_rel").alias("m")).collect()}
    assert med[True] > (med.get(None) or 0)


@pytest.mark.parametrize("descending", [False, True])
def test_split_at_nothing_all_and_beyond_the_end(spark, descending):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", None)], "id string, ts int")
    for k, want in ((0, 0), (3, 3), (4, 4), (5, 4), (10, 4), (-1, 0)):
        first, rest = split_at(df, "ts", "id", k, descending=descending)
        assert (first.count(), rest.count()) == (want, 4 - want)
    first, rest = split_at(df.limit(0), "ts", "id", 2, descending=descending)
    assert first.count() == rest.count() == 0


@pytest.mark.parametrize("one_sort", [ordering.ONE_SORT, 10])
def test_bracketed_quantiles_against_numpy(spark, monkeypatch, one_sort):
    """Keys above and below the limit, ties, infinities, null keys; only values near a quantile are ranked."""
    monkeypatch.setattr(ordering, "ONE_SORT", one_sort)
    rng = np.random.default_rng(5)
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    held = {
        "normal": rng.standard_normal(60_000),
        "ties": rng.integers(0, 4, 50_000).astype(float),
        None: np.concatenate([rng.exponential(1, 30_000), [np.inf, -np.inf]]),
        "mostly one": np.concatenate([np.full(49_000, 2.5), rng.standard_normal(3_000)]),
        "small": rng.standard_normal(999),
        "one": np.array([7.0]),
    }
    import pandas as pd

    pdf = pd.concat([pd.DataFrame({"k": [k] * len(v), "v": v}) for k, v in held.items()])
    df = spark.createDataFrame(pdf, "k string, v double").repartition(5).unionByName(spark.createDataFrame([("small", None)], "k string, v double"))
    got = {r["k"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, ["k"], "v", points).collect()}
    assert set(got) == set(held)
    for k, v in held.items():
        inner = points if k is not None else points[1:-1]
        assert got[k][0] == len(v)
        assert [q for p, q in zip(points, got[k][1]) if p in inner] == pytest.approx(list(np.quantile(v, inner)), rel=1e-12, abs=1e-12), k
    assert exact_quantiles(df.where("k = 'normal'"), [], "v", [0.5]).first()["quantiles"] == pytest.approx([np.median(held["normal"])])
    kept = ordering._bracketed(df.where("k = 'normal'").withColumnRenamed("v", "_v"), ["k"], points).select("k", "_o").distinct().count()
    assert kept < 0.05 * 60_000
    assert exact_quantiles(df.limit(0), ["k"], "v", points).count() == 0


def test_wavelet_matrix_against_lists():
    rng = np.random.default_rng(8)
    for n in (1, 2, 7, 64, 300):
        ranks = rng.permutation(n)
        matrix = WaveletMatrix(ranks)
        l = rng.integers(0, n + 1, 200)
        r = np.maximum(l, rng.integers(0, n + 1, 200))
        bound = rng.integers(0, n + 3, 200)
        assert matrix.below(l, r, bound).tolist() == [int((ranks[a:b] < c).sum()) for a, b, c in zip(l, r, bound)]
        some = np.flatnonzero(r > l)
        k = rng.integers(0, (r - l)[some])
        assert matrix.select(l[some], r[some], k).tolist() == [int(np.sort(ranks[a:b])[c]) for a, b, c in zip(l[some], r[some], k)]
    assert WaveletMatrix(np.empty(0, int)).below(np.zeros(2, int), np.zeros(2, int), np.arange(2)).tolist() == [0, 0]


@pytest.mark.parametrize("side", [3, 16, 4096])
def test_busy_periods_in_slices_of_any_size(spark, side, monkeypatch):
    """One user with most rows, bursts and lulls, missing and repeated values, against lists."""
    rng = random.Random(side)
    hour, rows, now = 3_600_000_000, [], 0
    for i in range(260):
        now += rng.choice([0, 0, hour // 7, hour, 30 * hour if i % 60 == 59 else hour // 3])
        rows.append((i, rng.choice(["hot", "hot", "hot", "other"]), now, rng.choice([None, 5.0, 5.005, 5.01, rng.uniform(0, 20), round(rng.uniform(0, 20), 1)])))
    df = spark.createDataFrame(rows, "rid long, u string, ts long, v double").repartition(4)
    monkeypatch.setattr(busy_windows, "SIDE", side)
    monkeypatch.setattr(windows, "busy_prior_window", lambda *a: busy_windows.busy_prior_window(*a, side=side))
    got = {r["rid"]: (r["n_prior"], r["median_prior"], r["n_same"]) for r in prior_window(df, "u", "ts", "v", "rid", busy_rows=1).collect()}
    for i, u, ts, v in rows:
        prior = [w for j, o, t, w in rows if o == u and (t, j) < (ts, i) and ts - t <= 24 * hour]
        valued = [w for w in prior if w is not None]
        same = 0 if v is None else sum(abs(w - v) <= 0.01 + 1e-5 * abs(v) for w in valued)
        n, median, close = got[i]
        assert (n, close) == (len(prior), same) and (median is None if not valued else median == pytest.approx(statistics.median(valued), rel=1e-12)), i


@pytest.mark.parametrize("task_rows", [0, 60, 10**6])
def test_busy_periods_in_one_task_and_beyond(spark, task_rows, monkeypatch):
    """A busy period that one task can hold does not go through slices; both ways give what lists give."""
    if task_rows == 10**6:
        monkeypatch.setattr(windows, "busy_prior_window", lambda *a: pytest.fail("a small period went through slices"))
    rng, day, rows = random.Random(5), 24 * 3600 * 10**6, []
    for i in range(260):
        value = rng.choice([None, 5.0, 5.01, 5.03, -4000.0, -4000.05, 0.0, -0.0, rng.random() * 9])
        rows.append((f"u{i % 3 % 2}", rng.randrange(-day, 2 * day, day // 24) + i % 2, value, i))
    rows += [("lone", 3 * day, None, 900), ("lone", 3 * day + 1, 2.0, 901), ("lone", 3 * day + 2, None, 902), ("lone", 3 * day + 3, 2.005, 903)]
    df = spark.createDataFrame(rows, "u string, ts bigint, v double, rid bigint").withColumn("rid", F.struct("rid", "u"))
    found = prior_window(df, "u", "ts", "v", "rid", busy_rows=1, task_rows=task_rows).collect()
    got = {r["rid"]["rid"]: (r["n_prior"], r["median_prior"], r["n_same"]) for r in found}
    want = brute(rows, 24)
    assert len(found) == len(want) and got.keys() == want.keys()
    for k, (n, median, same) in want.items():
        assert got[k] == (n, None if median is None else pytest.approx(median, rel=1e-12), same), k


def test_a_busy_period_without_rows_of_its_own_is_left_out(spark, monkeypatch):
    """The day after a busy one holds all its rows to be seen and none to answer for; no range frame goes over them."""
    seen, plain = [], windows._ordinary
    monkeypatch.setattr(windows, "_ordinary", lambda rows, w: (seen.append(rows.count()), plain(rows, w))[1])
    df = spark.createDataFrame([("u", i, float(i), i) for i in range(30)], "u string, ts bigint, v double, rid bigint")
    got = prior_window(df, "u", "ts", "v", "rid", busy_rows=1).collect()
    assert seen == [0] and sorted(r["n_prior"] for r in got) == list(range(30))


def test_resubmissions_stand_beside_their_receipts(spark):
    """The same rows as receipts and changed copies put together, and one pass over what makes the receipts."""
    from tallyforge.operators import defects

    rows = spark.range(400).selectExpr(
        "concat('R', id) as receipt_id", "timestamp'2025-01-01 00:00:00' + make_dt_interval(0, 0, cast(id as int)) as submitted_at", "cast(id as double) as total",
        "if(id % 5 = 0, 'x', null) as anomaly_type", "case when id % 5 = 0 then 1 when id % 11 = 0 then null else 0 end as is_anomaly",
    )
    rows = rows.unionByName(rows.where("total < 20"))  # ids may repeat
    got = defects.inject_resubmissions(rows, 0.3)
    drawn = defects._with_draws(rows, 42, "r").where("is_anomaly = 0 and _u[0] < 0.3D").selectExpr(
        "concat('R', substring(md5(concat(receipt_id, ':again42')), 1, 12)) as receipt_id",
        "submitted_at + make_dt_interval(0, 0, 0, cast(floor((_u[1] * 89 + 1) / 1440.0D * 86400.0D) as decimal(18,6))) as submitted_at", "total",
        "'duplicate_submission' as anomaly_type", "1 as is_anomaly",
    )
    want = rows.unionByName(drawn)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and drawn.count() > 20
    assert got.dtypes == rows.dtypes
    made = defects.inject_resubmissions(spark.range(9).selectExpr("'R' as receipt_id", "current_timestamp() as submitted_at", "'' as anomaly_type", "0 as is_anomaly"))
    assert "Union" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_features_store_the_receipts_once(spark, tables, monkeypatch):
    from tallyforge.catalog import analytics
    from tallyforge.operators import features
    from tallyforge.session import settle

    stored, kept = [], settle(spark.range(3))
    assert settle(kept) is kept
    for module in (analytics, features):
        monkeypatch.setattr(module, "settle", lambda df: (stored.append(df.columns), settle(df))[1])
    assert analytics.QUERIES["psi_features"](spark, tables.dir).count() == 22
    assert len([c for c in stored if "items" in c]) == 1
