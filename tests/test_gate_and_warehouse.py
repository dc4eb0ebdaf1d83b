import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge import bridge, schemas as S
from tallyforge.catalog.warehouse import raw_sets, tagged
from tallyforge.operators import checks, contract, silver
from tallyforge.operators.marts import store_health
from tallyforge.plans import warehouse
from tallyforge.plans.store_health import daily_store_health, run
from tallyforge.sources.sinks import bronze_views, land


def test_gate_conserves_rows_and_names_reasons(spark, tables):
    flat = bridge.flat_receipts(tables)
    clean, held = contract.split_quarantine(flat, bridge.AS_OF)
    assert held.count() > 0 and clean.count() + held.count() == flat.count()
    assert {r[0] for r in held.select("quarantine_reason").distinct().collect()} <= set(S.QUARANTINE_REASONS)
    assert clean.where((F.col("total") <= 0) | (F.col("currency") != "USD") | (F.size("items") == 0)).isEmpty()
    assert clean.where(F.col("submitted_at") > F.lit(bridge.AS_OF).cast("timestamp")).isEmpty()
    again, _ = contract.split_quarantine(flat, bridge.AS_OF)
    assert again.count() == clean.count()


def test_reason_order(spark):
    item = [("a", "b", 1, 1.0)]
    now, late = dt.datetime(2026, 1, 1), dt.datetime(2027, 1, 1)
    base = ["R", "U", "ST001", now, "USD", "card", "v", 0.9, item, 1.0, 0.1, 1.1]

    def row(rid, **over):
        r = dict(zip(S.CANONICAL_COLUMNS, base, strict=True)) | {"receipt_id": rid} | over
        return tuple(r[c] for c in S.CANONICAL_COLUMNS)

    rows = [
        row("ok"), row("", total=1.0), row("nan", total=float("nan")), row("zero", total=0.0, store_id="ZZ"),
        row("store", store_id="ZZ", items=[]), row("items", items=None, currency="x"),
        row("cur", currency="usd", submitted_at=late), row("late", submitted_at=late), row("user", user_id=None, total=-1.0),
    ]
    df = spark.createDataFrame(rows, S.RECEIPT)
    got = {r["receipt_id"]: r["quarantine_reason"] for r in contract.tag_reasons(df, "2026-06-01 00:00:00").collect()}
    assert got == {
        "ok": None, "": "missing_required_field", "nan": "missing_required_field", "zero": "non_positive_total",
        "store": "unknown_store", "items": "empty_items", "cur": "bad_currency", "late": "future_timestamp",
        "user": "missing_required_field",
    }
    extra = contract.tag_reasons(df, "2026-06-01 00:00:00", extra_rules=[("cheap", F.col("total") < 2)])
    assert extra.where("receipt_id = 'ok'").first()["quarantine_reason"] == "cheap"


def test_tiny_and_stale_batches_fail(spark, tables):
    tiny = tagged(tables).limit(10)
    verdict = contract.evaluate_gates(tiny, bridge.AS_OF)
    assert not verdict.passed and any("volume" in f for f in verdict.failures)
    stale = contract.evaluate_gates(tagged(tables), "2002-08-02 00:00:00")
    assert any("freshness" in f for f in stale.failures)
    empty = contract.evaluate_gates(tagged(tables).where("false"))
    assert empty.n_rows == 0 and empty.quarantine_rate == 0.0 and not empty.passed


def test_redelivered_copies_of_one_id_collapse(spark, tables):
    once = tagged(tables).where("quarantine_reason is null").drop("quarantine_reason", "items")
    one_id = once.limit(1).crossJoin(spark.range(500)).withColumn("submitted_at", F.col("submitted_at") + F.make_dt_interval(secs=F.col("id"))).drop("id")
    out = silver.silver_receipts(once.unionByName(one_id))
    assert out.count() == once.count()
    same = out.join(once.select("receipt_id", F.col("submitted_at").cast("timestamp_ntz").alias("t")), "receipt_id")
    assert same.where("t <> submitted_at").isEmpty()


def test_whole_warehouse_passes_its_checks(spark, tables):
    raw = raw_sets(tables)
    # Put the test regions on the accepted list's names.
    names = F.create_map(*[x for pair in zip(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"], S.REGIONS, strict=True) for x in (F.lit(pair[0]), F.lit(pair[1]))])
    raw["store_master"] = raw["store_master"].withColumn("region", names[F.col("region")])
    raw["slice_metrics"] = spark.createDataFrame(
        [("a", "b", 1, 1, 1.0, 1.0, 0.0, False)],
        "slice string, value string, n bigint, n_positive bigint, recall double, flag_rate double, recall_gap_vs_overall double, reliable boolean",
    )
    t = warehouse.build(raw)
    t["br_spark_store_health"] = daily_store_health(raw["receipts"], raw["receipt_items"])
    found = checks.warehouse_checks(t)
    assert len(found) == 59
    counts = {r["check_name"]: r["n_violations"] for r in checks.check_counts(found).collect()}
    assert {k: v for k, v in counts.items() if v} == {}
    # planted faults: both forms find the same
    facts, queue = t["fct_receipt"].cache(), t["mart_review_queue"].cache()
    one = facts.where("store_key is not null").limit(1).cache()
    t["fct_receipt"] = facts.unionByName(one).unionByName(one.withColumns({"receipt_id": F.lit("Rx"), "anomaly_score": F.lit(1.5), "store_key": F.lit("gone"), "reported_total": F.lit(-1.0)})).unionByName(
        one.withColumns({"receipt_id": F.lit(None).cast("string"), "computed_total": F.lit(None).cast("double")})
    )
    t["mart_review_queue"] = queue.unionByName(queue.limit(1).withColumns({"receipt_id": F.lit("Ry"), "model_reasoning": F.lit(""), "rule_based_hint": F.lit("odd")}))
    rows = {r["check_name"]: r["n_violations"] for r in checks.check_counts(checks.warehouse_checks(t)).collect()}
    once = {r["check_name"]: r["n_violations"] for r in checks.warehouse_counts(t).collect()}
    assert rows == once and {k for k, v in once.items() if v} >= {
        "unique_fct_receipt_receipt_id", "not_null_fct_receipt_receipt_id", "not_null_fct_receipt_computed_total", "related_fct_receipt_store_key", "scores_out_of_range",
        "non_positive_totals", "flagged_have_reasoning", "accepted_mart_review_queue_rule_based_hint", "fan_out",
    }


def test_version_history_and_boundaries(spark):
    feed = spark.createDataFrame(
        [("S1", dt.datetime(2025, 1, 1), "west", "express", "M1", "initial_load"), ("S1", dt.datetime(2025, 6, 1), "west", "standard", "M1", "remodel")],
        "store_id string, effective_from timestamp, region string, store_format string, manager_id string, change_reason string",
    )
    from tallyforge.operators.dims import dim_store
    from tallyforge.operators.facts import point_in_time_join

    dim = dim_store(silver.store_versions(feed))
    rows = spark.createDataFrame(
        [("early", "S1", dt.datetime(1950, 1, 1)), ("edge", "S1", dt.datetime(2025, 6, 1)), ("none", "S2", dt.datetime(2025, 6, 1))],
        "receipt_id string, store_id string, submitted_at timestamp",
    ).withColumn("submitted_at", F.col("submitted_at").cast("timestamp_ntz"))
    hit = point_in_time_join(rows, dim).join(dim.select("store_key", "version_number"), "store_key", "left")
    assert {r["receipt_id"]: r["version_number"] for r in hit.collect()} == {"early": 1, "edge": 2, "none": None}
    broken = dim.withColumn("valid_to", F.when(F.col("version_number") == 1, F.lit("2025-07-01").cast("timestamp_ntz")).otherwise(F.col("valid_to")))
    assert checks.version_overlaps(broken).count() == 2 and checks.version_gaps(broken).count() == 1
    assert checks.version_overlaps(dim).isEmpty() and checks.version_gaps(dim).isEmpty() and checks.not_one_current(dim).isEmpty()


def small(spark):
    receipts = spark.createDataFrame(
        [("R1", "ST001", dt.datetime(2026, 6, 1, 10), 13.50, 0.9), ("R2", "ST001", dt.datetime(2026, 6, 1, 11), 99.00, 0.8), ("R3", "ST002", dt.datetime(2026, 6, 2, 9), 4.21, 0.95)],
        "receipt_id string, store_id string, submitted_at timestamp, total double, image_quality double",
    )
    items = spark.createDataFrame(
        [("R1", "S1", 2, 4.29), ("R1", "S2", 1, 3.89), ("R2", "S3", 1, 9.99), ("R3", "S4", 1, 3.89)],
        "receipt_id string, sku string, qty int, unit_price double",
    )
    return receipts, items


def test_store_day_job(spark, tmp_path):
    receipts, items = small(spark)
    rows = daily_store_health(receipts, items).collect()
    assert len(rows) == 2 and sum(r["n_receipts"] for r in rows) == 3
    assert rows[0]["store_id"] == "ST001" and rows[0]["n_receipts"] == 2
    assert sum(r["n_failing_reconciliation"] for r in rows) == 1
    assert rows == daily_store_health(receipts, items).collect()
    land({"receipts": receipts, "receipt_items": items}, str(tmp_path))
    assert run(spark, str(tmp_path), bronze_dir=str(tmp_path / "bronze")) == 2


def test_landing_sets_become_bronze_views(spark, tables, tmp_path):
    raw = {k: v for k, v in raw_sets(tables).items()}
    one = spark.range(1).select(F.lit("a").alias("feature"), F.lit(1.0).alias("mean_abs_shap"))
    land({**raw, "shap_global": one, "slice_metrics": one}, str(tmp_path))
    views = bronze_views(spark, str(tmp_path))
    assert len(views) == 8 and spark.sql("select count(*) from br_receipts").first()[0] == raw["receipts"].count()
    with pytest.raises(ValueError):
        land({"other": one}, str(tmp_path))


def test_unscored_rows_count_but_do_not_sum(spark, tables):
    t = warehouse.build({**raw_sets(tables), "scores": bridge.scores(tables).where("false")}, lines=False)
    row = store_health(t["fct_receipt"], t["dim_store"]).first()
    assert row["n_receipts"] >= 1 and row["n_flagged"] is None and row["avg_anomaly_score"] is None


def test_point_in_time_merge_with_one_hot_store(spark):
    """Rows and versions of one store over many slices, gaps, nulls and repeated rows, against the plain join."""
    import random

    from tallyforge.operators.facts import point_in_time_join, point_in_time_merge

    rng, day = random.Random(3), dt.datetime(2025, 1, 1)
    versions, at = [], 0
    for n in range(400):
        ends = at + rng.randint(1, 50)
        versions.append((f"K{n}", "hot" if n < 380 else f"S{n}", day + dt.timedelta(hours=at), day + dt.timedelta(hours=ends)))
        at = ends + rng.choice([0, 0, 3])
    rows = [(f"R{i}", rng.choice(["hot"] * 8 + ["S390", "nowhere", None]), rng.choice([day + dt.timedelta(hours=rng.randint(-5, at + 5)), day + dt.timedelta(minutes=rng.randint(0, 60 * at))])) for i in range(3000)]
    rows += [rows[0], rows[0], ("Rn", "hot", None)] + [(f"E{i}", v[1], v[e]) for i, v in enumerate(versions) for e in (2, 3)]
    dim = spark.createDataFrame(versions, "store_key string, store_natural_key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    df = spark.createDataFrame(rows, "receipt_id string, store_id string, submitted_at timestamp_ntz").repartition(7)
    got, want = (sorted(map(str, f(df, dim).select("receipt_id", "store_id", "submitted_at", "store_key").collect())) for f in (point_in_time_merge, point_in_time_join))
    assert got == want and len(got) == len(rows)


def test_overlap_sweep_against_all_pairs(spark):
    import random

    rng, day = random.Random(4), dt.datetime(2025, 1, 1)
    rows = []
    for n in range(300):
        start = rng.randint(0, 2000)
        rows.append((rng.choice(["hot"] * 5 + ["a", "b"]), f"K{n}", n, day + dt.timedelta(hours=start), day + dt.timedelta(hours=start + rng.choice([0, 1, 2, 30]))))
    rows += [("whole", "W1", 1, day, day + dt.timedelta(hours=9)), ("whole", "W2", 2, day + dt.timedelta(hours=1), day + dt.timedelta(hours=2)), ("whole", "W3", 3, day + dt.timedelta(hours=5), day + dt.timedelta(hours=6)), ("whole", "W4", 4, day + dt.timedelta(hours=9), day + dt.timedelta(hours=10))]
    dim = spark.createDataFrame(rows, "store_natural_key string, store_key string, version_number int, valid_from timestamp_ntz, valid_to timestamp_ntz").repartition(5)
    got = sorted((r.store_natural_key, r.v1, r.v2) for r in checks.version_overlaps(dim).collect())
    want = sorted((s, v, w) for s, _, v, a, b in rows for z, _, w, c, d in rows if s == z and v != w and max(a, c) < min(b, d))
    assert got == want and ("whole", 1, 3) in got and ("whole", 1, 4) not in got


def test_a_row_meets_only_versions_of_its_day(spark):
    """Versions outside the span of the rows, or of other days, are no partners; ends and gaps are as stamped."""
    from pyspark.sql import functions as F

    from tallyforge.operators.facts import point_in_time_join

    stamp = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    many = [("S", f"v{i}", f"{2000 + i}-01-01 06:00:00", f"{2001 + i}-01-01 06:00:00") for i in range(500)]
    odd = [("S", "gone", "2001-06-01 00:00:00", "2001-06-01 00:00:00"), ("S", None, None, "2002-01-01 00:00:00"), ("T", "t", "2001-03-01 10:00:00", "2001-03-01 11:00:00")]
    dim = spark.createDataFrame(many + odd, "store_natural_key string, store_key string, valid_from string, valid_to string")
    dim = dim.select("store_natural_key", "store_key", stamp("valid_from"), stamp("valid_to"))
    asked = [("a", "S", "2001-01-01 05:59:59"), ("b", "S", "2001-01-01 06:00:00"), ("c", "T", "2001-03-01 10:59:59"), ("d", "T", "2001-03-01 11:00:00"), ("e", "S", None), ("f", None, "2001-01-01 06:00:00")]
    rows = spark.createDataFrame(asked, "receipt_id string, store_id string, submitted_at string").select("receipt_id", "store_id", stamp("submitted_at"))
    hit = point_in_time_join(rows, dim)
    assert {r.receipt_id: r.store_key for r in hit.collect()} == {"a": "v0", "b": "v1", "c": "t", "d": None, "e": None, "f": None} and hit.count() == 6
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "_day" in plan  # the day is a join key, so 500 versions of a store are not compared with each row
    assert point_in_time_join(rows.limit(0), dim).count() == 0


def test_lines_are_dealt_once(spark, tables):
    """The order of lines and the fold to receipts share one exchange of the lines."""
    from tallyforge import bridge

    folded = bridge.items(tables).groupBy("receipt_id").count()
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(receipt_id") == 1 and "hashpartitioning(l_orderkey" not in plan


def test_review_queue_comes_highest_score_first(spark):
    from tallyforge.operators.marts import review_queue

    facts = spark.range(0, 60, 1, 6).selectExpr(
        "concat('R', lpad(cast((id * 37) % 60 as string), 2, '0')) as receipt_id", "timestamp_ntz'2025-01-01 00:00:00' as submitted_at", "'ST001' as store_id",
        "if(id % 7 = 0, null, 'k1') as store_key", "'U1' as user_id", "cast((id * 7) % 20 as double) / 20 as anomaly_score", "cast(id % 3 > 0 as int) as is_flagged", "'f' as top_factors",
        "1.0D as reported_total", "1.0D as computed_total", "0.0D as total_residual", "0.0D as total_residual_pct", "1 as n_items", "1 as max_qty", "1.0D as max_unit_price",
        "0.9D as image_quality", "false as fails_reconciliation",
    )
    dim = spark.createDataFrame([("k1", "west", "express")], "store_key string, region string, store_format string")
    got = [(-r["anomaly_score"], r["receipt_id"]) for r in review_queue(facts, dim).collect()]
    assert len(got) == 40 and got == sorted(got)
