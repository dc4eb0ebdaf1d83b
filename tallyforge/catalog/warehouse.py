"""Registered queries: sources, gate, bronze to gold, marts and data tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge import bridge, schemas as S
from tallyforge.bridge import AS_OF, Tables
from tallyforge.catalog.sql import FAILS, rate, with_tables, xavg
from tallyforge.operators import checks, contract, dims, facts, marts, silver
from tallyforge.plans import warehouse
from tallyforge.plans.batch import latest_format
from tallyforge.plans.store_health import daily_store_health
from tallyforge.session import settle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql, extra)
        return fn

    return wrap


def tagged(t: Tables):
    return contract.tag_reasons(bridge.flat_receipts(t), AS_OF)


def ntz(df):
    return df.withColumn("submitted_at", F.col("submitted_at").cast("timestamp_ntz"))


def clean_flat(t: Tables):
    return tagged(t).where("quarantine_reason is null").drop("quarantine_reason", "items")


def raw_set(t: Tables, name: str):
    """One landing set, as derived from the test tables."""
    if name == "receipts":
        return clean_flat(t)
    if name == "receipt_items":
        return bridge.items(t).join(raw(t, "receipts").select("receipt_id"), "receipt_id", "left_semi")
    if name == "quarantine":
        return tagged(t).where("quarantine_reason is not null").drop("items")
    return {"store_master": bridge.store_feed, "scores": bridge.scores, "explanations": bridge.explanations}[name](t)


RAW = ["receipts", "receipt_items", "quarantine", "store_master", "scores", "explanations"]
_LANDED: dict = {}


def raw(t: Tables, name: str):
    """The landing set as a stored table: written on first use, read from then on."""
    key = (t.spark.sparkContext.applicationId, t.dir, name)
    if key not in _LANDED:
        _LANDED[key] = settle(raw_set(t, name))
    return _LANDED[key]


def raw_sets(t: Tables) -> dict:
    return {name: raw(t, name) for name in RAW}


def tables(t: Tables, lines: bool = False) -> dict:
    return warehouse.build(raw_sets(t), lines=lines)


def store_dim(t: Tables):
    return dims.dim_store(silver.store_versions(raw(t, "store_master")))


def text_ends(df):
    """Version ends as text: year 9999 is past what nanosecond clients can hold."""
    return df.withColumn("valid_to", F.col("valid_to").cast("string"))


# ---------------------------------------------------------------- gate ---
TEXT_END = "replace (cast(valid_to as varchar) as valid_to)"
FLAT = "receipt_id, user_id, store_id, submitted_at, currency, payment_method, scanner_version, image_quality, subtotal, tax, total, anomaly_type, is_anomaly"


@register("contract_reasons", "select receipt_id, quarantine_reason from b_tagged")
def _(t):
    return tagged(t).select("receipt_id", "quarantine_reason")


@register(
    "contract_reason_counts",
    "select quarantine_reason as reason, count(*) as n from b_quarantine group by quarantine_reason",
)
def _(t):
    return contract.reason_histogram(tagged(t).where("quarantine_reason is not null"))


@register("quarantine_clean_side", f"select {FLAT} from b_clean")
def _(t):
    clean, _ = contract.split_quarantine(bridge.flat_receipts(t), AS_OF)
    return ntz(clean.drop("items"))


@register("quarantine_held_side", f"select {FLAT}, quarantine_reason from b_quarantine")
def _(t):
    _, held = contract.split_quarantine(bridge.flat_receipts(t), AS_OF)
    return ntz(held.drop("items"))


@register(
    "quarantine_conservation",
    "select count(*) as n_all, count(*) filter (where quarantine_reason is null) as n_clean, "
    "count(*) filter (where quarantine_reason is not null) as n_held from b_tagged",
)
def _(t):
    clean, held = contract.split_quarantine(bridge.flat_receipts(t), AS_OF)
    return bridge.flat_receipts(t).agg(
        F.count(F.lit(1)).alias("n_all"),
    ).select(
        "n_all",
        clean.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_clean"),
        held.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_held"),
    )


@register(
    "store_membership_join",
    "select r.receipt_id, f.store_id is not null as known from b_receipts r "
    "left join (select distinct store_id from b_feed) f on f.store_id = r.store_id",
)
def _(t):
    feed = bridge.store_feed(t).select("store_id")
    out = contract.tag_reasons(bridge.flat_receipts(t).withColumns({"user_id": F.lit("U"), "total": F.lit(1.0)}), AS_OF, feed)
    return out.select("receipt_id", (~F.col("quarantine_reason").eqNullSafe("unknown_store")).alias("known"))


@register(
    "gate_metrics",
    """
select n_rows >= 100 and not q > 0.15e0 and not nul > 0.02e0 and not lag > 3.0e0 as passed,
       n_rows, n_quarantined, q as quarantine_rate, nul as null_rate, age as max_age_days
from (select count(*) as n_rows, count(*) filter (where quarantine_reason is not null) as n_quarantined,
             cast(count(*) filter (where quarantine_reason is not null) as double) / count(*) as q,
             cast(count(*) filter (where quarantine_reason is null and (user_id is null)) as double)
               / (5 * count(*) filter (where quarantine_reason is null)) as nul,
             cast(epoch_us(max(submitted_at) filter (where quarantine_reason is null))
                - epoch_us(min(submitted_at) filter (where quarantine_reason is null)) as double) / 86400e6 as age,
             cast(epoch_us(timestamp '2001-08-02')
                - epoch_us(max(submitted_at) filter (where quarantine_reason is null)) as double) / 86400e6 as lag
      from b_tagged)""",
)
def _(t):
    return contract.gate_metrics(tagged(t), AS_OF).drop("failures")


@register(
    "gate_failures",
    """
select false as passed, n, held as n_quarantined, array_to_string(list_filter([
         case when n < 100 then 'volume: ' || n || ' rows < 100' end,
         case when held > 0.15e0 * n then 'quarantine_rate: ' || printf('%.3f', held * 1e0 / n) || ' > 0.15' end,
         case when gaps > 0.02e0 * 5 * (n - held) then 'null_rate: ' || printf('%.3f', gaps * 1e0 / (5 * (n - held))) || ' > 0.02' end,
         case when newest < timestamp '2029-12-29' then 'freshness: ' || printf('%.2f', epoch_us(timestamp '2030-01-01' - newest) / 86400e6) || 'd > 3.0d' end
       ], lambda m: m is not null), '; ') as failures
from (select count(*) as n, count(*) filter (not ok) as held, count(*) filter (ok and user_id is null) as gaps,
             max(submitted_at) filter (ok) as newest
      from (select *, user_id is not null and total > 0 and store_id in ('ST001', 'ST002') and has_lines and currency = 'USD' as ok
            from b_receipts))""",
)
def _(t):
    late = contract.tag_reasons(bridge.flat_receipts(t), "2030-01-01 00:00:00", ["ST001", "ST002"])
    verdict = contract.gate_metrics(late, "2030-01-01 00:00:00")
    return verdict.select("passed", F.col("n_rows").alias("n"), "n_quarantined", F.array_join("failures", "; ").alias("failures"))


# -------------------------------------------------------------- silver ---
@register(
    "items_exploded",
    "select receipt_id, line_no, sku, item_name, qty, unit_price from b_items",
)
def _(t):
    return silver.explode_items(bridge.receipts(t))


@register(
    "silver_receipts",
    """select *, submitted_at::date as submitted_date from (
         select * exclude (submitted_date) from sl_receipts union all by name
         select * exclude (submitted_date) replace (submitted_at + to_seconds(90) as submitted_at) from sl_receipts)
       qualify submitted_at = min(submitted_at) over (partition by receipt_id)""",
)
def _(t):
    once = raw(t, "receipts")
    again = once.withColumn("submitted_at", F.col("submitted_at") + F.expr("interval 90 seconds"))
    return silver.silver_receipts(once.unionByName(again))


@register("silver_items", "select * from sl_receipt_items")
def _(t):
    return silver.silver_items(raw(t, "receipt_items"))


@register("store_versions", f"select * {TEXT_END} from sl_store_versions")
def _(t):
    return text_ends(silver.store_versions(bridge.store_feed(t)))


# ---------------------------------------------------------------- dims ---
@register("dim_date", "select * from dim_date")
def _(t):
    return dims.dim_date(silver.silver_receipts(raw(t, "receipts")))


@register("date_bounds", "select min(submitted_date) as d0, max(submitted_date) as d1 from sl_receipts")
def _(t):
    return dims.date_bounds(silver.type_receipts(raw(t, "receipts")))


@register("dim_sku", "select * from dim_sku")
def _(t):
    return dims.dim_sku(silver.silver_items(raw(t, "receipt_items")))


@register("dim_store", f"select * {TEXT_END} from dim_store")
def _(t):
    return text_ends(store_dim(t))


@register(
    "multi_version_stores",
    """select * exclude (store_key, store_natural_key, version_number, manager_id) replace (valid_to::varchar as valid_to),
              store_natural_key as store_id, version_number as v
       from dim_store qualify max(version_number) over (partition by store_natural_key) > 1""",
)
def _(t):
    return text_ends(dims.multi_version_stores(store_dim(t)))


@register(
    "latest_store_format",
    "select store_id, arg_max(store_format, effective_from) as store_format from b_feed group by store_id",
)
def _(t):
    return latest_format(bridge.store_feed(t))


# --------------------------------------------------------------- facts ---
@register("line_rollup", "select * from rollup")
def _(t):
    return facts.line_rollup(silver.silver_items(raw(t, "receipt_items")))


@register(
    "point_in_time_join",
    """select r.receipt_id, d.store_key, d.valid_from, cast(d.valid_to as varchar) as valid_to from sl_receipts r
       left join dim_store d on d.store_natural_key = r.store_id
        and r.submitted_at >= d.valid_from and r.submitted_at < d.valid_to""",
)
def _(t):
    dim = store_dim(t)
    hit = facts.point_in_time_join(silver.type_receipts(raw(t, "receipts")), dim)
    return text_ends(hit.select("receipt_id", "store_key").join(dim.select("store_key", "valid_from", "valid_to"), "store_key", "left"))


@register(
    "point_in_time_merge",
    """select r.receipt_id, d.store_key, d.valid_from, cast(d.valid_to as varchar) as valid_to from sl_receipts r
       left join dim_store d on d.store_natural_key = r.store_id
        and r.submitted_at >= d.valid_from and r.submitted_at < d.valid_to""",
)
def _(t):
    """The same versions, found by a merge in the order of time."""
    dim = store_dim(t)
    hit = facts.point_in_time_merge(silver.type_receipts(raw(t, "receipts")), dim)
    return text_ends(hit.select("receipt_id", "store_key").join(dim.select("store_key", "valid_from", "valid_to"), "store_key", "left"))


@register("fct_receipt", "select * from fct_receipt")
def _(t):
    return tables(t)["fct_receipt"]


@register("fct_receipt_line", "select * from fct_receipt_line")
def _(t):
    return tables(t, lines=True)["fct_receipt_line"]


# --------------------------------------------------------------- marts ---
@register("mart_review_queue", "select * from mart_review_queue order by anomaly_score desc, receipt_id")
def _(t):
    return tables(t)["mart_review_queue"]


@register(
    "review_hint_counts",
    "select rule_based_hint, count(*) as n from mart_review_queue group by rule_based_hint",
)
def _(t):
    return tables(t)["mart_review_queue"].groupBy("rule_based_hint").agg(F.count(F.lit(1)).alias("n"))


@register(
    "review_queue_top",
    "select receipt_id, anomaly_score, rule_based_hint from (select * from mart_review_queue "
    "order by anomaly_score desc, receipt_id limit 60) where rule_based_hint in ('implausible_quantity', 'poor_image')",
)
def _(t):
    top = marts.queue_view(tables(t)["mart_review_queue"], 60, ["implausible_quantity", "poor_image"])
    return top.select("receipt_id", "anomaly_score", "rule_based_hint")


@register("mart_store_health", "select * from mart_store_health")
def _(t):
    return tables(t)["mart_store_health"]


@register("daily_clean_vitals", "select * from daily_clean")
def _(t):
    return marts.daily_clean_vitals(tables(t)["fct_receipt"])


@register("daily_quarantine", "select * from daily_held")
def _(t):
    return marts.daily_quarantine(raw(t, "quarantine"))


@register("mart_quality_metrics", "select * from mart_quality_metrics")
def _(t):
    return tables(t)["mart_quality_metrics"]


@register(
    "quality_metrics_all_days",
    f"""select coalesce(r.submitted_date, q.submitted_date) as submitted_date,
               coalesce(r.n_clean, 0) as n_clean, coalesce(q.n_quarantined, 0) as n_quarantined,
               {rate('coalesce(q.n_quarantined, 0)', 'coalesce(r.n_clean, 0) + coalesce(q.n_quarantined, 0)')} as quarantine_rate,
               r.n_failing_reconciliation, {rate('r.n_failing_reconciliation', 'r.n_clean')} as reconciliation_failure_rate,
               r.n_flagged, {rate('r.n_flagged', 'r.n_clean')} as flag_rate, r.avg_image_quality
        from daily_clean r full join daily_held q on q.submitted_date = r.submitted_date""",
)
def _(t):
    made = tables(t)
    return marts.quality_metrics(made["fct_receipt"], made["br_quarantine"], keep_quarantine_only_days=True)


@register(
    "rates_unpivot",
    "select submitted_date, 'quarantine_rate' as signal, quarantine_rate as rate from mart_quality_metrics "
    "union all select submitted_date, 'reconciliation_failure_rate', reconciliation_failure_rate from mart_quality_metrics "
    "union all select submitted_date, 'flag_rate', flag_rate from mart_quality_metrics",
)
def _(t):
    return marts.rates_long(tables(t)["mart_quality_metrics"])


@register(
    "health_by_region_format",
    f"""select region, store_format, cast(sum(n_receipts) as bigint) as n_receipts,
               {rate('sum(n_flagged)', 'sum(n_receipts)')} as flag_rate,
               {xavg('avg_image_quality')} as avg_image_quality
        from mart_store_health group by region, store_format""",
)
def _(t):
    return marts.health_by_region_format(tables(t)["mart_store_health"])


@register("daily_store_health", "select * from store_days")
def _(t):
    return daily_store_health(bridge.receipt_heads(t), bridge.items(t))


# ---------------------------------------------------------- data tests ---
@register("test_not_null", "select receipt_id, store_id from b_receipts where user_id is null")
def _(t):
    return checks.not_null(bridge.receipt_heads(t), "user_id").select("receipt_id", "store_id")


@register(
    "test_unique",
    "select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 1",
)
def _(t):
    return checks.unique(t.orders, "o_custkey")


@register("test_accepted_values", "select distinct currency from b_receipts where currency not in ('USD')")
def _(t):
    return checks.accepted_values(bridge.receipt_heads(t), "currency", S.CURRENCIES)


@register(
    "test_relationships",
    "select distinct receipt_id from b_receipts where receipt_id not in (select receipt_id from b_items)",
)
def _(t):
    return checks.relationships(bridge.receipt_heads(t), "receipt_id", bridge.items(t), "receipt_id")


@register(
    "test_flagged_have_reasoning",
    "select q.receipt_id from mart_review_queue q left join (select receipt_id from b_explanations "
    "where factor_1 = 'total') e on e.receipt_id = q.receipt_id where e.receipt_id is null",
)
def _(t):
    made = tables(t)
    only = made["fct_receipt"].withColumn("top_factors", F.when(F.col("factor_1") == "total", F.col("top_factors")))
    return checks.flagged_have_reasoning(marts.review_queue(only, made["dim_store"]))


@register(
    "test_fan_out",
    "select (select count(*) from b_items) as fact_rows, (select count(*) from b_receipts) as silver_rows "
    "where (select count(*) from b_items) <> (select count(*) from b_receipts)",
)
def _(t):
    return checks.fan_out(bridge.items(t), bridge.receipt_heads(t))


@register(
    "test_flag_rate",
    """select count(*) as n, count(*) filter (anomaly_score >= 0.6e0) / cast(count(*) as double) as flag_rate from b_scores
       having count(*) filter (anomaly_score >= 0.6e0) not between 0.005e0 * count(*) and 0.30e0 * count(*)""",
)
def _(t):
    # A threshold this low flags far more than is plausible, so the one row is expected.
    lax = bridge.scores(t).withColumn("is_flagged", (F.col("anomaly_score") >= 0.6).cast("int"))
    return checks.implausible_flag_rate(lax)


@register("test_no_negative_totals", "select receipt_id, total as reported_total from b_receipts where total <= 0")
def _(t):
    return checks.non_positive_totals(bridge.receipt_heads(t).withColumnRenamed("total", "reported_total"))


@register(
    "test_outside_version",
    """select f.receipt_id, f.submitted_at, d.valid_from, cast(d.valid_to as varchar) as valid_to from fct_receipt f
       join (select store_key, valid_from + interval 400 day as valid_from, valid_to from dim_store) d
         on d.store_key = f.store_key
       where f.submitted_at < d.valid_from or f.submitted_at >= d.valid_to""",
)
def _(t):
    made = tables(t)
    moved = made["dim_store"].withColumn("valid_from", F.col("valid_from") + F.expr("interval 400 days"))
    return text_ends(checks.outside_version(made["fct_receipt"], moved))


@register(
    "test_quarantine_not_in_facts",
    "select q.receipt_id from b_quarantine q where q.receipt_id in (select receipt_id from b_items)",
)
def _(t):
    return checks.quarantined_in_facts(raw(t, "quarantine"), bridge.items(t))


@register(
    "test_one_current_version",
    """select store_natural_key, count(*) filter (kept) as n_current from (
         select store_natural_key, valid_to >= timestamp '1996-01-01' and store_natural_key <> 'ST001' as kept from dim_store)
       group by all having count(*) filter (kept) <> 1""",
)
def _(t):
    # Old versions left current, and one store without any: both are findings.
    old = F.col("valid_to") >= F.lit("1996-01-01").cast("timestamp_ntz")
    return checks.not_one_current(store_dim(t).withColumn("is_current", old & (F.col("store_natural_key") != "ST001")))


@register(
    "test_version_gaps",
    """select one.store_natural_key, one.ends as valid_to, next.valid_from as next_valid_from
       from shortened one join shortened next
         on next.store_natural_key = one.store_natural_key and next.version_number = one.version_number + 1
       where next.valid_from is distinct from one.ends""",
    {"shortened": "select *, valid_to - to_days((store_format = 'express')::integer) as ends from dim_store"},
)
def _(t):
    short = F.when(F.col("store_format") == "express", F.col("valid_to") - F.expr("interval 1 day"))
    return checks.version_gaps(store_dim(t).withColumn("valid_to", F.coalesce(short, "valid_to")))


@register(
    "test_version_overlaps",
    """select p.store as store_natural_key, p.v as v1, q.v as v2 from stretched p join stretched q
         on p.store = q.store and p.v <> q.v and greatest(p.lo, q.lo) < least(p.hi, q.hi)""",
    {
        "stretched": "select store_natural_key as store, version_number as v, valid_from as lo, valid_to + to_days("
        "case when store_format = 'express' and not is_current then 200 else 0 end) as hi from dim_store"
    },
)
def _(t):
    longer = F.when(
        (F.col("store_format") == "express") & ~F.col("is_current"), F.col("valid_to") + F.expr("interval 200 days")
    )
    return checks.version_overlaps(store_dim(t).withColumn("valid_to", F.coalesce(longer, "valid_to")))


@register(
    "test_scores_in_range",
    "select receipt_id, anomaly_score + 0.05e0 as anomaly_score from b_scores where anomaly_score + 0.05e0 > 1",
)
def _(t):
    return checks.scores_out_of_range(bridge.scores(t).withColumn("anomaly_score", F.col("anomaly_score") + F.lit(0.05)))


@register(
    "test_two_path_agreement",
    f"""select coalesce(a.submitted_date, b.submitted_date) as submitted_date, coalesce(a.store_id, b.store_id) as store_id,
               a.n_fail as warehouse_fail, b.n_failing_reconciliation as job_fail
        from (select submitted_date, store_id, {FAILS} as n_fail from fct_receipt group by submitted_date, store_id) a
        full join store_days b on a.submitted_date = b.submitted_date and a.store_id = b.store_id
        where a.n_fail is distinct from b.n_failing_reconciliation""",
)
def _(t):
    # The job sees all receipts here and the warehouse only clean ones, so rows are expected.
    return checks.two_path_agreement(tables(t)["fct_receipt"], daily_store_health(bridge.receipt_heads(t), bridge.items(t)))


@register(
    "two_paths_agree_on_clean_rows",
    f"""select submitted_date, store_id, w.n as warehouse_fail, j.n as job_fail
        from (select submitted_date, store_id, {FAILS} as n from fct_receipt group by all) w
        full join (select submitted_at::date as submitted_date, store_id,
                     count(*) filter (abs(total - 1.0825e0 * computed_subtotal) > 0.02e0 * greatest(1.0825e0 * computed_subtotal, 0.01e0)) as n
                   from b_clean left join rollup using (receipt_id) group by all) j using (submitted_date, store_id)
        where w.n is distinct from j.n""",
)
def _(t):
    made = tables(t)
    job = daily_store_health(made["br_receipts"], made["br_receipt_items"])
    return checks.two_path_agreement(made["fct_receipt"], job)
