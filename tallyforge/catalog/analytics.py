"""Registered queries: features, windows, drift, slices, ranking metrics, model and reasons."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge import bridge, schemas as S
from tallyforge.bridge import AS_OF, Tables
from tallyforge.catalog.sql import rate, with_tables
from tallyforge.functions.receipts import image_quality_band, micros
from tallyforge.operators import attribution, checks, contract, drift, features, metrics, model
from tallyforge.operators.ordering import category_codes, exact_quantiles
from tallyforge.operators.windows import prior_window
from tallyforge.plans import scoring
from tallyforge.session import free_shuffles, scratch_path, settle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

def register(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql, {**EXTRA, **(extra or {})})
        return fn

    return wrap


def clean_nested(t: Tables):
    clean, _ = contract.split_quarantine(bridge.receipts(t), AS_OF)
    return clean


def stored_nested(t: Tables):
    """Clean receipts written once, for jobs that read them several times."""
    return settle(clean_nested(t))


EXTRA: dict[str, str] = {}

EXTRA["f_lists"] = """
select receipt_id, list(qty order by line_no) as qs, list(unit_price order by line_no) as ps,
       list(cast(qty as double) * unit_price order by line_no) as amounts
from b_clean_items group by receipt_id"""

EXTRA["f_items"] = """
select receipt_id, cast(len(qs) as integer) as n_items, cast(list_sum(qs) as bigint) as total_qty,
       cast(list_max(qs) as bigint) as max_qty,
       list_reduce(ps, lambda a, b: a + b) / len(ps) as mean_unit_price, list_max(ps) as max_unit_price,
       list_reduce(amounts, lambda a, b: a + b) as recomputed_subtotal
from f_lists"""

EXTRA["f_medians"] = "select sku, median(unit_price) as median_price from b_clean_items group by sku"

EXTRA["f_ratios"] = """
select receipt_id, max(unit_price / median_price) as ratio
from b_clean_items i join f_medians m on m.sku = i.sku group by receipt_id"""

EXTRA["f_prior"] = """
select a.receipt_id, count(b.receipt_id) as n_prior, median(b.total) as median_prior,
       count(b.receipt_id) filter (where abs(b.total - a.total) <= 0.01e0 + abs(a.total) * 1e-5) as n_same
from b_clean a left join b_clean b on a.user_id = b.user_id
 and b.submitted_at >= a.submitted_at - interval 24 hour
 and (b.submitted_at < a.submitted_at or (b.submitted_at = a.submitted_at and b.receipt_id < a.receipt_id))
group by a.receipt_id"""

EXTRA["f_codes"] = """
select 'payment_method' as name, payment_method as value,
       cast(row_number() over (order by payment_method) - 1 as integer) as code
from (select distinct payment_method from b_clean)
union all
select 'scanner_version', scanner_version, cast(row_number() over (order by scanner_version) - 1 as integer)
from (select distinct scanner_version from b_clean)"""

EXTRA["features"] = """
select c.receipt_id, c.submitted_at, c.total, cast(i.n_items as double) as n_items,
       cast(i.total_qty as double) as total_qty, cast(i.max_qty as double) as max_qty,
       i.mean_unit_price, i.max_unit_price, r.ratio as max_price_ratio_vs_sku_median,
       abs(c.total - i.recomputed_subtotal * 1.0825e0) as arithmetic_residual_abs,
       abs(c.total - i.recomputed_subtotal * 1.0825e0) / greatest(i.recomputed_subtotal * 1.0825e0, 0.01e0)
         as arithmetic_residual_rel,
       coalesce(c.tax / case when c.subtotal is not null then greatest(c.subtotal, 0.01e0) end, -1e0) as implied_tax_rate,
       c.image_quality, cast(hour(c.submitted_at) as double) as hour_of_day,
       cast(isodow(c.submitted_at) - 1 as double) as day_of_week,
       cast(mx - epoch_us(c.submitted_at) as double) / 86400e6 as ts_age_days,
       case when epoch_us(c.submitted_at) > mx - 1000000 then 1e0 else 0e0 end as is_future_ts,
       cast(p.n_prior as double) as user_receipts_prior_24h,
       case when p.median_prior > 0 then c.total / p.median_prior else 1e0 end as user_amount_ratio_vs_prior_median,
       cast(p.n_same as double) as same_total_prior_24h,
       case when c.subtotal is null then 1e0 else 0e0 end as subtotal_is_null,
       case when c.tax is null then 1e0 else 0e0 end as tax_is_null,
       cast(pm.code as double) as payment_method_code, cast(sv.code as double) as scanner_version_code,
       c.is_anomaly, c.anomaly_type
from b_clean c join f_items i on i.receipt_id = c.receipt_id join f_ratios r on r.receipt_id = c.receipt_id
join f_prior p on p.receipt_id = c.receipt_id
join f_codes pm on pm.name = 'payment_method' and pm.value = c.payment_method
join f_codes sv on sv.name = 'scanner_version' and sv.value = c.scanner_version
cross join (select max(epoch_us(submitted_at)) as mx from b_clean)"""


# ------------------------------------------------------------ features ---
@register("item_features", "select * from f_items")
def _(t):
    wanted = ["n_items", "total_qty", "max_qty", "mean_unit_price", "max_unit_price", "recomputed_subtotal"]
    return features.item_features(clean_nested(t)).select("receipt_id", *wanted)


@register("sku_median_prices", "select * from f_medians")
def _(t):
    return features.sku_median_prices(clean_nested(t))


@register("sku_price_ratio", "select receipt_id, ratio as max_price_ratio_vs_sku_median from f_ratios")
def _(t):
    clean = stored_nested(t)
    return features.price_ratios(clean, features.sku_median_prices(clean))


@register("category_codes", "select * from f_codes")
def _(t):
    heads = contract.tag_reasons(bridge.flat_receipts(t), AS_OF).where("quarantine_reason is null")
    return category_codes(heads, features.CODED)


@register("receipt_features", "select * from features")
def _(t):
    return features.build_features(clean_nested(t)).withColumn(
        "submitted_at", F.col("submitted_at").cast("timestamp_ntz")
    )


@register(
    "events_prior_24h",
    """select a.event_id, count(b.event_id) as n_prior, median(b.value) as median_prior,
              count(b.event_id) filter (where abs(b.value - a.value) <= 0.01e0 + abs(a.value) * 1e-5) as n_same
       from events a left join events b on a.user_id = b.user_id and b.ts >= a.ts - interval 24 hour
         and (b.ts < a.ts or (b.ts = a.ts and b.event_id < a.event_id)) group by a.event_id""",
)
def _(t):
    rows = t.events.withColumn("_us", micros(F.col("ts")))
    return prior_window(rows, "user_id", "_us", "value", "event_id")


@register(
    "events_prior_24h_busy",
    """select a.event_id, count(b.event_id) as n_prior, median(b.value) as median_prior,
              count(b.event_id) filter (where abs(b.value - a.value) <= 0.01e0 + abs(a.value) * 1e-5) as n_same
       from events a left join events b on a.event_type = b.event_type and b.ts >= a.ts - interval 24 hour
         and (b.ts < a.ts or (b.ts = a.ts and b.event_id < a.event_id)) group by a.event_id""",
)
def _(t):
    # Keyed by event type: a handful of keys hold all rows, so every key is a busy one.
    rows = t.events.withColumn("_us", micros(F.col("ts")))
    return prior_window(rows, "event_type", "_us", "value", "event_id", busy_rows=500)


@register(
    "chrono_split",
    """select receipt_id, case when rn <= cast(floor(n * 0.75e0) as bigint) then 'train' else 'test' end as split
       from (select receipt_id, row_number() over (order by submitted_at, receipt_id) as rn,
                    count(*) over () as n from b_clean)""",
)
def _(t):
    heads = contract.tag_reasons(bridge.flat_receipts(t), AS_OF).where("quarantine_reason is null")
    early, late = features.time_split(heads.select("receipt_id", "submitted_at"))
    return early.select("receipt_id", F.lit("train").alias("split")).unionByName(
        late.select("receipt_id", F.lit("test").alias("split"))
    )


@register(
    "line_quantiles",
    """select l_returnflag, count(*) as n, quantile_cont(l_extendedprice, 0.5e0) as q50,
              quantile_cont(l_extendedprice, 1.0e0) as q100, quantile_cont(l_extendedprice, 0.0e0) as q0
       from lineitem group by l_returnflag""",
)
def _(t):
    q = exact_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", [0.5, 1.0, 0.0])
    return q.select("l_returnflag", "n", *[F.col("quantiles")[i].alias(c) for i, c in enumerate(["q50", "q100", "q0"])])


# --------------------------------------------------------------- drift ---
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def psi_sql(both: str) -> dict[str, str]:
    """PSI over a ``both(feature, value, is_ref)`` expression."""
    points = ", ".join(f"{i / 10}e0" for i in range(11))
    return {
        "p_both": both,
        "p_edges": f"""select feature, case when len(u) >= 3 then u[2:len(u) - 1] end as inn from (
            select feature, list_sort(list_distinct(quantile_cont(value, [{points}]))) as u
            from p_both where is_ref = 1 group by feature)""",
        "p_counts": """select b.feature, coalesce(len(list_filter(e.inn, lambda q: q <= b.value)), 0) as bin,
            sum(b.is_ref) as nr, sum(1 - b.is_ref) as nc, bool_or(e.inn is not null) as usable
            from p_both b join p_edges e on e.feature = b.feature group by 1, 2""",
        "p_shares": """select feature, usable, greatest(nr * 1e0 / sum(nr) over w, 1e-6) as r,
            greatest(nc * 1e0 / sum(nc) over w, 1e-6) as c from p_counts window w as (partition by feature)""",
        "p_psi": """select feature, round(case when bool_and(usable) then sum((c - r) * ln(c / r)) else 0e0 end, 8) as psi
            from p_shares group by feature""",
    }


LINE_PSI = psi_sql(
    " union all ".join(
        f"select '{c}' as feature, {c} as value, case when l_shipdate < timestamp '1998-01-01' then 1 else 0 end as is_ref from lineitem"
        for c in LINE_MEASURES
    )
)


def line_sides(t: Tables):
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return t.lineitem.where(early), t.lineitem.where(~early)


def line_psi(t: Tables):
    ref, cur = line_sides(t)
    return drift.psi_by_feature(ref, cur, LINE_MEASURES).withColumn("psi", F.round("psi", 8))


@register("psi_line_measures", "select * from p_psi", LINE_PSI)
def _(t):
    return line_psi(t)


@register(
    "psi_bands",
    "select feature, psi, case when psi < 0.1 then 'stable' when psi < 0.25 then 'moderate' else 'significant' end as band from p_psi",
    LINE_PSI,
)
def _(t):
    return drift.psi_bands(line_psi(t))


@register(
    "psi_drifted",
    "select feature, psi from p_psi where psi >= 0.25",
    psi_sql(
        "select 'late' as feature, value + case when ts < timestamp '2024-01-16' then 0 else 40 end as value, "
        "case when ts < timestamp '2024-01-16' then 1 else 0 end as is_ref from events union all "
        "select 'same', value, case when ts < timestamp '2024-01-16' then 1 else 0 end from events"
    ),
)
def _(t):
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    moved = t.events.select("ts", F.col("value").alias("same"), (F.col("value") + F.when(early, 0).otherwise(40)).alias("late"))
    psi = drift.psi_by_feature(moved.where(early), moved.where(~early), ["late", "same"])
    return drift.drifted(psi.withColumn("psi", F.round("psi", 8)))


@register("psi_line_measures_sketch", "select feature, true as close from p_psi", LINE_PSI)
def _(t):
    """Whether the sketch's edges give each index to within 0.005 of the exact one."""
    ref, cur = line_sides(t)
    sketch = drift.psi_by_feature(ref, cur, LINE_MEASURES, method="approx").withColumnRenamed("psi", "_sketch")
    both = sketch.join(drift.psi_by_feature(ref, cur, LINE_MEASURES), "feature")
    return both.select("feature", (F.abs(F.col("_sketch") - F.col("psi")) < 0.005).alias("close"))


def feature_table(t: Tables):
    """Features of the clean receipts, written once; ``build_features`` stores the receipts by itself."""
    feats = settle(features.build_features(clean_nested(t)))
    free_shuffles(t.spark)
    return feats


def feature_sides(t: Tables):
    return features.time_split(feature_table(t))


@register(
    "psi_features",
    "select * from p_psi",
    psi_sql(
        "select feature, value, is_ref from (unpivot (select "
        + ", ".join(f"cast({c} as double) as {c}" for c in S.FEATURE_COLUMNS)
        + ", cast(case when rn <= floor(n * 0.75e0) then 1 else 0 end as bigint) as is_ref from (select *, row_number() over "
        "(order by submitted_at, receipt_id) as rn, count(*) over () as n from features)) on "
        + ", ".join(S.FEATURE_COLUMNS)
        + " into name feature value value)"
    ),
)
def _(t):
    ref, cur = feature_sides(t)
    return drift.psi_by_feature(ref, cur, S.FEATURE_COLUMNS).withColumn("psi", F.round("psi", 8))


# -------------------------------------------------------------- slices ---
def slice_sql(pairs: list[tuple[str, str]], source: str) -> str:
    union = " union all ".join(
        f"select '{n}' as slice, cast({c} as varchar) as value, y, flag from ({source})" for n, c in pairs
    )
    recall = rate("count(*) filter (where y = 1 and flag = 1)", "count(*) filter (where y = 1)")
    return f"""select slice, value, count(*) as n, count(*) filter (where y = 1) as n_positive, {recall} as recall,
        {rate('count(*) filter (where flag = 1)', 'count(*)')} as flag_rate,
        (select {rate('count(*) filter (where y = 1 and flag = 1)', 'count(*) filter (where y = 1)')} from ({source})) - {recall}
          as recall_gap_vs_overall,
        count(*) >= 50 and count(*) filter (where y = 1) >= 10 as reliable
        from ({union}) where value is not null group by slice, value"""


DOC_SOURCE = "select lang, source, n_chars, quality as y, toxic as flag from labels l join documents d on d.doc_id = l.doc_id"
LENGTH_BAND = "case when n_chars < 500 then 'short' when n_chars < 2000 then 'medium' else 'long' end"


@register("slice_metrics_documents", slice_sql([("lang", "lang"), ("source", "source"), ("length_band", LENGTH_BAND)], DOC_SOURCE))
def _(t):
    joined = t.labels.join(t.documents.select("doc_id", "lang", "source", "n_chars"), "doc_id")
    band = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 2000, "medium").otherwise("long")
    dims = [("lang", F.col("lang")), ("source", F.col("source")), ("length_band", band)]
    return drift.slice_metrics(joined, "quality", "toxic", dims)


RECEIPT_SOURCE = """select c.scanner_version, c.payment_method, f.store_format, c.image_quality, c.is_anomaly as y, s.is_flagged as flag
  from b_clean c join b_scores s on s.receipt_id = c.receipt_id
  left join (select store_id, arg_max(store_format, effective_from) as store_format from b_feed group by store_id) f
    on f.store_id = c.store_id"""
BAND = "case when image_quality < 0.5e0 then 'poor' when image_quality < 0.75e0 then 'fair' else 'good' end"
RECEIPT_SLICES = slice_sql(
    [("scanner_version", "scanner_version"), ("payment_method", "payment_method"), ("store_format", "store_format"), ("image_quality_band", BAND)],
    RECEIPT_SOURCE,
)


def scored_clean(t: Tables):
    heads = contract.tag_reasons(bridge.flat_receipts(t), AS_OF).where("quarantine_reason is null")
    return heads.drop("items").join(bridge.scores(t).drop("submitted_at"), "receipt_id")


def receipt_slices(t: Tables):
    from tallyforge.plans.batch import latest_format

    ctx = scored_clean(t).join(latest_format(bridge.store_feed(t)), "store_id", "left")
    return drift.slice_metrics(ctx, "is_anomaly", "is_flagged")


@register("slice_metrics_receipts", RECEIPT_SLICES)
def _(t):
    return receipt_slices(t)


@register("mart_model_slices", RECEIPT_SLICES)
def _(t):
    from tallyforge.operators import marts

    return marts.model_slices(receipt_slices(t))


REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]  # the five rows of region
_TWINS = {"br_quarantine": "b_quarantine", "br_store_master": "b_feed", "mart_model_slices": "c_slices"}


def check_sql() -> str:
    """Every check of the warehouse, one select each."""
    of = lambda table: _TWINS.get(table, table)
    parts = {}
    for table, column, kind in checks.column_tests(regions=REGION_NAMES):
        name = checks._name(table, column, kind)
        if kind == "not_null":
            parts[name] = f"select count(*) from {of(table)} where {column} is null"
        elif kind == "unique":
            parts[name] = f"select count(*) from (select {column} from {of(table)} where {column} is not null group by 1 having count(*) > 1)"
        elif isinstance(kind, list):
            parts[name] = f"select count(*) from {of(table)} where {column} not in ({', '.join(repr(v) for v in kind)})"
        else:
            parts[name] = f"select count(distinct {column}) from {of(table)} where {column} is not null and {column} not in (select {kind[1]} from {of(kind[0])})"
    parts |= {
        "flagged_have_reasoning": "select count(*) from mart_review_queue where coalesce(model_reasoning, '') = ''",
        "fan_out": "select cast((select count(*) from fct_receipt) <> (select count(*) from sl_receipts) as integer)",
        "implausible_flag_rate": "select cast(avg(is_flagged) not between 0.005e0 and 0.30e0 as integer) from fct_receipt",
        "non_positive_totals": "select count(*) from fct_receipt where reported_total <= 0",
        "scores_out_of_range": "select count(*) from fct_receipt where anomaly_score not between 0 and 1",
        "outside_version": "select count(*) from fct_receipt f join dim_store d on d.store_key = f.store_key where f.submitted_at < d.valid_from or f.submitted_at >= d.valid_to",
        "quarantined_in_facts": "select count(*) from b_quarantine where receipt_id in (select receipt_id from fct_receipt)",
        "not_one_current": "select count(*) from (select store_natural_key from dim_store group by 1 having count(*) filter (is_current) <> 1)",
        "version_gaps": "select count(*) from dim_store o join dim_store n on n.store_natural_key = o.store_natural_key and n.version_number = o.version_number + 1 where n.valid_from <> o.valid_to",
        "version_overlaps": "select count(*) from dim_store p join dim_store q on p.store_natural_key = q.store_natural_key and p.version_number <> q.version_number and greatest(p.valid_from, q.valid_from) < least(p.valid_to, q.valid_to)",
        "two_path_agreement": """select count(*) from (select submitted_date, store_id, count(*) filter (fails_reconciliation) as n from fct_receipt group by all) w
            full join c_job j using (submitted_date, store_id) where w.n is distinct from j.n""",
    }
    return " union all ".join(f"select '{name}' as check_name, ({sql}) :: bigint as n_violations" for name, sql in parts.items())


@register(
    "warehouse_check_counts",
    check_sql(),
    {
        "c_slices": RECEIPT_SLICES,
        "c_job": """select submitted_at::date as submitted_date, store_id,
            count(*) filter (abs(total - 1.0825e0 * computed_subtotal) > 0.02e0 * greatest(1.0825e0 * computed_subtotal, 0.01e0)) as n
            from b_clean left join rollup using (receipt_id) group by all""",
    },
)
def _(t):
    """All checks of the warehouse with their number of violations, one scan a table."""
    from tallyforge.catalog.warehouse import raw_sets
    from tallyforge.plans import warehouse
    from tallyforge.plans.store_health import daily_store_health

    made = warehouse.build({**raw_sets(t), "slice_metrics": receipt_slices(t)}, keep=lambda _, df: settle(df))
    made["br_spark_store_health"] = daily_store_health(made["br_receipts"], made["br_receipt_items"])
    return checks.warehouse_counts(made, regions=REGION_NAMES)


COLLAPSED = slice_sql(
    [("scanner_version", "scanner_version"), ("payment_method", "payment_method")],
    RECEIPT_SOURCE.replace("s.is_flagged as flag", "if(c.payment_method = 'cash', 0, s.is_flagged) as flag"),
)


@register(
    "fairness_violations",
    f"""select slice, value, slice || '=' || value || ' recall ' || cast(round(recall, 4) as varchar) || ' lags overall by '
          || cast(round(recall_gap_vs_overall, 4) as varchar) || ' (n=' || n || ')' as message
        from ({COLLAPSED}) where reliable and recall_gap_vs_overall > 0.2e0""",
)
def _(t):
    # Nothing paid in cash is flagged here: that slice must be reported, and no other.
    blind = scored_clean(t).withColumn("is_flagged", F.when(F.col("payment_method") == "cash", 0).otherwise(F.col("is_flagged")))
    dims = [("scanner_version", F.col("scanner_version")), ("payment_method", F.col("payment_method"))]
    return drift.fairness_violations(drift.slice_metrics(blind, "is_anomaly", "is_flagged", dims))


@register("image_quality_bands", f"select {BAND} as band, count(*) as n from b_receipts group by 1")
def _(t):
    heads = bridge.receipt_heads(t)
    return heads.groupBy(image_quality_band(F.col("image_quality")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- metrics ---
EXTRA["m_rows"] = """
select c.receipt_id, s.anomaly_score as score, c.is_anomaly as y, s.is_flagged, c.anomaly_type
from b_clean c join b_scores s on s.receipt_id = c.receipt_id"""
EXTRA["m_curve"] = f"""
select score, n, pos, nall, pall, {rate('tp', 'nf')} as "precision", {rate('tp', 'pall')} as recall, tp, nf,
       coalesce(2 * {rate('tp', 'nf')} * {rate('tp', 'pall')} / nullif({rate('tp', 'nf')} + {rate('tp', 'pall')}, 0e0), 0e0) as f1
from (select score, n, pos, sum(n) over () as nall, sum(pos) over () as pall,
             sum(pos) over (order by score desc) as tp, sum(n) over (order by score desc) as nf
      from (select score, count(*) as n, sum(y) as pos from m_rows group by score))"""


def curve(t: Tables):
    return metrics.score_curve(scored_clean(t), "anomaly_score", "is_anomaly")


@register(
    "pr_curve",
    'select score, n, cast(pos as bigint) as pos, cast(tp as bigint) as tp, cast(nf as bigint) as n_flagged, "precision", recall, f1 from m_curve',
)
def _(t):
    return curve(t).select("score", "n", "pos", "tp", "n_flagged", "precision", "recall", "f1")


@register(
    "average_precision",
    f'select round(sum({rate("pos", "pall")} * "precision"), 8) as average_precision from m_curve',
)
def _(t):
    return metrics.average_precision(curve(t)).select(F.round("average_precision", 8).alias("average_precision"))


@register(
    "roc_auc",
    """select cast(sum(a.pos * (2 * coalesce(b.neg, 0) + (a.n - a.pos))) as double)
              / (2e0 * max(a.pall) * (max(a.nall) - max(a.pall))) as roc_auc
       from m_curve a left join (select score, sum(n - pos) over (order by score rows between unbounded preceding and 1 preceding) as neg
                                 from m_curve) b on b.score = a.score""",
)
def _(t):
    return metrics.roc_auc(curve(t))


@register("f1_threshold", "select score as threshold, f1 from m_curve order by f1 desc, score limit 1")
def _(t):
    return metrics.best_threshold(curve(t))


@register(
    "precision_at_k",
    """select f as fraction, greatest(1, cast(floor(n * f) as bigint)) as k,
              (select cast(sum(y) as double) / count(*) from (select y, row_number() over (order by score desc, receipt_id) as rn
                from m_rows) where rn <= greatest(1, cast(floor(n * f) as bigint))) as precision
       from (select unnest([0.01e0, 0.05e0, 0.1e0]) as f), (select count(*) as n from m_rows)""",
)
def _(t):
    return metrics.precision_at(scored_clean(t), "anomaly_score", "is_anomaly", "receipt_id", [0.01, 0.05, 0.10])


@register(
    "confusion",
    """select *, tp * 1e0 / greatest(1, tp + fp) as precision_at_threshold, tp * 1e0 / greatest(1, tp + fn) as recall_at_threshold
       from (select count(*) filter (where y = 1 and is_flagged = 1) as tp, count(*) filter (where y = 0 and is_flagged = 1) as fp,
                    count(*) filter (where y = 1 and is_flagged = 0) as fn, count(*) filter (where y = 0 and is_flagged = 0) as tn
             from m_rows)""",
)
def _(t):
    return metrics.confusion(scored_clean(t), "is_anomaly", "is_flagged")


@register(
    "recall_by_type",
    f"select anomaly_type, count(*) as n, {rate('sum(is_flagged)', 'count(is_flagged)')} as recall_at_threshold "
    "from m_rows where anomaly_type is not null group by anomaly_type",
)
def _(t):
    return metrics.recall_by_type(scored_clean(t), "anomaly_type", "is_flagged")


@register(
    "split_statistics",
    f"""select case when rn <= floor(n * 0.75e0) then 'train' else 'test' end as split, count(*) as n,
               {rate('sum(is_anomaly)', 'count(*)')} as positive_rate
        from (select is_anomaly, row_number() over (order by submitted_at, receipt_id) as rn, count(*) over () as n from b_clean)
        group by 1""",
)
def _(t):
    heads = contract.tag_reasons(bridge.flat_receipts(t), AS_OF).where("quarantine_reason is null")
    return metrics.split_statistics(*features.time_split(heads), "is_anomaly")


# --------------------------------------------------------------- model ---
def defective(t: Tables):
    """Bridge receipts without their own labels, broken again by the injector."""
    from tallyforge.operators import defects

    base = bridge.receipts(t).withColumns(
        {"anomaly_type": F.lit(None).cast("string"), "is_anomaly": F.lit(0)}
    )
    return defects.inject_resubmissions(defects.inject_defects(base))


_FITTED: dict = {}


def trained(t: Tables):
    """Features and model of a scale folder; trained once per session, then read back."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _FITTED:
        clean, _ = contract.split_quarantine(defective(t), AS_OF)
        feats = settle(features.build_features(clean))
        free_shuffles(t.spark)
        path = scratch_path(t.spark, "model")
        model.save(model.train(feats), t.spark, path)
        _FITTED[key] = (feats, path)
    feats, path = _FITTED[key]
    return feats, model.load(t.spark, path)


@register("model_metrics")
def _(t):
    _, fitted = trained(t)
    flat = {k: float(v) for k, v in fitted.metrics.items() if isinstance(v, int | float)}
    return t.spark.createDataFrame(sorted(flat.items()), "metric string, value double")


@register("model_floor", "select * from (values ('pr_auc', 0.75e0, true), ('roc_auc', 0.9e0, true)) v(metric, floor, holds)")
def _(t):
    """The floors below which a model must not be released, and whether the fitted one holds them."""
    _, fitted = trained(t)
    floors = [("pr_auc", 0.75), ("roc_auc", 0.9)]
    return t.spark.createDataFrame([(m, f, fitted.metrics[m] >= f) for m, f in floors], "metric string, floor double, holds boolean")


GAIN_FEATURES = ["total", "subtotal", "tax", "image_quality"]


@register(
    "split_gains",
    """select feature, cut, left_rows, case when lh >= 2 and ah - lh >= 2
         then (lg * lg / (lh + 1.5e0) + (ag - lg) * (ag - lg) / (ah - lh + 1.5e0) - ag * ag / (ah + 1.5e0)) / 2 else 0e0 end as gain
       from (select c.feature, c.cut, cast(count(*) filter (x <= cut) as bigint) as left_rows,
               cast(coalesce(sum(g) filter (x <= cut), 0) as bigint) / 16777216e0 as lg, cast(coalesce(sum(h) filter (x <= cut), 0) as bigint) / 16777216e0 as lh,
               cast(sum(g) as bigint) / 16777216e0 as ag, cast(sum(h) as bigint) / 16777216e0 as ah
             from g_cuts c join g_rows r on r.feature = c.feature group by c.feature, c.cut)""",
    {
        "g_sides": "select greatest(sum(is_anomaly), 1) as pos, greatest(sum(1 - is_anomaly), 1) as neg from b_clean",
        "g_heads": """select *, cast(round((0.5e0 - is_anomaly) * w * 16777216) as bigint) as g, cast(round(0.25e0 * w * 16777216) as bigint) as h
            from (select b.*, case when is_anomaly = 1 then neg / cast(pos as double) else 1e0 end as w from b_clean b join g_sides on true)""",
        "g_rows": " union all ".join(f"select '{f}' as feature, coalesce(cast({f} as double), 'inf'::double) as x, g, h from g_heads" for f in GAIN_FEATURES),
        "g_cuts": """select distinct feature, x as cut from (
              select feature, x, row_number() over (partition by feature order by x) as rn, count(*) over (partition by feature) as n, max(x) over (partition by feature) as most
              from g_rows where isfinite(x)) join range(1, 16) s(i) on true
            where rn = ceil(i / 16e0 * n) and x < most""",
    },
)
def _(t):
    """What each cut of the root would bring a fit on clean receipts in its first round."""
    from tallyforge.operators import boosting

    heads = contract.tag_reasons(bridge.flat_receipts(t), AS_OF).where("quarantine_reason is null")
    heads = settle(heads.select(*GAIN_FEATURES, "is_anomaly"))
    return boosting.root_gains(heads, GAIN_FEATURES, "is_anomaly", boosting.cuts(heads, GAIN_FEATURES, 16))


@register("anomaly_scores")
def _(t):
    feats, fitted = trained(t)
    return model.score(fitted, feats)


@register("gain_importance")
def _(t):
    _, fitted = trained(t)
    return model.gain_importance(t.spark, fitted.booster)


@register("attributions")
def _(t):
    feats, fitted = trained(t)
    return attribution.explain(fitted.booster, feats)


@register("global_attribution")
def _(t):
    feats, fitted = trained(t)
    return attribution.global_importance(fitted.booster, feats)


@register("scored_batch")
def _(t):
    _, fitted = trained(t)
    return scoring.score_batch(bridge.receipts(t), fitted).scored


@register("scores_follow_threshold", "select receipt_id, true as in_range, true as flag_follows from b_clean")
def _(t):
    """Every clean receipt of an outside batch has a score in [0, 1] and the flag that the threshold gives it."""
    _, fitted = trained(t)
    got = scoring.score_batch(bridge.receipts(t), fitted, as_of=AS_OF).scored
    return got.select(
        "receipt_id",
        F.col("anomaly_score").between(0, 1).alias("in_range"),
        (F.col("is_flagged") == (F.col("anomaly_score") >= F.lit(fitted.threshold)).cast("int")).alias("flag_follows"),
    )


@register("attributions_add_up", "select receipt_id, true as additive from b_clean")
def _(t):
    """Base value and attributions of each clean receipt sum to the model's margin."""
    _, fitted = trained(t)
    feats = feature_table(t)
    margin = feats.select("receipt_id", fitted.booster.margin().alias("margin"))
    total = F.col("base_value") + F.aggregate("values", F.lit(0.0), lambda s, v: s + v)
    return attribution.attributions(fitted.booster, feats).join(margin, "receipt_id").select(
        "receipt_id", (F.abs(total - F.col("margin")) < 1e-6).alias("additive")
    )


FACTORS = ["total", "image_quality", "tax"]


@register(
    "top_factors",
    """select receipt_id, string_agg(case when v >= 0 then '+' else '-' end || f || ' (' || printf('%+.3f', v) || ')', '; ' order by rk, p)
         as top_factors
       from (select *, row_number() over (partition by receipt_id order by rk, p) as rn
             from (select receipt_id, f, v, p, -abs(v) as rk from (
               select receipt_id, 'total' as f, (bucket - 500) / 8.0e0 as v, 0 as p from hashed union all
               select receipt_id, 'image_quality', (bucket * 7 % 1000 - 500) / 8.0e0, 1 from hashed union all
               select receipt_id, 'tax', (bucket * 13 % 1000 - 500) / 8.0e0, 2 from hashed)))
       where rn <= 2 group by receipt_id""",
    {"hashed": "select 'R' || o_orderkey as receipt_id, o_orderkey % 1000 as bucket from orders"},
)
def _(t):
    b = F.col("o_orderkey") % 1000
    values = t.orders.select(
        F.concat(F.lit("R"), F.col("o_orderkey")).alias("receipt_id"),
        F.lit(0.0).alias("base_value"),
        F.array((b - 500) / F.lit(8.0), (b * 7 % 1000 - 500) / F.lit(8.0), (b * 13 % 1000 - 500) / F.lit(8.0)).alias("values"),
    )
    return attribution.explain_values(values, FACTORS, top_k=2).select("receipt_id", "top_factors")


@register(
    "mart_feature_attribution",
    """select feature, round(mean_abs, 5) as mean_abs_shap from (
         select 'total' as feature, sum(abs(bucket - 500) / 8.0e0) / count(*) as mean_abs from hashed union all
         select 'image_quality', sum(abs(bucket * 7 % 1000 - 500) / 8.0e0) / count(*) from hashed union all
         select 'tax', sum(abs(bucket * 13 % 1000 - 500) / 8.0e0) / count(*) from hashed)""",
    {"hashed": "select 'R' || o_orderkey as receipt_id, o_orderkey % 1000 as bucket from orders"},
)
def _(t):
    from tallyforge.operators import marts

    b = F.col("o_orderkey") % 1000
    values = t.orders.select(
        F.array((b - 500) / F.lit(8.0), (b * 7 % 1000 - 500) / F.lit(8.0), (b * 13 % 1000 - 500) / F.lit(8.0)).alias("values")
    )
    return marts.feature_attribution(attribution.mean_abs(values, FACTORS))


@register(
    "drift_report",
    f"""select 'stable' as prediction_status, (select count(*) filter (round(psi, 4) >= 0.25) > 0 from p_psi) as retrain_recommended,
               count(*) filter (reliable and recall_gap_vs_overall > 0.2e0) = 0 as fairness_passed, count(*)::integer as n_slices
        from ({RECEIPT_SLICES})""",
    LINE_PSI,
)
def _(t):
    """Report sink round trip: drift, slices and gate verdict as one JSON document."""
    from tallyforge.sources.sinks import write_report

    ref, cur = line_sides(t)
    report = drift.detect_drift(ref, cur, LINE_MEASURES)
    path = scratch_path(t.spark, "drift_report")
    write_report(drift.drift_document(t.spark, report, drift.rounded_slices(receipt_slices(t))), path)
    return t.spark.read.json(path).select("prediction_status", "retrain_recommended", "fairness_passed", F.size("slices").alias("n_slices"))


@register("drift_report_values", "select feature, round(psi, 4) as psi, round(psi, 4) >= 0.25e0 as drifted from p_psi", LINE_PSI)
def _(t):
    """The stability index of every measure as the stored report has it."""
    from tallyforge.sources.sinks import write_report

    ref, cur = line_sides(t)
    path = scratch_path(t.spark, "drift_report")
    document = drift.drift_document(t.spark, drift.detect_drift(ref, cur, LINE_MEASURES), drift.rounded_slices(receipt_slices(t)))
    write_report(document, path)
    doc = t.spark.read.json(path)
    values = F.map_from_arrays(F.array(*[F.lit(c) for c in LINE_MEASURES]), F.array(*[F.col(f"feature_psi.{c}") for c in LINE_MEASURES]))
    told = doc.select(F.explode(values).alias("feature", "psi"), F.col("drifted_features").cast("array<string>").alias("moved"))
    return told.select("feature", "psi", F.array_contains("moved", F.col("feature")).alias("drifted"))


@register("psi_top", "select * from (select feature, psi, case when psi < 0.1 then 'stable' when psi < 0.25 then 'moderate' else 'significant' end as band from p_psi order by psi desc, feature limit 2)", LINE_PSI)
def _(t):
    return drift.psi_bands(line_psi(t), top=2)


@register("gain_importance_order", "select 22 as n_features, true as strongest_first, true as shares_of_one, true as only_split_features")
def _(t):
    """Rank order of the gains: strongest first, shares of one, zero for features that no tree splits."""
    _, fitted = trained(t)
    rows = model.gain_importance(t.spark, fitted.booster).collect()
    values = [r["importance"] for r in rows]
    used = {fitted.booster.features[f] for f in fitted.booster.nodes.feature if f >= 0}
    told = (len(rows), values == sorted(values, reverse=True), abs(sum(values) - 1) < 1e-9, {r["feature"] for r in rows if r["importance"] > 0} == used)
    return t.spark.createDataFrame([told], "n_features int, strongest_first boolean, shares_of_one boolean, only_split_features boolean")


LANDED = {"receipts": "b_clean", "receipt_items": "b_clean_items", "quarantine": "b_quarantine", "store_master": "b_feed", "scores": "b_scores", "explanations": "b_explanations", "slice_metrics": "c_slices", "shap_global": "(values (1), (2), (3))"}


def landing_frames(t: Tables) -> dict:
    """All eight landing sets; the attributions are those of three columns."""
    from tallyforge.catalog.warehouse import raw_sets

    b = F.col("o_orderkey") % 1000
    values = t.orders.select(F.array((b - 500) / F.lit(8.0), (b * 7 % 1000 - 500) / F.lit(8.0), (b * 13 % 1000 - 500) / F.lit(8.0)).alias("values"))
    return {**raw_sets(t), "slice_metrics": receipt_slices(t), "shap_global": attribution.mean_abs(values, FACTORS)}


@register("raw_tables", " union all ".join(f"select 'raw_{n}' as name, count(*) as n from {sql}" for n, sql in LANDED.items()), {"c_slices": RECEIPT_SLICES})
def _(t):
    """Managed tables of all landing sets, created and then replaced, in a database under the shared folder."""
    from functools import reduce

    from tallyforge.sources.sinks import load_raw_tables

    root = scratch_path(t.spark, "database")
    database = f"raw_{root.split('/')[-2]}"
    t.spark.sql(f"create database {database} location '{root}'")
    frames = landing_frames(t)
    load_raw_tables({"scores": frames["scores"].where("is_flagged = 1")}, database)
    load_raw_tables(frames, database)
    counts = [t.spark.table(f"{database}.raw_{n}").agg(F.lit(f"raw_{n}").alias("name"), F.count("*").alias("n")) for n in frames]
    return reduce(lambda a, b: a.unionByName(b), counts)


@register("bronze_views", " union all ".join(f"select 'br_{n}' as name, count(*) as n from {sql}" for n, sql in LANDED.items()), {"c_slices": RECEIPT_SLICES})
def _(t):
    """The eight views over the landing sets, read by SQL."""
    from tallyforge.sources.sinks import bronze_views, land

    root = scratch_path(t.spark, "landing")
    land(landing_frames(t), root)
    views = bronze_views(t.spark, root)
    return t.spark.sql(" union all ".join(f"select 'br_{n}' as name, count(*) as n from br_{n}" for n in views))
