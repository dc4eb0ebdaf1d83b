"""DuckDB SQL for the same derivations, used as the independent check.

Each entry is a named table expression; ``with_tables`` pulls in what a query needs.
"""

from __future__ import annotations

import re

from tallyforge import schemas as S
from tallyforge.bridge import AS_OF


def xsum(x: str) -> str:
    """Exact: every value as a decimal by its shortest text, the total back to the nearest double."""
    return f"cast(cast(sum(cast(cast(({x}) as varchar) as decimal(38, 10))) as varchar) as double)"


def xavg(x: str) -> str:
    return f"({xsum(x)} / cast(nullif(count({x}), 0) as double))"


def rate(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0e0))"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


HH = "((o_orderkey * 48271) % 2147483647)"
BK = f"({HH} % 1000)"

TABLES: dict[str, str] = {}

TABLES["b_items"] = """
select 'R' || l_orderkey as receipt_id,
       cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_shipdate) as integer) as line_no,
       'SKU' || l_partkey as sku, p_name as item_name,
       cast(floor(l_quantity) as integer) as qty, l_extendedprice / l_quantity as unit_price
from lineitem left join part on p_partkey = l_partkey"""

TABLES["b_sums"] = """
select l_orderkey, cast(sum(cast(round(l_extendedprice * 100.0e0) as bigint)) as double) / 100.0e0 as lines
from lineitem group by l_orderkey"""

TABLES["b_receipts"] = f"""
select 'R' || o_orderkey as receipt_id,
       case when {BK} > 4 then 'U' || o_custkey end as user_id,
       case when {BK} between 5 and 9 then 'ZZ900'
            else 'ST' || lpad(cast(o_orderkey % 10 + 1 as varchar), 3, '0') end as store_id,
       o_orderdate + to_seconds({HH} % 86400)
         + to_days(case when {BK} between 20 and 24 then 3000 else 0 end) as submitted_at,
       case when {BK} between 10 and 14 then 'usd' else 'USD' end as currency,
       case o_orderpriority when '1-URGENT' then 'ebt' when '2-HIGH' then 'wallet'
            when '3-MEDIUM' then 'cash' else 'card' end as payment_method,
       'v' || ({HH} % 4 + 1) as scanner_version,
       case when {BK} between 60 and 79 then ({HH} % 38 + 5) / 100.0e0
            else ({HH} % 51 + 50) / 100.0e0 end as image_quality,
       case when {BK} between 60 and 71 then null else lines end as subtotal,
       case when {BK} between 66 and 79 then null else lines * 0.0825e0 end as tax,
       case when {BK} between 15 and 19 then -o_totalprice
            when lines is null then o_totalprice
            when {BK} between 40 and 59 then lines * 1.25e0
            else lines * 1.0825e0 end as total,
       case when {BK} between 0 and 24 then 'malformed_payload'
            when {BK} between 40 and 59 then 'arithmetic_mismatch'
            when {BK} between 60 and 79 then 'ocr_dropout' end as anomaly_type,
       cast(case when {BK} between 0 and 24 or {BK} between 40 and 79 then 1 else 0 end as integer) as is_anomaly,
       lines is not null as has_lines
from orders left join b_sums on l_orderkey = o_orderkey"""

TABLES["b_scores"] = f"""
select receipt_id, submitted_at, anomaly_score,
       cast(case when anomaly_score >= 0.9e0 then 1 else 0 end as integer) as is_flagged
from (select r.receipt_id, r.submitted_at,
             case when {BK} between 40 and 79 then ({HH} % 2000 + 8000) / 10000.0e0
                  else (({HH} * 7919) % 10000) / 10000.0e0 end as anomaly_score
      from b_receipts r join orders on r.receipt_id = 'R' || o_orderkey)"""

TABLES["b_explanations"] = f"""
select receipt_id, factor_1 || ':' || m as top_factors, factor_1, m / 1000.0e0 as factor_1_value
from (select 'R' || o_orderkey as receipt_id,
             case {HH} % 3 when 0 then 'total' when 1 then 'max_qty' else 'tax_is_null' end as factor_1,
             {HH} % 2001 - 1000 as m from orders)"""

TABLES["b_feed"] = """
select 'ST' || lpad(cast(s_suppkey % 10 + 1 as varchar), 3, '0') as store_id,
       timestamp '1995-01-01' + to_days(cast(s_suppkey // 10 as integer) * 120) as effective_from,
       r_name as region,
       case s_suppkey % 3 when 0 then 'express' when 1 then 'standard' else 'supercenter' end as store_format,
       'M' || s_suppkey as manager_id,
       case when s_suppkey < 10 then 'initial_load' when s_suppkey % 3 = 0 then 'remodel'
            when s_suppkey % 3 = 1 then 'district_realignment' else 'manager_change' end as change_reason
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

TABLES["b_tagged"] = f"""
select *, case
  when coalesce(receipt_id, '') = '' or coalesce(user_id, '') = '' or store_id is null
       or submitted_at is null or currency is null or total is null then 'missing_required_field'
  when total <= 0 then 'non_positive_total'
  when store_id not in ({quoted(S.STORES)}) then 'unknown_store'
  when not has_lines then 'empty_items'
  when currency <> 'USD' then 'bad_currency'
  when submitted_at > timestamp '{AS_OF}' then 'future_timestamp' end as quarantine_reason
from b_receipts"""

TABLES["b_clean"] = "select * from b_tagged where quarantine_reason is null"
TABLES["b_quarantine"] = "select * from b_tagged where quarantine_reason is not null"
TABLES["b_clean_items"] = "select i.* from b_items i where receipt_id in (select receipt_id from b_clean)"

TABLES["sl_receipts"] = """
select * exclude (quarantine_reason, has_lines, subtotal, tax, total, is_anomaly),
       submitted_at::date as submitted_date,
       subtotal as reported_subtotal, tax as reported_tax, total as reported_total, is_anomaly as is_anomaly_label
from b_clean"""

TABLES["sl_receipt_items"] = "select *, qty * unit_price as line_amount from b_clean_items"

# The feed with numbered versions; the successor of a version is the one numbered one higher.
TABLES["numbered"] = """
select *, row_number() over (partition by store_id order by effective_from)::integer as version_number from b_feed"""

TABLES["sl_store_versions"] = """
select cur.* exclude (effective_from),
       if(cur.version_number = 1, timestamp '1900-01-01', cur.effective_from) as valid_from,
       ifnull(succ.effective_from, timestamp '9999-12-31') as valid_to,
       succ.version_number is null as is_current
from numbered cur
left join numbered succ on (succ.store_id, succ.version_number) = (cur.store_id, cur.version_number + 1)"""

TABLES["dim_store"] = """
select * exclude (store_id), store_id as store_natural_key, md5(concat_ws('|', store_id, valid_from::varchar)) as store_key
from sl_store_versions"""

TABLES["span"] = "select min(submitted_date) as first_day, max(submitted_date) - min(submitted_date) as length from sl_receipts"

TABLES["dim_date"] = """
select (10000 * extract(year from x) + 100 * extract(month from x) + extract(day from x))::integer as date_key,
       x as calendar_date, extract(year from x)::integer as calendar_year, extract(month from x)::integer as calendar_month,
       extract(day from x)::integer as day_of_month, (isodow(x) % 7)::integer as day_of_week,
       isodow(x) > 5 as is_weekend, left(x::varchar, 7) as year_month
from (select first_day + unnest(range(length + 1))::integer as x from span)"""

TABLES["dim_sku"] = """
select sku as sku_natural_key, md5(sku) as sku_key, arg_max(item_name, item_name) as item_name,
       count(unit_price) as times_sold, quantile_cont(unit_price, 0.5) as median_unit_price,
       quantile_disc(unit_price, 0) as min_unit_price, quantile_disc(unit_price, 1) as max_unit_price
from sl_receipt_items group by all"""

TABLES["rollup"] = f"""
select {xsum('line_amount')} as computed_subtotal, max(unit_price) as max_unit_price, max(qty) as max_qty,
       sum(qty)::bigint as total_qty, count(line_no) as n_items, receipt_id
from sl_receipt_items group by all"""

# Facts in steps: what the lines say, how far the reported total is off, and who scored it.
TABLES["expected"] = "select *, 1.0825e0 * computed_subtotal as computed_total from rollup"

TABLES["compared"] = """
select * exclude (n_items, total_qty, max_qty, max_unit_price),
       ifnull(n_items, 0) as n_items, ifnull(total_qty, 0) as total_qty, ifnull(max_qty, 0) as max_qty,
       ifnull(max_unit_price, 0e0) as max_unit_price, reported_total - computed_total as total_residual
from sl_receipts left join expected using (receipt_id)"""

TABLES["fct_receipt"] = """
select c.* exclude (currency), abs(total_residual) / nullif(computed_total, 0e0) as total_residual_pct,
       ifnull(abs(total_residual) / nullif(computed_total, 0e0) > 0.02e0, false) as fails_reconciliation,
       strftime(submitted_date, '%Y%m%d')::integer as date_key, v.store_key, anomaly_score, is_flagged,
       top_factors, factor_1, factor_1_value
from compared c
left join (select receipt_id, anomaly_score, is_flagged from b_scores) using (receipt_id)
left join b_explanations using (receipt_id)
asof left join (select store_key, store_natural_key as store_id, valid_from from dim_store) v
  on c.store_id = v.store_id and c.submitted_at >= v.valid_from"""

TABLES["fct_receipt_line"] = """
select receipt_id, line_no, sku_key, store_key, date_key, qty, unit_price, line_amount,
       unit_price / nullif(median_unit_price, 0e0) as price_ratio_vs_median
from (select receipt_id, store_key, date_key from fct_receipt)
join sl_receipt_items using (receipt_id)
left join (select sku_natural_key as sku, sku_key, median_unit_price from dim_sku) using (sku)"""

# Facts with the attributes their store had at the time.
TABLES["placed"] = """
select * from fct_receipt left join (select store_key, region, store_format, manager_id from dim_store) using (store_key)"""

TABLES["mart_review_queue"] = """
select receipt_id, submitted_at, store_id, region, store_format, user_id, anomaly_score, top_factors as model_reasoning,
       reported_total, computed_total, total_residual, total_residual_pct, n_items, max_qty, max_unit_price,
       image_quality, fails_reconciliation,
       coalesce(if(image_quality < 0.45e0, 'poor_image', null), if(max_qty >= 40, 'implausible_quantity', null),
                if(total_residual_pct > 0.02e0, 'does_not_reconcile', null),
                if(max_unit_price > 100, 'price_outlier', null), 'behavioural') as rule_based_hint
from placed where is_flagged = 1"""

FAILS = "count(*) filter (fails_reconciliation)"

TABLES["mart_store_health"] = f"""
select submitted_date, store_id, region, store_format, manager_id, count(*) as n_receipts,
       {FAILS} as n_failing_reconciliation, count(*) filter (is_flagged = 1) as n_flagged,
       {rate(FAILS, 'count(*)')} as reconciliation_failure_rate,
       {rate('count(*) filter (is_flagged = 1)', 'count(*)')} as flag_rate,
       {xsum('reported_total')} as gross_amount, {xavg('image_quality')} as avg_image_quality,
       {xavg('anomaly_score')} as avg_anomaly_score
from placed group by all"""

TABLES["daily_clean"] = f"""
select submitted_date, count(*) as n_clean, count(*) filter (is_flagged = 1) as n_flagged,
       {FAILS} as n_failing_reconciliation, {xavg('image_quality')} as avg_image_quality
from fct_receipt group by all"""

TABLES["daily_held"] = "select submitted_at::date as submitted_date, count(*) as n_quarantined from b_quarantine group by all"

TABLES["mart_quality_metrics"] = f"""
select *, {rate('n_quarantined', 'n_clean + n_quarantined')} as quarantine_rate,
       {rate('n_failing_reconciliation', 'n_clean')} as reconciliation_failure_rate, {rate('n_flagged', 'n_clean')} as flag_rate
from (select * replace (ifnull(n_quarantined, 0) as n_quarantined) from daily_clean left join daily_held using (submitted_date))"""

TABLES["store_days"] = f"""
select cast(submitted_at as date) as submitted_date, store_id, count(*) as n_receipts,
       {xsum('total')} as gross_amount, {xavg('image_quality')} as avg_image_quality,
       cast(sum(case when abs(total - sub * 1.0825e0) / greatest(sub * 1.0825e0, 0.01e0) > 0.02e0
                then 1 else 0 end) as bigint) as n_failing_reconciliation,
       {rate("sum(case when abs(total - sub * 1.0825e0) / greatest(sub * 1.0825e0, 0.01e0) > 0.02e0 then 1 else 0 end)", 'count(*)')}
         as reconciliation_failure_rate
from b_receipts r left join (select receipt_id, {xsum('cast(qty as double) * unit_price')} as sub
                             from b_items group by receipt_id) l on l.receipt_id = r.receipt_id
group by cast(submitted_at as date), store_id"""


def with_tables(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``query`` with the table expressions it reaches, in dependency order."""
    pool = {**TABLES, **(extra or {})}
    done: list[str] = []

    def reach(name: str) -> None:
        if name in done:
            return
        for other in pool:
            if other != name and re.search(rf"\b(from|join)\s+{other}\b", pool[name]):
                reach(other)
        if name not in done:
            done.append(name)

    for name in pool:
        if re.search(rf"\b(from|join)\s+{name}\b", query):
            reach(name)
    if not done:
        return query
    return "with " + ",\n".join(f"{n} as ({pool[n]})" for n in done) + "\n" + query
