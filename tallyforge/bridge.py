"""The shared test tables (orders, lineitem, ...) seen as receipts.

Values are derived with whole-number arithmetic so another engine can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.session import prepare

AS_OF = "2001-08-02 00:00:00"


class Tables:
    """The test tables of one scale folder; each is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = prepare(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        setattr(self, name, df)
        return df


def _hash(key: str) -> Column:
    return (F.col(key) * 48271) % 2147483647


def items(t: Tables) -> DataFrame:
    """Line items: receipt_id, line_no, sku, item_name, qty, unit_price."""
    li = t.lineitem.withColumn("receipt_id", F.concat(F.lit("R"), F.col("l_orderkey")))
    # by the id that later steps group and join on, so that lines are dealt once
    position = Window.partitionBy("receipt_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    named = t.part.select("p_partkey", "p_name")
    return li.join(named, li["l_partkey"] == named["p_partkey"], "left").select(
        "receipt_id",
        F.row_number().over(position).alias("line_no"),
        F.concat(F.lit("SKU"), F.col("l_partkey")).alias("sku"),
        F.col("p_name").alias("item_name"),
        F.floor("l_quantity").cast("int").alias("qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


def _receipt_columns(t: Tables) -> DataFrame:
    sums = t.lineitem.groupBy("l_orderkey").agg(
        (F.sum(F.round(F.col("l_extendedprice") * 100.0).cast("bigint")).cast("double") / 100.0).alias("_lines")
    )
    o = t.orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    hashed = o.selectExpr("*", "(o_orderkey * 48271) % 2147483647 as hh", "(o_orderkey * 48271) % 2147483647 % 1000 as bk")
    return hashed.selectExpr(
        "o_orderkey as _key",
        "concat('R', o_orderkey) as receipt_id",
        "case when bk > 4 then concat('U', o_custkey) end as user_id",
        "case when bk between 5 and 9 then 'ZZ900' "
        "else concat('ST', lpad(cast(o_orderkey % 10 + 1 as string), 3, '0')) end as store_id",
        "cast(o_orderdate + make_dt_interval(case when bk between 20 and 24 then 3000 else 0 end, 0, 0, "
        "cast(hh % 86400 as decimal(18,6))) as timestamp) as submitted_at",
        "case when bk between 10 and 14 then 'usd' else 'USD' end as currency",
        "case o_orderpriority when '1-URGENT' then 'ebt' when '2-HIGH' then 'wallet' when '3-MEDIUM' then 'cash' "
        "else 'card' end as payment_method",
        "concat('v', hh % 4 + 1) as scanner_version",
        "case when bk between 60 and 79 then (hh % 38 + 5) / 100.0D else (hh % 51 + 50) / 100.0D end as image_quality",
        "case when bk not between 60 and 71 then _lines end as subtotal",
        "case when bk not between 66 and 79 then _lines * 0.0825D end as tax",
        "case when bk between 15 and 19 then -o_totalprice when _lines is null then o_totalprice "
        "when bk between 40 and 59 then _lines * 1.25D else _lines * 1.0825D end as total",
        "case when bk between 0 and 24 then 'malformed_payload' when bk between 40 and 59 then 'arithmetic_mismatch' "
        "when bk between 60 and 79 then 'ocr_dropout' end as anomaly_type",
        "cast(bk between 0 and 24 or bk between 40 and 79 as int) as is_anomaly",
        "case when bk between 40 and 79 then (hh % 2000 + 8000) / 10000.0D else ((hh * 7919) % 10000) / 10000.0D end as _score",
        "_lines is not null as _has_lines",
    )


def receipt_heads(t: Tables) -> DataFrame:
    """Receipts without their item arrays, for jobs that only need the header."""
    return _receipt_columns(t).drop("_key", "_score", "_has_lines")


def receipts(t: Tables) -> DataFrame:
    """Nested receipts: items in line order, empty where the order has no line."""
    basket = (
        items(t)
        .groupBy("receipt_id")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "sku", "item_name", "qty", "unit_price"))).alias("_l"))
        .select(
            F.col("receipt_id"),
            F.transform(
                "_l",
                lambda x: F.struct(
                    x["sku"].alias("sku"),
                    x["item_name"].alias("name"),
                    x["qty"].alias("qty"),
                    x["unit_price"].alias("unit_price"),
                ),
            ).alias("items"),
        )
    )
    head = receipt_heads(t)
    empty = F.array().cast("array<struct<sku:string,name:string,qty:int,unit_price:double>>")
    return head.join(basket, "receipt_id", "left").select(
        *[c for c in head.columns if c not in ("subtotal", "tax", "total", "anomaly_type", "is_anomaly")],
        F.coalesce("items", empty).alias("items"),
        "subtotal",
        "tax",
        "total",
        "anomaly_type",
        "is_anomaly",
    )


def flat_receipts(t: Tables) -> DataFrame:
    """Headers with a one-element stand-in for the basket: enough for the contract rules."""
    cols = _receipt_columns(t)
    return cols.withColumn("items", F.when(F.col("_has_lines"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))).drop(
        "_key", "_score", "_has_lines"
    )


def scores(t: Tables) -> DataFrame:
    """A score per receipt that depends on the tables only."""
    cols = _receipt_columns(t)
    return cols.select(
        "receipt_id",
        F.col("submitted_at").cast("timestamp_ntz").alias("submitted_at"),
        F.col("_score").alias("anomaly_score"),
        (F.col("_score") >= 0.9).cast("int").alias("is_flagged"),
    )


def explanations(t: Tables) -> DataFrame:
    hh = _hash("o_orderkey")
    factor = F.element_at(F.array(F.lit("total"), F.lit("max_qty"), F.lit("tax_is_null")), (hh % 3 + 1).cast("int"))
    value = (hh % 2001 - 1000) / F.lit(1000.0)
    return t.orders.select(
        F.concat(F.lit("R"), F.col("o_orderkey")).alias("receipt_id"),
        F.concat(factor, F.lit(":"), (hh % 2001 - 1000).cast("string")).alias("top_factors"),
        factor.alias("factor_1"),
        value.alias("factor_1_value"),
    )


def store_feed(t: Tables) -> DataFrame:
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("ST"), F.lpad((key % 10 + 1).cast("string"), 3, "0")).alias("store_id"),
        (
            F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(days=(F.floor(key / 10) * 120).cast("int"))
        ).alias("effective_from"),
        F.col("r_name").alias("region"),
        F.when(key % 3 == 0, "express").when(key % 3 == 1, "standard").otherwise("supercenter").alias("store_format"),
        F.concat(F.lit("M"), key).alias("manager_id"),
        F.when(key < 10, "initial_load")
        .when(key % 3 == 0, "remodel")
        .when(key % 3 == 1, "district_realignment")
        .otherwise("manager_change")
        .alias("change_reason"),
    )
