"""Data tests: each returns the violating rows, empty means pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.functions.receipts import rate
from tallyforge.operators.ordering import carried, running_totals
from tallyforge.session import settle


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).select(column).distinct()


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent. Child keys fold first, so a hot key is one row in the join."""
    child = df.where(F.col(column).isNotNull()).select(column).distinct()
    known = parent.select(F.col(parent_column).alias("_parent"))
    return child.join(known, child[column] == known["_parent"], "left_anti")


def flagged_have_reasoning(queue: DataFrame) -> DataFrame:
    return queue.where(F.coalesce("model_reasoning", F.lit("")) == "").select("receipt_id")


def fan_out(facts: DataFrame, silver: DataFrame) -> DataFrame:
    """One row of the two counts when they differ."""
    counts = facts.agg(F.count(F.lit(1)).alias("fact_rows"))
    rows = silver.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("silver_rows", rows).where("fact_rows <> silver_rows")


def implausible_flag_rate(facts: DataFrame) -> DataFrame:
    low, high = S.FLAG_RATE_BOUNDS
    n = F.count(F.lit(1))
    return facts.agg(n.alias("n"), rate(F.sum("is_flagged"), n).alias("flag_rate")).where(
        (F.col("flag_rate") < low) | (F.col("flag_rate") > high)
    )


def non_positive_totals(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("reported_total") <= 0).select("receipt_id", "reported_total")


def outside_version(facts: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Facts stamped outside the window of the version they resolved to."""
    dim = dim_store.select("store_key", "valid_from", "valid_to")
    return (
        facts.select("receipt_id", "submitted_at", "store_key")
        .join(dim, "store_key")
        .where((F.col("submitted_at") < F.col("valid_from")) | (F.col("submitted_at") >= F.col("valid_to")))
        .select("receipt_id", "submitted_at", "valid_from", "valid_to")
    )


def quarantined_in_facts(quarantine: DataFrame, facts: DataFrame) -> DataFrame:
    return quarantine.select("receipt_id").join(facts.select("receipt_id"), "receipt_id", "left_semi")


def not_one_current(dim_store: DataFrame) -> DataFrame:
    return (
        dim_store.groupBy("store_natural_key")
        .agg(F.count_if("is_current").alias("n_current"))
        .where("n_current <> 1")
    )


def version_gaps(dim_store: DataFrame) -> DataFrame:
    by_store = Window.partitionBy("store_natural_key").orderBy("valid_from", "version_number")
    following = dim_store.select(
        "store_natural_key", "valid_to", F.lead("valid_from").over(by_store).alias("next_valid_from")
    )
    return following.where("next_valid_from is not null and next_valid_from <> valid_to")


def version_overlaps(dim_store: DataFrame) -> DataFrame:
    """Pairs of versions of one store valid at the same instant, each pair once per direction.

    A sweep in the order of starts, with the latest end so far carried from slice to slice: a version that starts
    at or after it opens a new run, and versions can overlap only within a run. Runs are numbered by a running count
    and pairs made within runs of more than one; a store without overlaps joins nothing, whatever its versions are.
    """
    spans = dim_store.select("store_natural_key", "store_key", "version_number", "valid_from", "valid_to").where("valid_from < valid_to")
    swept = carried(spans, ["store_natural_key"], ["valid_from", "store_key"], "valid_to", "_latest", "max")
    joins = F.coalesce(F.col("valid_from") < F.col("_latest"), F.lit(False))
    # A run that a version joins is known by what it joined; only such runs are looked at again.
    overlapped = settle(swept.withColumn("_joins", joins))
    bad = overlapped.where("_joins").select("store_natural_key").distinct()
    some = overlapped.join(bad, "store_natural_key", "left_semi")
    runs = running_totals(some.withColumn("_o", F.struct("valid_from", "store_key")), ["store_natural_key"], "_o", {"opened": (~F.col("_joins")).cast("int")})
    number = runs.select("store_natural_key", F.col("_o.store_key").alias("store_key"), F.col("_o.valid_from").alias("valid_from"), (F.col("opened_before") + F.col("opened")).alias("_run"))
    placed = some.join(number, ["store_natural_key", "store_key", "valid_from"])
    lone = placed.groupBy("store_natural_key", "_run").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    suspects = placed.join(lone, ["store_natural_key", "_run"])
    a, b = suspects.alias("a"), suspects.alias("b")
    return a.join(
        b,
        (F.col("a.store_natural_key") == F.col("b.store_natural_key"))
        & (F.col("a._run") == F.col("b._run"))
        & (F.col("a.store_key") != F.col("b.store_key"))
        & (F.col("a.valid_from") < F.col("b.valid_to"))
        & (F.col("b.valid_from") < F.col("a.valid_to")),
    ).select(
        F.col("a.store_natural_key").alias("store_natural_key"),
        F.col("a.version_number").alias("v1"),
        F.col("b.version_number").alias("v2"),
    )


def scores_out_of_range(facts: DataFrame) -> DataFrame:
    return facts.where("anomaly_score < 0 or anomaly_score > 1").select("receipt_id", "anomaly_score")


def store_day_failures(facts: DataFrame) -> DataFrame:
    return facts.groupBy("submitted_date", "store_id").agg(
        F.sum(F.col("fails_reconciliation").cast("bigint")).alias("n_fail")
    )


def two_path_agreement(facts: DataFrame, store_day: DataFrame) -> DataFrame:
    """Store-days where the warehouse and the stand-alone job disagree, missing ones included."""
    a = store_day_failures(facts)
    b = store_day.select("submitted_date", "store_id", F.col("n_failing_reconciliation").alias("job_fail"))
    return (
        a.join(b, ["submitted_date", "store_id"], "full")
        .where(~F.col("n_fail").eqNullSafe(F.col("job_fail")))
        .select("submitted_date", "store_id", F.col("n_fail").alias("warehouse_fail"), "job_fail")
    )


def column_tests(
    regions: list[str] = S.REGIONS, formats: list[str] = S.STORE_FORMATS, reasons: list[str] = S.CHANGE_REASONS
) -> list[tuple]:
    """(table, column, kind) of every test of a single column; a list names accepted values, a pair the parent."""
    tests: list[tuple] = []

    def add(table: str, column: str, *kinds):
        tests.extend((table, column, kind) for kind in kinds)

    add("br_quarantine", "quarantine_reason", "not_null", S.QUARANTINE_REASONS)
    add("br_store_master", "store_id", "not_null")
    add("br_store_master", "change_reason", reasons)
    add("sl_receipts", "receipt_id", "not_null", "unique")
    add("sl_receipts", "reported_total", "not_null")
    add("sl_receipts", "currency", S.CURRENCIES)
    add("sl_receipts", "payment_method", S.PAYMENT_METHODS)
    add("sl_receipt_items", "receipt_id", "not_null", ("sl_receipts", "receipt_id"))
    add("sl_receipt_items", "qty", "not_null")
    add("sl_store_versions", "store_id", "not_null")
    add("sl_store_versions", "valid_from", "not_null")
    add("dim_store", "store_key", "not_null", "unique")
    for c in ("store_natural_key", "valid_from", "valid_to"):
        add("dim_store", c, "not_null")
    add("dim_store", "region", regions)
    add("dim_store", "store_format", formats)
    for table, columns in (
        ("dim_date", ("date_key", "calendar_date")),
        ("dim_sku", ("sku_key", "sku_natural_key")),
        ("fct_receipt", ("receipt_id",)),
        ("mart_review_queue", ("receipt_id",)),
        ("mart_quality_metrics", ("submitted_date",)),
    ):
        for c in columns:
            add(table, c, "not_null", "unique")
    add("fct_receipt", "store_key", "not_null", ("dim_store", "store_key"))
    add("fct_receipt", "date_key", "not_null", ("dim_date", "date_key"))
    add("fct_receipt", "anomaly_score", "not_null")
    add("fct_receipt", "computed_total", "not_null")
    add("fct_receipt_line", "sku_key", "not_null", ("dim_sku", "sku_key"))
    add("fct_receipt_line", "store_key", ("dim_store", "store_key"))
    add("mart_review_queue", "model_reasoning", "not_null")
    add("mart_review_queue", "rule_based_hint", S.REVIEW_HINTS)
    add("mart_store_health", "n_receipts", "not_null")
    add("mart_model_slices", "slice", "not_null")
    return tests


def _name(table: str, column: str, kind) -> str:
    return f"{'accepted' if isinstance(kind, list) else 'related' if isinstance(kind, tuple) else kind}_{table}_{column}"


def _across_tables(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tests that need more than one row or table at a time."""
    facts, dim = t["fct_receipt"], t["dim_store"]
    checks = {
        "outside_version": outside_version(facts, dim),
        "quarantined_in_facts": quarantined_in_facts(t["br_quarantine"], facts),
        "not_one_current": not_one_current(dim),
        "version_gaps": version_gaps(dim),
        "version_overlaps": version_overlaps(dim),
    }
    if "br_spark_store_health" in t:
        checks["two_path_agreement"] = two_path_agreement(facts, t["br_spark_store_health"])
    return checks


def warehouse_checks(t: dict[str, DataFrame], *lists: list[str], **named: list[str]) -> dict[str, DataFrame]:
    """Every check of the warehouse by name, as its violating rows, over a dict of its tables."""
    checks: dict[str, DataFrame] = {}
    for table, column, kind in column_tests(*lists, **named):
        if kind == "not_null":
            found = not_null(t[table], column)
        elif kind == "unique":
            found = unique(t[table], column)
        elif isinstance(kind, list):
            found = accepted_values(t[table], column, kind)
        else:
            found = relationships(t[table], column, t[kind[0]], kind[1])
        checks[_name(table, column, kind)] = found
    checks["flagged_have_reasoning"] = flagged_have_reasoning(t["mart_review_queue"])
    checks["fan_out"] = fan_out(t["fct_receipt"], t["sl_receipts"])
    checks["implausible_flag_rate"] = implausible_flag_rate(t["fct_receipt"])
    checks["non_positive_totals"] = non_positive_totals(t["fct_receipt"])
    checks["scores_out_of_range"] = scores_out_of_range(t["fct_receipt"])
    return {**checks, **_across_tables(t)}


def table_counts(df: DataFrame, rows: dict[str, Column], keys: dict[str, str]) -> DataFrame:
    """(check_name, n_violations) of all tests of one table from one scan.

    ``rows`` are conditions that violating rows meet; ``keys`` name columns that must be unique and count their
    repeated values. Row tests are added up along with the groups of the first key; further keys fold on their own.
    """
    flags = {f"r{i}": F.coalesce(c, F.lit(False)).cast("long") for i, c in enumerate(rows.values())}
    names = dict(zip(flags, rows))
    if keys:
        (first, key), *others = keys.items()
        folded = df.groupBy(key).agg(F.count("*").alias("_n"), *[F.sum(c).alias(n) for n, c in flags.items()])
        repeated = F.count_if((F.col("_n") > 1) & F.col(key).isNotNull())
        totals = folded.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in flags], repeated.alias("k"))
        names["k"] = first
    else:
        others = []
        totals = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in flags.items()])
    spelt = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    out = totals.unpivot([], list(names), "test", "n_violations").select(spelt[F.col("test")].alias("check_name"), "n_violations")
    for name, key in others:
        out = out.unionByName(unique(df, key).agg(F.lit(name).alias("check_name"), F.count("*").alias("n_violations")))
    return out


def warehouse_counts(t: dict[str, DataFrame], *lists: list[str], **named: list[str]) -> DataFrame:
    """(check_name, n_violations) of every check, each table scanned once for all that one row can tell.

    Accepted values count violating rows here; ``warehouse_checks`` gives the values and rows of a failed check.
    """
    facts = t["fct_receipt"]
    rows: dict[str, dict[str, Column]] = {"fct_receipt": {}, "mart_review_queue": {}, "sl_receipts": {}}
    keys: dict[str, dict[str, str]] = {}
    apart = _across_tables(t)
    for table, column, kind in column_tests(*lists, **named):
        name = _name(table, column, kind)
        if kind == "unique":
            keys.setdefault(table, {})[name] = column
        elif isinstance(kind, tuple):
            apart[name] = relationships(t[table], column, t[kind[0]], kind[1])
        else:
            test = F.col(column).isNull() if kind == "not_null" else ~F.col(column).isin(kind)
            rows.setdefault(table, {})[name] = test
    rows["mart_review_queue"]["flagged_have_reasoning"] = F.coalesce("model_reasoning", F.lit("")) == ""
    rows["fct_receipt"]["non_positive_totals"] = F.col("reported_total") <= 0
    rows["fct_receipt"]["scores_out_of_range"] = (F.col("anomaly_score") < 0) | (F.col("anomaly_score") > 1)
    rows["fct_receipt"] |= {"_facts": F.lit(True), "_flagged": F.col("is_flagged") == 1}
    rows["sl_receipts"]["_silver"] = F.lit(True)
    counted = [table_counts(t[table], rows.get(table, {}), keys.get(table, {})) for table in dict.fromkeys([*rows, *keys])]
    found = settle(reduce(DataFrame.unionByName, counted))
    of = lambda name: F.max(F.when(F.col("check_name") == name, F.col("n_violations")))
    low, high = S.FLAG_RATE_BOUNDS
    share = rate(of("_flagged"), of("_facts"))
    whole = found.agg(
        F.coalesce(of("_facts") != of("_silver"), F.lit(True)).cast("long").alias("fan_out"),
        F.coalesce((share < low) | (share > high), F.lit(False)).cast("long").alias("implausible_flag_rate"),
    ).unpivot([], ["fan_out", "implausible_flag_rate"], "check_name", "n_violations")
    return found.where("check_name not like '\\_%'").unionByName(whole).unionByName(check_counts(apart))


def check_counts(checks: dict[str, DataFrame]) -> DataFrame:
    """(check_name, n_violations) as one frame; each check contributes one counted row."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, rows)
