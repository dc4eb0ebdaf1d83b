"""Registered queries: file and stream sources, sinks, text extraction, defect injection."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import bridge, schemas as S
from tallyforge.bridge import AS_OF, Tables
from tallyforge.catalog.sql import with_tables
from tallyforge.functions.receipts import items_subtotal
from tallyforge.operators import defects, receipt_text, silver
from tallyforge.plans import store_health
from tallyforge.session import free_shuffles, scratch_path
from tallyforge.sources import files, normalise, sinks
from tallyforge.streaming import event_windows, landing

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
EXTRA: dict[str, str] = {}


def register(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql, {**EXTRA, **(extra or {})})
        return fn

    return wrap


EXTRA["folded"] = """
select r.receipt_id, r.user_id, r.store_id, r.submitted_at, r.currency, r.payment_method, r.scanner_version,
       r.image_quality, r.subtotal, r.tax, r.total, coalesce(l.n_items, 0) as n_items, l.first_sku, l.last_qty,
       l.first_price, l.last_price, coalesce(l.names, '') as names
from b_receipts r left join (
  select receipt_id, cast(count(*) as integer) as n_items, arg_min(sku, line_no) as first_sku,
         arg_max(qty, line_no) as last_qty, arg_min(unit_price, line_no) as first_price, arg_max(unit_price, line_no) as last_price,
         string_agg(item_name, '|' order by line_no) as names from b_items group by receipt_id) l on l.receipt_id = r.receipt_id"""

HEAD = "receipt_id, user_id, store_id, submitted_at, currency, payment_method, scanner_version, image_quality"


def summary(receipts):
    """Canonical receipts with the basket reduced to comparable columns."""
    first, last = F.try_element_at("items", F.lit(1)), F.try_element_at("items", F.lit(-1))
    return receipts.select(
        *[c.strip() for c in HEAD.split(",") if c.strip() != "submitted_at"],
        F.col("submitted_at").cast("timestamp_ntz").alias("submitted_at"),
        "subtotal",
        "tax",
        "total",
        F.size("items").cast("int").alias("n_items"),
        first["sku"].alias("first_sku"),
        last["qty"].alias("last_qty"),
        first["unit_price"].alias("first_price"),
        last["unit_price"].alias("last_price"),
        F.array_join(F.transform("items", lambda i: i["name"]), "|").alias("names"),
    )


def canonical(t: Tables):
    return bridge.receipts(t).select(*S.CANONICAL_COLUMNS)


def as_text(receipts):
    """Receipts the way exports carry them: items as a JSON string, ISO timestamps."""
    return receipts.withColumns(
        {
            "items": F.to_json("items"),
            "submitted_at": F.date_format("submitted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        }
    )


# ------------------------------------------------------------- sources ---
@register("source_csv", f"select {HEAD}, subtotal, tax, total, cast(n_items as integer) as n_items, first_sku, last_qty, first_price, last_price, names from folded")
def _(t):
    path = scratch_path(t.spark, "receipts.csv")
    as_text(canonical(t)).write.option("header", True).option("escape", '"').csv(path)
    return summary(files.read_receipts(t.spark, path))


@register("source_json_lines", f"select {HEAD}, subtotal, tax, total, cast(n_items as integer) as n_items, first_sku, last_qty, first_price, last_price, names from folded")
def _(t):
    path = scratch_path(t.spark, "receipts.jsonl")
    canonical(t).withColumn(
        "submitted_at", F.date_format("submitted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).write.option("ignoreNullFields", False).json(path)
    return summary(files.read_receipts(t.spark, path))


@register(
    "normalise_defaults",
    """select 'R' || o_orderkey as receipt_id, 'U000000' as user_id, 'ST001' as store_id, o_orderdate as submitted_at,
              'USD' as currency, 'card' as payment_method, 'v4.0' as scanner_version, 0.9e0 as image_quality,
              0e0 as subtotal, 0e0 as tax, o_totalprice as total, cast(0 as integer) as n_items,
              cast(null as varchar) as first_sku, cast(null as integer) as last_qty, cast(null as double) as first_price,
              cast(null as double) as last_price, '' as names from orders""",
)
def _(t):
    bare = t.orders.select(
        F.concat(F.lit("R"), F.col("o_orderkey")).alias("receipt_id"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.col("o_orderdate").cast("string").alias("submitted_at"),
    )
    return summary(normalise.normalise(bare, check="inline"))


@register(
    "normalise_numbers",
    """select event_id, case when event_type = 'error' then null else value end as total from events""",
)
def _(t):
    raw = t.events.select(
        F.col("event_id").cast("string").alias("receipt_id"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("total"),
        F.col("ts").alias("submitted_at"),
    )
    out = normalise.normalise(raw, check="inline")
    return out.select(F.col("receipt_id").cast("bigint").alias("event_id"), "total")


@register("event_props", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


CENTS = "cast(floor(unit_price * 100.0e0) as bigint)"
FOLD_ROUND = "cast(cents as double) / 100.0e0"
EXTRA["cents_items"] = f"select receipt_id, line_no, sku, item_name, qty, {CENTS} as cents from b_items"


def cents_items(t: Tables):
    items = bridge.items(t)
    return items.withColumn("cents", F.floor(F.col("unit_price") * 100.0).cast("bigint"))


@register(
    "fold_line_items",
    f"""select i.receipt_id, cast(count(*) as integer) as n_items, arg_min(i.sku, i.line_no) as first_sku,
              arg_max(i.qty, i.line_no) as last_qty,
              cast(round(sum(i.qty * i.cents)) as bigint) as subtotal_cents, max(r.store_id) as store_id
       from cents_items i join b_receipts r on r.receipt_id = i.receipt_id group by i.receipt_id""",
)
def _(t):
    lines = cents_items(t).withColumns({"unit_price": F.col("cents") / F.lit(100.0), "_at": F.col("line_no").cast("bigint")})
    heads = bridge.receipt_heads(t).select("receipt_id", "store_id")
    folded = normalise.fold_line_items(lines.drop("cents", "line_no").join(heads, "receipt_id"))
    return folded.select(
        "receipt_id",
        F.size("items").cast("int").alias("n_items"),
        F.col("items")[0]["sku"].alias("first_sku"),
        F.element_at("items", -1)["qty"].alias("last_qty"),
        F.round(F.col("subtotal") * 100).cast("bigint").alias("subtotal_cents"),
        "store_id",
    )


@register(
    "complete_receipts",
    # Filled amounts are cut to cents by either engine's own rounding, so they are compared to the unit.
    """select receipt_id, n_items, cast(floor(coalesce(subtotal, own) + 0.5e0) as bigint) as subtotal_units,
              cast(floor(coalesce(tax, round(round(own, 2) * 0.0825e0, 2)) + 0.5e0) as bigint) as tax_units
       from folded join (select receipt_id, sum(cast(qty as double) * unit_price) as own from b_items group by receipt_id) using (receipt_id)
       where n_items > 0""",
)
def _(t):
    done, _ = normalise.complete_receipts(canonical(t))
    units = lambda c: F.floor(F.col(c) + 0.5).cast("bigint").alias(f"{c}_units")
    return done.select("receipt_id", F.size("items").cast("int").alias("n_items"), units("subtotal"), units("tax"))


@register("rejected_empty_baskets", "select receipt_id from b_receipts where not has_lines")
def _(t):
    _, rejected = normalise.complete_receipts(canonical(t))
    return rejected.select("receipt_id")


# --------------------------------------------------------------- sinks ---
@register("landing_round_trip", "select receipt_id, line_no, sku, item_name, qty, unit_price from b_items")
def _(t):
    root = scratch_path(t.spark, "raw")
    sinks.land({"receipt_items": bridge.items(t)}, root)
    return files.read_landing(t.spark, root, "receipt_items")


@register(
    "store_health_bronze",
    "select submitted_date, store_id, n_receipts, gross_amount, n_failing_reconciliation, reconciliation_failure_rate from store_days",
)
def _(t):
    root = scratch_path(t.spark, "raw")
    sinks.land({"receipts": bridge.receipt_heads(t), "receipt_items": bridge.items(t)}, root)
    out = f"{root}/store_health"
    store_health.run(t.spark, root, bronze_dir=out)
    return files.read_store_health(t.spark, out)


@register(
    "topic_records",
    """select receipt_id as key, receipt_id, strftime(submitted_at, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as submitted_at, total, user_id, store_id,
              currency, payment_method, scanner_version, image_quality, subtotal, tax, cast(n_items as integer) as n_items, names, last_price
       from folded""",
)
def _(t):
    records = sinks.topic_records(canonical(t))
    back = F.from_json(
        "value",
        "receipt_id string, submitted_at string, total double, user_id string, store_id string, currency string, payment_method string, "
        "scanner_version string, image_quality double, subtotal double, tax double, items array<struct<name:string,unit_price:double>>",
    )
    return records.select("key", back.alias("v")).select("key", "v.*").select(
        "*",
        F.size("items").cast("int").alias("n_items"),
        F.array_join(F.transform("items", lambda i: i["name"]), "|").alias("names"),
        F.try_element_at("items", F.lit(-1))["unit_price"].alias("last_price"),
    ).drop("items")


#: Receipts of a wrapped JSON document; one task reads a document whole.
PER_DOCUMENT = 5_000


@register("source_json_wrapper", f"select {HEAD}, subtotal, tax, total, cast(n_items as integer) as n_items, first_sku, last_qty, first_price, last_price, names from folded")
def _(t):
    """The same receipts as JSON documents, each an array of a few thousand at most under one key."""
    path = scratch_path(t.spark, "receipts.json")
    stamped = canonical(t).withColumn("submitted_at", F.date_format("submitted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    n = max(64, t.orders.count() // PER_DOCUMENT)
    parts = stamped.groupBy(F.pmod(F.xxhash64("receipt_id"), F.lit(n)).alias("part")).agg(F.collect_list(F.struct(*stamped.columns)).alias("receipts"))
    documents = parts.select("part", F.to_json(F.struct("receipts"), {"ignoreNullFields": "false"}).alias("value"))
    # dealt by part already; the text itself is large, so it is neither dealt again nor kept plain
    documents.write.partitionBy("part").option("compression", "gzip").text(path)
    free_shuffles(t.spark)
    return summary(files.read_receipts(t.spark, path))


# ----------------------------------------------------------- streaming ---
EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@register("stream_landing", "select event_id, ts, user_id, event_type, value, props from events")
def _(t):
    root = scratch_path(t.spark, "stream")
    good = t.events.select(F.to_json(F.struct(*[F.col(c).cast("timestamp").alias(c) if c == "ts" else F.col(c) for c in EVENT.fieldNames()]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))
    good.write.text(f"{root}/in")
    landing.drain(
        landing.file_source(t.spark, f"{root}/in"), f"{root}/landed", f"{root}/dead", f"{root}/ckpt", EVENT, "event_id"
    )
    landed = landing.read_landed(t.spark, f"{root}/landed", EVENT)
    return landed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register(
    "stream_gate",
    "select receipt_id, quarantine_reason from b_tagged where quarantine_reason is null or quarantine_reason is not null",
)
def _(t):
    root = scratch_path(t.spark, "stream")
    sinks.topic_records(bridge.receipts(t)).select("value").write.text(f"{root}/in")
    landing.drain(
        landing.file_source(t.spark, f"{root}/in"),
        f"{root}/landed",
        f"{root}/dead",
        f"{root}/ckpt",
        gate_as_of=AS_OF,
        quarantine=f"{root}/held",
    )
    clean = landing.read_landed(t.spark, f"{root}/landed").select("receipt_id", F.lit(None).cast("string").alias("quarantine_reason"))
    held_schema = T.StructType(S.LABELLED_RECEIPT.fields + [T.StructField("quarantine_reason", T.StringType())])
    held = landing.read_landed(t.spark, f"{root}/held", held_schema).select("receipt_id", "quarantine_reason")
    return clean.unionByName(held)


@register("stream_dead_letters", "select count(*) as n_dead from events where event_type = 'error'")
def _(t):
    root = scratch_path(t.spark, "stream")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    cut = F.when(F.col("event_type") == "error", F.concat(F.lit("{not json "), F.col("event_id"))).otherwise(line)
    t.events.select(cut.alias("value")).write.text(f"{root}/in")
    landing.drain(
        landing.file_source(t.spark, f"{root}/in"), f"{root}/landed", f"{root}/dead", f"{root}/ckpt", EVENT, "event_id"
    )
    dead = t.spark.read.schema("value string").option("recursiveFileLookup", "true").parquet(f"{root}/dead")
    return dead.agg(F.count(F.lit(1)).alias("n_dead"))


@register(
    "stream_window_counts",
    """select event_type as key, date_trunc('day', ts)::timestamp as window_start, count(*) as n,
              cast(sum(cast(round(coalesce(value, 0) * 10000) as bigint)) as bigint) / 10000e0 as total
       from events group by 1, 2""",
)
def _(t):
    """Days of event time per event type, counted on a stream of files."""
    root = scratch_path(t.spark, "stream")
    as_time = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ts")
    lines = t.events.repartitionByRange(4, "ts").select(F.to_json(F.struct("event_id", as_time, "event_type", "value")).alias("value"))
    lines.write.text(f"{root}/in")
    rows = landing.good(landing.decode(landing.file_source(t.spark, f"{root}/in"), EVENT, "event_id"))
    # All files make one batch, so the watermark is still at its start: the stream must agree with the batch to the row.
    found = event_windows.windowed(rows, F.col("event_type"), F.col("ts"), F.col("event_id"), F.col("value"))
    event_windows.drain_windows(found, f"{root}/out", f"{root}/ckpt")
    return event_windows.window_figures(t.spark, f"{root}/out").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def event_lines(t: Tables, broken: str):
    """Events as JSON lines; those of the type ``broken`` are cut."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    cut = F.when(F.col("event_type") == broken, F.concat(F.lit("{not json "), F.col("event_id"))).otherwise(line)
    return t.events.select(cut.alias("value"))


@register(
    "stream_bounded_drain",
    """select count(*) as received, count(*) filter (event_type <> 'error') as landed, count(*) filter (event_type = 'error') as dead,
              true as first_stopped, true as rest_followed, count(*) filter (event_type <> 'error') as stored from events""",
)
def _(t):
    """A drain that stops at a wanted number and one that takes up the rest; counts as both acknowledge them."""
    root = scratch_path(t.spark, "stream")
    event_lines(t, "error").repartition(4).write.text(f"{root}/in")
    total = t.events.count()

    def drain(**more):
        source = landing.file_source(t.spark, f"{root}/in", max_files=1)
        return landing.drain(source, f"{root}/landed", f"{root}/dead", f"{root}/ckpt", EVENT, "event_id", **more)

    first, rest = drain(enough=max(1, total // 3)), drain()
    stored = landing.read_landed(t.spark, f"{root}/landed", EVENT)
    sums = [getattr(first, f) + getattr(rest, f) for f in ("received", "landed", "dead")]
    told = [*sums, total // 3 <= first.received < total, first.received + rest.received == total]
    return stored.agg(F.count("*").alias("stored")).select(*[F.lit(v).cast("long" if i < 3 else "boolean").alias(n) for i, (n, v) in enumerate(zip(("received", "landed", "dead", "first_stopped", "rest_followed"), told))], "stored")


def deliver(messages, path: str, times: int) -> None:
    """Every message so many times as lines of compressed files; each is made once."""
    messages.select(F.explode(F.array_repeat("value", times)).alias("value")).write.option("compression", "gzip").text(path)


@register("stream_live_dedupe", "select receipt_id from b_receipts")
def _(t):
    """Every message delivered twice, each receipt kept once while the stream runs."""
    root = scratch_path(t.spark, "stream")
    deliver(sinks.topic_records(bridge.receipts(t)), f"{root}/in", times=2)
    rows = landing.without_redeliveries(landing.good(landing.decode(landing.file_source(t.spark, f"{root}/in"))))
    kept = rows.select("receipt_id").writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt")
    kept.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema("receipt_id string").parquet(f"{root}/out")


@register("store_health_single_file", "select *, 1 as n_files from store_days")
def _(t):
    """The job's small aggregate as one part file, read back."""
    path = scratch_path(t.spark, "store_health")
    sinks.write_table(store_health.daily_store_health(bridge.receipt_heads(t), bridge.items(t)), path, single_file=True)
    back = t.spark.read.parquet(path)
    return back.withColumn("n_files", F.lit(len(back.inputFiles())))


# ---------------------------------------------------------------- text ---
def money_text(cents):
    return F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def receipt_texts(t: Tables):
    """Printed form of each order: item lines, then subtotal, tax and total lines."""
    items = cents_items(t)
    line = F.concat_ws(" ", F.col("qty").cast("string"), F.col("item_name"), money_text(F.col("cents")))
    basket = items.groupBy("receipt_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("line_no", line.alias("line")))), lambda x: x["line"]), "\n"
        ).alias("body"),
        F.sum(F.col("qty") * F.col("cents")).alias("sub"),
    )
    tax = F.floor(F.col("sub") * 33 / 400).cast("bigint")
    return basket.select(
        "receipt_id",
        F.concat(
            F.lit("MARKET HALL\n"),
            F.col("body"),
            F.lit("\nSUBTOTAL "),
            money_text(F.col("sub")),
            F.lit("\nTAX 8.25 % "),
            money_text(tax),
            F.lit("\nTOTAL "),
            money_text(F.col("sub") + tax),
            F.lit("\nTHANK YOU"),
        ).alias("text"),
    )


def sql_money(c: str) -> str:
    return f"cast({c} // 100 as varchar) || '.' || lpad(cast({c} % 100 as varchar), 2, '0')"


TAXC = "cast(floor(sub * 33 / 400.0e0) as bigint)"
TEXT_SQL = {
    "texts": f"""select receipt_id, 'MARKET HALL' || chr(10) || body || chr(10) || 'SUBTOTAL ' || {sql_money('sub')}
        || chr(10) || 'TAX 8.25 % ' || {sql_money(TAXC)} || chr(10) || 'TOTAL ' || {sql_money(f'(sub + {TAXC})')} || chr(10) || 'THANK YOU' as text
        from (select receipt_id, string_agg(qty || ' ' || item_name || ' ' || {sql_money('cents')}, chr(10) order by line_no) as body,
              cast(sum(qty * cents) as bigint) as sub from cents_items group by receipt_id)""",
}


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''").replace("\\u", "\\x").replace("\\x0085", "\\x{85}").replace(
        "\\x2028", "\\x{2028}"
    ).replace("\\x2029", "\\x{2029}").replace("\\x00", "\\x") + "'"


RT = receipt_text
TAX_PLAIN = q(RT.TAX_LINE.replace(r"(?!\s*%)", ""))


def money_sql(x: str) -> str:
    return f"try_cast(replace({x}, ',', '.') as double)"


def clean_sql(x: str) -> str:
    return f"trim(regexp_replace(trim(regexp_replace({x}, '(?s)\\s+\\d{{4,}}.*$', '')), '\\s+[A-Z]$', ''))"


def parsed_sql(source: str) -> dict[str, str]:
    """Line parse of ``source(receipt_id, text)`` in SQL."""
    # No look-around here: separators are doubled so neighbouring tokens each keep a boundary.
    doubled = r"regexp_replace(line, '([^0-9])', '\1\1', 'g')"
    token = r"'(?:^|[^0-9])([0-9]{1,4}(?:\.\.|,,)[0-9]{2})(?:[^0-9]|$)'"
    last = f"replace(replace(regexp_extract_all({doubled}, {token}, 1)[-1], '..', '.'), ',,', '.')"
    return {
        "lines0": f"""select receipt_id, unnest(parts) as raw, generate_subscripts(parts, 1) as no from (
            select receipt_id, regexp_split_to_array(text, {q(RT.LINE_BREAK)}) as parts from {source})""",
        "lines1": r"""select * from (select receipt_id, no, regexp_replace(raw, '^\s+|\s+$', '', 'g') as line from lines0) where line <> ''""",
        "lines2": f"""select *, regexp_matches(line, {q(RT.TOTAL_LINE)}) and not contains(lower(line), 'sub') as is_total,
            regexp_matches(line, {q(RT.SUBTOTAL_LINE)}) as is_sub, regexp_matches(line, {TAX_PLAIN}) as is_tax,
            case when regexp_matches(line, {q(RT.NOT_AN_ITEM)}) or regexp_matches(line, {q(RT.SUMMARY_MISREAD)}) then 'none'
                 when regexp_matches(line, {q(RT.QTY_LINE)}) then 'qty'
                 when regexp_matches(line, {q(RT.NAMED_LINE)}) then 'named'
                 when regexp_matches(line, {q(RT.LEADING_NAME)}) and {money_sql(last)} between 0.001 and 9999 then 'loose'
                 else 'none' end as shape from lines1""",
        "lines3": f"""select *, case shape when 'qty' then try_cast(regexp_extract(line, {q(RT.QTY_LINE)}, 1) as integer) else 1 end as qty,
            case shape when 'qty' then {clean_sql(f"regexp_extract(line, {q(RT.QTY_LINE)}, 2)")}
                       when 'named' then {clean_sql(f"regexp_extract(line, {q(RT.NAMED_LINE)}, 1)")}
                       when 'loose' then {clean_sql(f"trim(regexp_extract(line, {q(RT.LEADING_NAME)}, 1))")} end as name,
            case shape when 'qty' then {money_sql(f"regexp_extract(line, {q(RT.QTY_LINE)}, 3)")}
                       when 'named' then {money_sql(f"regexp_extract(line, {q(RT.NAMED_LINE)}, 2)")}
                       when 'loose' then {money_sql(last)} end as price from lines2""",
        "firsts": """select receipt_id, min(no) filter (where is_total) as t, min(no) filter (where is_sub) as s from lines3 group by receipt_id""",
        "firsts2": """select f.receipt_id, f.t, f.s, min(l.no) filter (where l.is_tax and l.no is distinct from f.t and l.no is distinct from f.s) as x
            from firsts f join lines3 l on l.receipt_id = f.receipt_id group by f.receipt_id, f.t, f.s""",
        "rest": """select l.*, length(l.name) >= 2 as is_item from lines3 l join firsts2 f on f.receipt_id = l.receipt_id
            where l.no is distinct from f.t and l.no is distinct from f.s and l.no is distinct from f.x""",
        "parsed": f"""select f.receipt_id, cast(count(r.no) filter (where r.is_item) as integer) as n_items,
            cast(count(r.no) filter (where not coalesce(r.is_item, false)) as integer) as n_unparsed,
            cast(coalesce(sum(round(r.qty * r.price * 100)) filter (where r.is_item), 0) as bigint) as computed_cents,
            max({money_sql(f"regexp_extract(s.line, {q(RT.SUBTOTAL_LINE)}, 1)")}) as subtotal,
            max({money_sql(f"regexp_extract(x.line, {TAX_PLAIN}, 1)")}) as tax,
            max({money_sql(f"regexp_extract(t.line, {q(RT.TOTAL_LINE)}, 2)")}) as read_total, bool_or(t.no is not null) as total_was_read
            from (select distinct receipt_id, t, s, x from {source} left join firsts2 using (receipt_id)) f
            left join rest r on r.receipt_id = f.receipt_id
            left join lines3 t on t.receipt_id = f.receipt_id and t.no = f.t
            left join lines3 s on s.receipt_id = f.receipt_id and s.no = f.s
            left join lines3 x on x.receipt_id = f.receipt_id and x.no = f.x group by f.receipt_id""",
    }


PARSED_COLUMNS = "receipt_id, n_items, n_unparsed, computed_cents, subtotal, tax, read_total, total_was_read"


def parsed(df):
    p = receipt_text.parse_receipt_texts(df)
    return p.select(
        "receipt_id",
        F.size("items").cast("int").alias("n_items"),
        F.size("unparsed").cast("int").alias("n_unparsed"),
        F.round(F.col("computed_subtotal") * 100).cast("bigint").alias("computed_cents"),
        "subtotal",
        "tax",
        F.when(F.col("total_was_read"), F.col("total")).alias("read_total"),
        "total_was_read",
    )


@register("text_receipts", f"select {PARSED_COLUMNS} from parsed", {**TEXT_SQL, **parsed_sql("texts")})
def _(t):
    return parsed(receipt_texts(t))


@register(
    "text_items",
    "select receipt_id, 'OCR-' || left(regexp_replace(upper(name), '[^A-Z0-9]', '', 'g'), 8) as sku, name, qty, price as unit_price "
    "from rest where is_item",
    {**TEXT_SQL, **parsed_sql("texts")},
)
def _(t):
    p = receipt_text.parse_receipt_texts(receipt_texts(t))
    return p.select("receipt_id", F.explode("items").alias("i")).select("receipt_id", "i.*")


DOCS = {"texts": "select cast(doc_id as varchar) as receipt_id, text from documents"}


@register("text_documents", f"select {PARSED_COLUMNS} from parsed", {**DOCS, **parsed_sql("texts")})
def _(t):
    return parsed(t.documents.select(F.col("doc_id").cast("string").alias("receipt_id"), "text"))


@register(
    "text_lines",
    "select receipt_id, cast(no - 1 as integer) as no, line from lines1",
    {**DOCS, **parsed_sql("texts")},
)
def _(t):
    return t.documents.select(
        F.col("doc_id").cast("string").alias("receipt_id"), F.explode(receipt_text.text_lines(F.col("text"))).alias("l")
    ).select("receipt_id", "l.no", "l.line")


@register("text_unparsed", "select receipt_id, line from rest where not coalesce(is_item, false)", {**TEXT_SQL, **parsed_sql("texts")})
def _(t):
    p = receipt_text.parse_receipt_texts(receipt_texts(t))
    return p.select("receipt_id", F.explode("unparsed").alias("line"))


def reads(t: Tables):
    """Three reads of each receipt: without spaces, complete, and complete again."""
    one = receipt_texts(t)
    squeezed = F.regexp_replace("text", " ", "")
    return one.select(
        "receipt_id",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("read_id"), squeezed.alias("text")),
                F.struct(F.lit(1).alias("read_id"), F.col("text").alias("text")),
                F.struct(F.lit(2).alias("read_id"), F.concat(F.col("text"), F.lit("\n")).alias("text")),
            )
        ).alias("r"),
    ).select("receipt_id", "r.*")


EXTRA["read_texts"] = """
select receipt_id || '#' || k as receipt_id, case k when 0 then replace(text, ' ', '') when 1 then text else text || chr(10) end as text
from texts, (select unnest([0, 1, 2]) as k)"""


@register(
    "text_best_read",
    """select split_part(receipt_id, '#', 1) as receipt_id, split_part(receipt_id, '#', 2)::integer as read_id, n::integer as n_item_lines
       from (select receipt_id, count(*) filter (length(name) >= 2) as n from lines3 group by receipt_id)
       qualify row_number() over (partition by split_part(receipt_id, '#', 1) order by n desc, receipt_id) = 1""",
    {**TEXT_SQL, **parsed_sql("read_texts")},
)
def _(t):
    return receipt_text.best_read(reads(t)).select("receipt_id", "read_id", "n_item_lines")


@register(
    "text_to_receipts",
    "select receipt_id, n_items, subtotal, read_total as total, tax is not null as tax_was_read from parsed where n_items > 0",
    {**TEXT_SQL, **parsed_sql("texts")},
)
def _(t):
    source = receipt_texts(t)
    done, _ = receipt_text.text_to_receipts(source)
    read = receipt_text.parse_receipt_texts(source).select("receipt_id", "tax_was_read")
    return done.join(read, "receipt_id").select(
        "receipt_id",
        F.size("items").cast("int").alias("n_items"),
        "subtotal",
        "total",
        "tax_was_read",
    )


# ------------------------------------------------------------- defects ---
def draw_sql(salt: str, i: int) -> str:
    part, at = divmod(i, 4)
    return (
        f"(cast('0x' || substring(md5(receipt_id || ':{salt}42:{part}'), {8 * at + 1}, 8) as bigint) / 4294967296.0e0)"
    )


@register(
    "defect_labels",
    f"""select receipt_id, case when u0 < 0.015e0 then 'malformed_payload'
          when u1 < 0.06e0 and has_lines then (['arithmetic_mismatch', 'impossible_quantity', 'price_outlier', 'timestamp_skew', 'ocr_dropout'])[cast(floor(u2 * 5) as integer) + 1]
          end as anomaly_type
        from (select receipt_id, has_lines, {draw_sql('d', 0)} as u0, {draw_sql('d', 1)} as u1, {draw_sql('d', 2)} as u2 from b_receipts)""",
)
def _(t):
    return defects.inject_defects(bridge.receipts(t)).select("receipt_id", "anomaly_type")


def half_up(x: str) -> str:
    """Two places of a double as written, halves away from zero."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 18)), 2) as double)"


#: Each receipt with its draws and defect, then its lines as the defect leaves them, then its head.
DEFECTS = {
    "d_drawn": f"""select *, {', '.join(f"{draw_sql('d', i)} as u{i}" for i in range(8))} from b_receipts""",
    "d_kinds": f"""select d.*, coalesce(c.n_items, 0) as n_items,
            case when u0 < 0.015e0 then (['unknown_store', 'non_positive_total', 'empty_items', 'bad_currency'])[cast(floor(u2 * 4) as integer) + 1] end as brk,
            case when u0 >= 0.015e0 and u1 < 0.06e0 and c.n_items > 0 then {defects.KINDS!r}[cast(floor(u2 * 5) as integer) + 1] end as kind
        from d_drawn d left join (select receipt_id, count(*) as n_items from b_items group by 1) c on c.receipt_id = d.receipt_id""",
    "d_lines": f"""select i.receipt_id, i.line_no, k.kind,
            case when kind = 'impossible_quantity' and line_no - 1 = floor(u3 * n_items) then cast(floor(u4 * 360) as integer) + 40 else qty end as qty,
            case when kind = 'price_outlier' and line_no - 1 = floor(u3 * n_items)
                then {half_up('unit_price * ([10e0, 100e0, 0.1e0])[cast(floor(u4 * 3) as integer) + 1]')} else unit_price end as unit_price
        from b_items i join d_kinds k on k.receipt_id = i.receipt_id
        where brk is distinct from 'empty_items' and not (coalesce(kind = 'ocr_dropout', false) and u7 < 0.3e0 and line_no > greatest(1, floor(n_items / 2)))""",
    "d_folded": """select receipt_id, count(*) as n_lines, sum(qty) as sum_qty,
            list_reduce(list_prepend(0e0, list(cast(qty as double) * unit_price order by line_no)), lambda a, x: a + x) as amount
        from d_lines group by receipt_id""",
    "d_subtotals": f"""select k.*, coalesce(f.n_lines, 0) as n_lines, coalesce(f.sum_qty, 0) as sum_qty, coalesce(f.amount, 0e0) as amount,
            case when kind in ('impossible_quantity', 'price_outlier') then {half_up('coalesce(f.amount, 0e0)')} end as sub
        from d_kinds k left join d_folded f on f.receipt_id = k.receipt_id""",
    "d_taxed": f"""select *, case when sub is not null then {half_up('sub * 0.0825e0')} end as new_tax,
            case when u3 < 0.5e0 then -1e0 else 1e0 end * (u4 * 0.30e0 + 0.05e0) as drift from d_subtotals""",
    "d_broken": f"""select receipt_id, case when u0 < 0.015e0 then 'malformed_payload' else kind end as anomaly_type,
            case when kind = 'ocr_dropout' and u5 < 0.6e0 then null else coalesce(sub, subtotal) end as subtotal,
            case when kind = 'ocr_dropout' and u6 < 0.5e0 then null when sub is not null then new_tax else tax end as tax,
            case when kind = 'arithmetic_mismatch' then {half_up('greatest(0.01e0, total * (drift + 1e0))')} when sub is not null then {half_up('sub + new_tax')}
                when brk = 'non_positive_total' then case when u3 < 0.5e0 then -abs(total) else 0e0 end else total end as total,
            case when kind = 'ocr_dropout' then {half_up('u4 * 0.37e0 + 0.05e0')} else image_quality end as image_quality,
            case when kind is distinct from 'timestamp_skew' then submitted_at
                when u4 < 0.5e0 then submitted_at + to_seconds(cast(floor((u5 * 198 + 2) * 86400e0) as bigint))
                else submitted_at - to_seconds(cast(floor((u5 * 800 + 400) * 86400e0) as bigint)) end as submitted_at,
            case when brk = 'unknown_store' then 'ZZ' || (cast(floor(u3 * 99) as bigint) + 900)::varchar else store_id end as store_id,
            case when brk = 'bad_currency' then (['EU R', '', 'usd'])[cast(floor(u3 * 3) as integer) + 1] else currency end as currency,
            cast(n_lines as bigint) as n_lines, cast(sum_qty as bigint) as sum_qty, amount from d_taxed""",
}


@register("defect_values", "select * from d_broken", DEFECTS)
def _(t):
    """Every receipt after injection, each corrupted value beside those that must not change."""
    broken = defects.inject_defects(bridge.receipts(t))
    return broken.select(
        "receipt_id", "anomaly_type", "subtotal", "tax", "total", "image_quality", F.col("submitted_at").cast("timestamp_ntz").alias("submitted_at"), "store_id", "currency",
        F.size("items").cast("bigint").alias("n_lines"), F.aggregate("items", F.lit(0).cast("bigint"), lambda a, i: a + i["qty"]).alias("sum_qty"), items_subtotal(F.col("items")).alias("amount"),
    )


@register(
    "defect_injection",
    """select anomaly_type, count(*) as n, count(*) filter (abs(amount * 1.0825e0 - total) > 0.5e0) as n_off, count(*) filter (tax is null) as n_tax_null
       from d_broken group by anomaly_type""",
    DEFECTS,
)
def _(t):
    broken = defects.inject_defects(bridge.receipts(t))
    return broken.groupBy("anomaly_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs(items_subtotal(F.col("items")) * 1.0825 - F.col("total")) > 0.5).alias("n_off"),
        F.count_if(F.col("tax").isNull()).alias("n_tax_null"),
    )


@register(
    "resubmissions",
    f"""select receipt_id, submitted_at, anomaly_type, is_anomaly from b_receipts union all
        select 'R' || left(md5(receipt_id || ':again42'), 12), submitted_at + to_seconds(cast(floor((u1 * 89 + 1) / 1440.0e0 * 86400.0e0) as bigint)),
               'duplicate_submission', cast(1 as integer)
        from (select *, {draw_sql('r', 0)} as u0, {draw_sql('r', 1)} as u1 from b_receipts) where is_anomaly = 0 and u0 < 0.06e0 * 0.35e0""",
)
def _(t):
    out = defects.inject_resubmissions(bridge.receipts(t))
    return out.select("receipt_id", F.col("submitted_at").cast("timestamp_ntz").alias("submitted_at"), "anomaly_type", "is_anomaly")
