"""Receipt text to line items, one narrow pass: every text is parsed inside its own row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.functions.staging import compute_once
from tallyforge.sources.normalise import complete_receipts

# Line breaks and the patterns that define each kind of line.
LINE_BREAK = r"\r\n|[\n\r\u000B\u000C\u001C\u001D\u001E\u0085\u2028\u2029]"
QTY_LINE = r"^(\d{1,3})\s*[xX@]?\s+([A-Za-z][A-Za-z0-9 .'\-/]{2,30}?)\s+\$?(\d{1,5}[.,]\d{2})\s*$"
NAMED_LINE = (
    r"^([A-Za-z0-9][A-Za-z0-9 .'&\-/]{1,28}?[A-Za-z])\s+(?:\d{6,}\s+)?(?:[A-Z]\s+)?"
    r"\$?(\d{1,5}[.,]\d{2})(?:\s+[A-Z0-9])?\s*$"
)
NOT_AN_ITEM = (
    r"(?i)\b(total|subtotal|tax|change|tend|debit|credit|balance|account|ref|network|approv|purchase|"
    r"items sold|store|manager|phone|savings|cash|visa|master|payment|declin)\b"
)
SUMMARY_MISREAD = r"(?i)^(t[a0o][xk]|[t1][o0]tal|subt[o0]tal|[a-z]?tax|chan[gq]e|tend)\b"
TOTAL_LINE = r"(?i)\b(total|amount due|balance)\b.*?\$?(\d{1,6}[.,]\d{2})"
SUBTOTAL_LINE = r"(?i)\bsub\s*total\b.*?\$?(\d{1,6}[.,]\d{2})"
TAX_LINE = r"(?i)\btax\b\s*\d*\s*(?:[\d.]+\s*%\s*)?\$?(\d{1,6}[.,]\d{2})(?!\s*%)"
MONEY = r"(?<!\d)(\d{1,4}[.,]\d{2})(?!\d)"
LEADING_NAME = r"^(\d{0,3}\s?[A-Za-z][A-Za-z .&/\-]*[A-Za-z0-9])"
MAX_LOOSE_PRICE = 9999


def text_lines(text: Column) -> Column:
    """Trimmed non-blank lines, numbered from 0 over all lines."""
    numbered = F.transform(
        F.split(F.coalesce(text, F.lit("")), LINE_BREAK),
        lambda raw, i: F.struct(i.alias("no"), F.regexp_replace(raw, r"(?U)^\s+|\s+$", "").alias("line")),
    )
    return F.filter(numbered, lambda x: x["line"] != "")


def _money(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def _clean_name(name: Column) -> Column:
    cut = F.trim(F.regexp_replace(name, r"(?s)\s+\d{4,}.*$", ""))
    return F.trim(F.regexp_replace(cut, r"\s+[A-Z]$", ""))


#: Stands between the groups of a matched line; a line that does not match stays as it is.
_CUT = "\u0001"


def _matched(x: Column) -> Column:
    return x.withField("is_other", x["line"].rlike(NOT_AN_ITEM) | x["line"].rlike(SUMMARY_MISREAD))


def _groups(x: Column, pattern: str, groups: int) -> Column:
    """The line with its groups cut apart, if the pattern (which spans the line) matches."""
    return F.regexp_replace(x["line"], F.lit(pattern), F.lit(_CUT.join(f"${i + 1}" for i in range(groups))))


def _part(cut: Column, i: int) -> Column:
    return F.split(cut, _CUT)[i]


def _shape(x: Column) -> Column:
    """Which item layout a line has, if any."""
    return (
        F.when(x["is_other"], "none")
        .when(x["as_qty"] != x["line"], "qty")
        .when(x["as_named"] != x["line"], "named")
        .when(x["line"].rlike(LEADING_NAME), "loose")
        .otherwise("none")
    )


def _raw_price(x: Column) -> Column:
    last = F.try_element_at(F.regexp_extract_all(x["line"], F.lit(MONEY), F.lit(1)), F.lit(-1))
    return _money(
        F.when(x["shape"] == "qty", _part(x["as_qty"], 2)).when(x["shape"] == "named", _part(x["as_named"], 1)).when(x["shape"] == "loose", last)
    )


def _raw_name(x: Column) -> Column:
    return (
        F.when(x["shape"] == "qty", _part(x["as_qty"], 1))
        .when(x["shape"] == "named", _part(x["as_named"], 0))
        .when(x["shape"] == "loose", F.trim(F.regexp_extract(x["line"], LEADING_NAME, 1)))
    )


def _item(x: Column) -> Column:
    sku = F.concat(F.lit("OCR-"), F.substring(F.regexp_replace(F.upper(x["name"]), "[^A-Z0-9]", ""), 1, 8))
    qty = F.when(x["shape"] == "qty", _part(x["as_qty"], 0).try_cast("int")).otherwise(1)
    priced = (x["shape"] != "loose") | ((x["price"] > 0) & (x["price"] <= MAX_LOOSE_PRICE))
    return F.when(
        (F.length(x["name"]) >= 2) & priced,
        F.struct(sku.alias("sku"), x["name"].alias("name"), qty.alias("qty"), x["price"].alias("unit_price")),
    )


def lines_with_items(lines: Column) -> Column:
    """Each line with its item struct, or a null item. Steps pass their results on, so
    no pattern runs twice on a line."""
    other = F.transform(lines, _matched)
    counted = F.transform(other, lambda x: x.withField("as_qty", F.when(~x["is_other"], _groups(x, QTY_LINE, 3))))
    cut = F.transform(
        counted, lambda x: x.withField("as_named", F.when(x["as_qty"] == x["line"], _groups(x, NAMED_LINE, 2)))
    )
    shaped = F.transform(cut, lambda x: x.withField("shape", _shape(x)))
    named = F.transform(
        shaped, lambda x: x.withField("name", _clean_name(_raw_name(x))).withField("price", _raw_price(x))
    )
    return F.transform(
        named, lambda x: F.struct(x["no"].alias("no"), x["line"].alias("line"), _item(x).alias("item"))
    )


def _with_parsed_lines(df: DataFrame, text: str) -> DataFrame:
    flagged = F.transform(
        lines_with_items(text_lines(F.col(text))),
        lambda x: F.struct(
            x["no"].alias("no"),
            x["line"].alias("line"),
            (x["line"].rlike(TOTAL_LINE) & ~F.lower(x["line"]).contains("sub")).alias("is_total"),
            x["line"].rlike(SUBTOTAL_LINE).alias("is_subtotal"),
            x["line"].rlike(TAX_LINE).alias("is_tax"),
            x["item"].alias("item"),
        ),
    )
    return compute_once(df, {"_lines": flagged})


def _first_no(flag: str, *taken: Column) -> Column:
    def free(x):
        keep = x[flag]
        for t in taken:
            keep = keep & ~x["no"].eqNullSafe(t)
        return keep

    return F.array_min(F.transform(F.filter("_lines", free), lambda x: x["no"]))


def _summary_value(no: Column, pattern: str, group: int) -> Column:
    line = F.try_element_at(F.filter("_lines", lambda x: x["no"] == no), F.lit(1))["line"]
    return F.when(no.isNotNull(), _money(F.regexp_extract(line, pattern, group)))


def parse_receipt_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add items, subtotal, tax, total, computed_subtotal and unparsed lines to each text.

    The first total, subtotal and tax line each give their value and are used up;
    later repeats are tried as items. Lines nothing matches are kept in ``unparsed``.
    """
    step = _with_parsed_lines(df, text)
    step = compute_once(step, {"_total_no": _first_no("is_total"), "_sub_no": _first_no("is_subtotal")})
    step = compute_once(step, {"_tax_no": _first_no("is_tax", F.col("_total_no"), F.col("_sub_no"))})
    used = [F.col("_total_no"), F.col("_sub_no"), F.col("_tax_no")]

    def left_over(x):
        keep = F.lit(True)
        for no in used:
            keep = keep & ~x["no"].eqNullSafe(no)
        return keep

    step = compute_once(
        step,
        {
            "_rest": F.filter("_lines", left_over),
            "subtotal": _summary_value(F.col("_sub_no"), SUBTOTAL_LINE, 1),
            "tax": _summary_value(F.col("_tax_no"), TAX_LINE, 1),
            "_read_total": _summary_value(F.col("_total_no"), TOTAL_LINE, 2),
        },
    )
    step = compute_once(
        step,
        {
            "items": F.transform(F.filter("_rest", lambda x: x["item"].isNotNull()), lambda x: x["item"]),
            "unparsed": F.transform(F.filter("_rest", lambda x: x["item"].isNull()), lambda x: x["line"]),
        },
    )
    computed = F.round(
        F.aggregate("items", F.lit(0.0), lambda acc, it: acc + it["qty"].cast("double") * it["unit_price"]), 2
    )
    step = compute_once(step, {"computed_subtotal": computed})
    return step.withColumns(
        {
            "total": F.coalesce(
                "_read_total", F.round(F.col("computed_subtotal") * F.lit(S.TAX_MULTIPLIER), 2)
            ),
            "total_was_read": F.col("_read_total").isNotNull(),
            "tax_was_read": F.col("tax").isNotNull(),
        }
    ).drop("_lines", "_total_no", "_sub_no", "_tax_no", "_rest", "_read_total")


def item_line_count(text: Column) -> Column:
    """How many lines of a text parse as items: the yield of one read."""
    return F.size(F.filter(lines_with_items(text_lines(text)), lambda x: x["item"].isNotNull()))


def best_read(reads: DataFrame) -> DataFrame:
    """The read of each receipt with the most item lines, the earliest on ties."""
    scored = reads.withColumn("n_item_lines", item_line_count(F.col("text")))
    best = F.max_by(
        F.struct("read_id", "n_item_lines", "text"),
        F.struct(F.col("n_item_lines"), (-F.col("read_id")).alias("_first")),
    )
    return scored.groupBy("receipt_id").agg(best.alias("b")).select("receipt_id", "b.*")


def text_to_receipts(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(canonical receipts, texts without a single item). Unread tax is then computed."""
    return complete_receipts(parse_receipt_texts(df, text).drop(text))
