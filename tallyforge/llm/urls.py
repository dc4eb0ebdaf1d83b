"""URL filters: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter.

A listed URL is found by its canonical form. The distinct canonical forms are folded into a blocked
Bloom filter: a block of 256 bits is one row of four longs, a URL sets eight bits of the one block its
hash names. The filter has at most ``max_blocks`` rows (40 bytes each), however long the list is, so it
may be broadcast; a longer list only fills it more and passes more URLs on. Pages it rules out are
settled without a shuffle. The few possible hits go on to an exact join on the canonical form, which
removes the false positives. All of it is DataFrame expressions.

Canonical form: host (A-Z lower-cased, without ``www.``, a default port and a final dot), path without
trailing slashes, and the query's parameters sorted, without tracking ones. Scheme and fragment go.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is in no
list, so the method allows it. Null or malformed list entries are ignored. Every input row gives one
output row, repeated ones too; an empty list allows whatever no rule blocks. All other columns are kept,
but those named host, path, rule, verdict or listed are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
WORDS, BITS_PER_WORD = 4, 2


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Null for a url without ``://``."""
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(host(url), r":(80|443)$", ""), r"\.$", ""), r"^www\.", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(url.contains("://"), F.concat(name, F.regexp_replace(path(url), r"/+$", ""), tail))


def fits(name: Column, at: Column, rule_host: str, rule_path: str) -> Column:
    same = (name == rule_host) | name.endswith("." + rule_host)
    return same & at.startswith(rule_path)


def rule_of(name: Column, at: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict), null if none fits; equal lengths by text."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    if not ordered:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    found = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for rule_host, rule_path, verdict in ordered:
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = found.when(fits(name, at, rule_host, rule_path), value)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """The bits a key sets in each word of its block."""
    bits = F.xxhash64(F.lit(7), key)
    places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS * BITS_PER_WORD)]
    # shiftleft takes its distance as an expression only in SQL form
    one = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places]
    return [one[i * BITS_PER_WORD].bitwiseOR(one[i * BITS_PER_WORD + 1]) for i in range(WORDS)]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w3): the filter of the distinct ``key`` values; blocks without a key have no row."""
    marked = keys.select(_block(F.col(key), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[tuple[str, str, str]],
    url: str = "url",
    listed_url: str = "url",
    bits_per_key: int = 16,
    max_blocks: int = 1 << 16,
) -> DataFrame:
    """``pages`` with host, path, listed boolean, rule (null if none fits) and verdict.

    ``rules`` are (host, path prefix, verdict); the longest that fits decides, else the list does.
    """
    names = settle(listed.select(canonical(F.col(listed_url)).alias("_listed")).where("_listed is not null").distinct())
    blocks = min(max_blocks, max(1, names.count() * bits_per_key // (64 * WORDS) + 1))
    bloom = bloom_blocks(names, "_listed", blocks)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "listed")]
    seen = pages.select(*kept, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), canonical(F.col(url)).alias("_name"))
    asked = seen.withColumn("_block", _block(F.col("_name"), blocks)).join(
        F.broadcast(bloom.withColumnRenamed("block", "_block")), "_block", "left"
    )
    inside = F.lit(True)
    for i, mask in enumerate(_masks(F.col("_name"))):
        inside = inside & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    flagged = asked.select(*kept, "host", "path", "_name", F.coalesce(inside & F.col("_name").isNotNull(), F.lit(False)).alias("_hit"))
    exact = (
        flagged.where("_hit")
        .join(names, F.col("_name") == F.col("_listed"), "left")
        .select(*kept, "host", "path", F.col("_listed").isNotNull().alias("listed"))
    )
    rest = flagged.where("not _hit").select(*kept, "host", "path", F.lit(False).alias("listed"))
    found = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return rest.unionByName(exact).select(
        *kept,
        "host",
        "path",
        "listed",
        found["rule"].alias("rule"),
        F.coalesce(found["verdict"], own).alias("verdict"),
    )
