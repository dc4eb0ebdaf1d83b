"""Registered queries of the corpus operators and their DuckDB SQL, where SQL can state the result."""

from __future__ import annotations

import importlib.util
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import align, bpe, digest, forest, jaccard, langid, license, mixing, quality, repair, topk, urls, warc
from tallyforge.llm.common import remainder
from tallyforge.session import settle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def tokenizers():
    """The module that names the public vocabulary files; its folder is a parameter."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        folder = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
        spec = importlib.util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
        public_tokenizers = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(public_tokenizers)
        sys.modules["public_tokenizers"] = public_tokenizers
    return public_tokenizers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@register("op1_byte_bpe")
def _(spark, sf_dir):
    names = tokenizers()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, names.path("byte_bpe_multi_50k.tiktoken"), names.PATTERN)


# ------------------------------------------------------------- WARC fixity ---
def page_records(pages: DataFrame) -> DataFrame:
    """Pages as records of archive files of 500 page ids each, and what a damaged copy holds of them.

    The damage follows from the ids: some records have a byte flipped, some are cut short, some are gone.
    Repeated page ids follow each other by url and html; pages without id go to files by their url.
    """
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 7), 16, 10).cast("bigint")
    body = F.coalesce(F.col("html"), F.lit(""))
    hurt = (
        F.when(draw % 97 == 5, F.concat(F.lit("#"), F.substring(body, 2, 2147483647)))
        .when(draw % 389 == 7, F.substring(body, 1, 40))
        .otherwise(body)
    )
    file = F.when(F.col("page_id").isNull(), F.concat(F.lit("pages-x"), F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 2)))
    whole, damaged = warc.record(F.col("url"), body), warc.record(F.col("url"), hurt)
    return pages.select(
        "page_id",
        F.coalesce(file, F.concat(F.lit("pages-"), F.floor(F.col("page_id") / 500).cast("string"))).alias("file"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.octet_length(whole).cast("bigint").alias("length"),
        F.sha2(whole, 256).alias("digest"),
        F.octet_length(damaged).cast("bigint").alias("copy_length"),
        F.sha2(damaged, 256).alias("copy_digest"),
        (draw % 997 == 3).alias("gone"),
    )


@register(
    "op2_warc_fixity",
    r"""
with draws as (
    select page_id, coalesce(url, '') as url, coalesce(html, '') as body,
        ('0x' || substring(md5(coalesce(page_id::varchar, '')), 1, 7))::bigint as draw
    from pages),
hurts as (
    select *, case when draw % 97 = 5 then '#' || substring(body, 2) when draw % 389 = 7 then substring(body, 1, 40) else body end as hurt,
        case when page_id is null then 'pages-x' || substring(md5(url), 1, 2) else 'pages-' || floor(page_id / 500)::bigint::varchar end as file
    from draws),
wholes as (
    select page_id, url, draw, file,
        'WARC/1.1' || e || 'WARC-Type: response' || e || 'WARC-Target-URI: ' || url || e || 'Content-Type: text/html' || e
            || 'Content-Length: ' || strlen(body)::varchar || e || e || body || e || e as whole,
        'WARC/1.1' || e || 'WARC-Type: response' || e || 'WARC-Target-URI: ' || url || e || 'Content-Type: text/html' || e
            || 'Content-Length: ' || strlen(hurt)::varchar || e || e || hurt || e || e as other
    from hurts, (select chr(13) || chr(10) as e)),
rows_ as (
    select *, coalesce(sum(strlen(whole)) over (partition by file order by page_id nulls first, url, sha256(whole)
        rows between unbounded preceding and 1 preceding), 0)::bigint as start
    from wholes)
select page_id, file, start as "offset",
    case when draw % 997 = 3 then 'missing' when strlen(whole) <> strlen(other) then 'resized' else 'corrupt' end as status,
    strlen(whole)::bigint as length, case when draw % 997 <> 3 then strlen(other)::bigint end as copy_length,
    sha256(whole) as digest, case when draw % 997 <> 3 then sha256(other) end as copy_digest
from rows_ where draw % 997 = 3 or whole <> other
""",
)
def _(spark, sf_dir):
    rows = settle(warc.placed(page_records(table(spark, sf_dir, "pages")), "file", ["page_id", "url", "digest"]))
    copy = rows.where("not gone").select("file", "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest"))
    found = warc.audit(rows.select("file", "offset", "length", "digest"), copy)
    return found.join(rows.select("file", "offset", "page_id"), ["file", "offset"]).select("page_id", *found.columns)


# ------------------------------------------------------------- URL filter ---
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Host labels whose pages make the list (fixed values of this query).
UNWANTED = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


@register(
    "op6_url_filter",
    r"""
with parts as (
    select page_id, url,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
        regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1) as query
    from pages),
named as (
    select *, case when contains(url, '://') then
        regexp_replace(regexp_replace(regexp_replace(host, ':(80|443)$', ''), '\.$', ''), '^www\.', '')
        || regexp_replace(path, '/+$', '')
        || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'),
            lambda p: p <> '' and not regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&'), ''), '') end as name
    from parts),
listed as (
    select distinct name from named
    where len(list_intersect(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])) > 0),
rules(rule, rh, rp, verdict) as (values
    ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
    ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block'))
select page_id, host, path,
    (select r.rule from rules r where (host = r.rh or ends_with(host, '.' || r.rh)) and starts_with(path, r.rp) order by length(r.rule) desc limit 1) as rule,
    name in (select name from listed) and name is not null as listed,
    coalesce((select r.verdict from rules r where (host = r.rh or ends_with(host, '.' || r.rh)) and starts_with(path, r.rp) order by length(r.rule) desc limit 1),
        case when name in (select name from listed) then 'block' else 'allow' end) as verdict
from named
""",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = F.split(urls.host(F.col("url")), r"\.")
    listed = pages.where(F.arrays_overlap(labels, F.array(*[F.lit(u) for u in UNWANTED])))
    return urls.judge(pages, listed, RULES).select("page_id", "host", "path", "rule", "listed", "verdict")


# ------------------------------------------------------------- mixing ---
WEIGHTS = [3, 1, 2]


@register(
    "op8_mixing",
    r"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        md5(coalesce(doc_id::varchar, '') || ' ' || md5(coalesce(text, ''))) as key
    from documents),
sources as (
    select source, sum(size)::bigint as source_size, [3, 1, 2][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int] as w
    from sized group by source),
ratio as (select *, 2e0 * source_size as cap, 2e0 * source_size / w as ratio from sources),
levels as (
    select *, row_number() over o as place,
        (1.5e0 * sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0e0))
            / sum(w) over (o rows between current row and unbounded following) as level
    from ratio window o as (order by ratio, source is null, source)),
served as (select min(place) as place, arg_min(level, place) as level from levels where level <= ratio),
target as (
    select l.source, source_size, least(cap, case when s.place is null or l.place < s.place then cap else w * s.level end) as target
    from levels l left join served s on true),
budget as (
    select *, floor(target + 0.5e0)::bigint as b, case when source_size > 0 then floor(target + 0.5e0)::bigint // source_size else 0 end as epochs
    from target),
run as (
    select s.doc_id, s.source, s.size, s.key, b.source_size, b.target, b.epochs, b.b - b.epochs * b.source_size as rest,
        coalesce(sum(s.size) over (partition by s.source order by s.key range between unbounded preceding and current row), 0) as upto,
        sum(s.size) over (partition by s.source, s.key) as own,
        count(*) over (partition by s.source, s.key) as twins
    from sized s join budget b on s.source is not distinct from b.source),
part as (
    select *, case when upto < rest then size
        when upto - own < rest and rest <= upto and own > 0 then floor((rest - (upto - own)) / twins)::bigint
        when upto = rest and own = 0 and rest > 0 then 0 else 0 end as partial
    from run)
select doc_id, source, size, source_size, target, (epochs * size + partial)::bigint as taken,
    (epochs + case when partial > 0 and 2 * partial >= size then 1 else 0 end)::int as copies
from part
""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, WEIGHTS).select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


# ------------------------------------------------------------- licences ---
@register("op10_license_scan")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license.scan(docs, license.train(docs))


# ------------------------------------------------------------- similarity join ---
@register("op4_ngram_jaccard")
def _(spark, sf_dir):
    return jaccard.join_components(table(spark, sf_dir, "documents"), width=4, percent=85)


# ------------------------------------------------------------- language ---
@register("op3_language_id")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = remainder("doc_id", 5) == 0
    models = langid.train(docs.where(~held))
    asked = docs.select("doc_id", "text", held.alias("held_out"))
    return langid.predict(asked, models, keep_text=False)


# ------------------------------------------------------------- quality ---
@register("op9_quality_attention")
def _(spark, sf_dir):
    held = remainder("doc_id", 3) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held)
    return quality.score(docs.withColumn("held_out", held), quality.train(docs, labels), keep_text=False)


# ------------------------------------------------------------- fingerprints ---
@register("op5_quartile_digest")
def _(spark, sf_dir):
    return digest.against_next(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------- neighbours ---
@register("op7_prefix_forest")
def _(spark, sf_dir):
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# ------------------------------------------------------------- exact top-k ---
@register(
    "op12_exact_topk",
    r"""
with usable as (
    select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.row, q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score, c.row as other
    from usable q join usable c on q.row <> c.row and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by row order by score desc, vec_id nulls last, other) as rank from scored)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
""",
)
def _(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# ------------------------------------------------------------- two tokenizers ---
@register("op11_token_alignment")
def _(spark, sf_dir):
    names = tokenizers()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.measure(docs, names.path("byte_bpe_50k.json"), names.path("piece_bpe_32k.model"), names.PATTERN)


# ------------------------------------------------------------- conversations ---
@register(
    "op13_conversation_repair",
    r"""
with recursive crc as (
    select [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) for i in range(256)] as t),
source as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as id
    from conversations),
drawn as (
    select conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295::bigint], [ascii(c)::bigint for c in string_split(id, '')]),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as draw
    from source, crc),
hurt as (
    select conv_id, turn, case when draw = 4 then 'user' else role end as role,
        case when draw = 1 then '' when draw = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(case when draw = 0 then []::int[] when draw = 3 then [1, 2] else [1] end) as copy
    from drawn),
placed as (
    select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as trimmed,
        row_number() over (partition by conv_id order by turn nulls first, role, text[1:64], md5(strlen(role)::varchar || ':' || role || text), copy) as pos
    from hurt),
judged as (
    select conv_id, turn, role, text, pos, role[1:1] as i,
        case when trimmed = '' then 'blank'
            when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
            when trimmed[-1:] not in ('.', '!', '?') then 'truncated' else '' end as fault,
        lag(role[1:1]) over (partition by conv_id order by pos) as before
    from placed),
walk as (
    select conv_id, 0::bigint as pos, {'c': 0::bigint, 's': '', 'o': []::varchar[]} as e, {'c': 1000000000::bigint, 's': '~', 'o': []::varchar[]} as s,
        {'c': 3::bigint, 's': 'I', 'o': ['user:']} as u, {'c': 6::bigint, 's': 'II', 'o': ['user:', 'assistant:']} as a
    from (select distinct conv_id from conversations)
    union all
    select conv_id, pos, e, s, u, least(a, {'c': u.c + 3, 's': u.s || 'I', 'o': list_append(u.o, 'assistant:')}) as a
    from (
        select conv_id, pos, e, s, a, least(u, {'c': e.c + 3, 's': e.s || 'I', 'o': list_append(e.o, 'user:')},
            {'c': s.c + 3, 's': s.s || 'I', 'o': list_append(s.o, 'user:')}, {'c': a.c + 3, 's': a.s || 'I', 'o': list_append(a.o, 'user:')}) as u
        from (
            select w.conv_id, j.pos, {'c': w.e.c + 4, 's': w.e.s || 'D', 'o': w.e.o} as e,
                least({'c': w.s.c + 4, 's': w.s.s || 'D', 'o': w.s.o},
                    {'c': w.e.c + pen + case when i = 's' then 0 else 1000000000 end, 's': w.e.s || 'K', 'o': list_append(w.e.o, role || ':' || text)}) as s,
                least({'c': w.u.c + 4, 's': w.u.s || 'D', 'o': w.u.o},
                    {'c': w.e.c + pen + case when i = 'u' then 0 else 1000000000 end, 's': w.e.s || 'K', 'o': list_append(w.e.o, role || ':' || text)},
                    {'c': w.s.c + pen + case when i = 'u' then 0 else 1000000000 end, 's': w.s.s || 'K', 'o': list_append(w.s.o, role || ':' || text)},
                    {'c': w.a.c + pen + case when i = 'u' then 0 else 1000000000 end, 's': w.a.s || 'K', 'o': list_append(w.a.o, role || ':' || text)},
                    {'c': w.e.c + pen + 3, 's': w.e.s || 'R', 'o': list_append(w.e.o, 'user:' || text)},
                    {'c': w.s.c + pen + 3, 's': w.s.s || 'R', 'o': list_append(w.s.o, 'user:' || text)},
                    {'c': w.a.c + pen + 3, 's': w.a.s || 'R', 'o': list_append(w.a.o, 'user:' || text)}) as u,
                least({'c': w.a.c + 4, 's': w.a.s || 'D', 'o': w.a.o},
                    {'c': w.u.c + pen + case when i = 'a' then 0 else 1000000000 end, 's': w.u.s || 'K', 'o': list_append(w.u.o, role || ':' || text)},
                    {'c': w.u.c + pen + 3, 's': w.u.s || 'R', 'o': list_append(w.u.o, 'assistant:' || text)}) as a
            from walk w join (select *, case fault when 'truncated' then 3 when '' then 0 else 1000000000 end as pen from judged) j
                on j.conv_id is not distinct from w.conv_id and j.pos = w.pos + 1))),
ended as (select conv_id, arg_max(least(e, a), pos) as best from walk group by conv_id),
counted as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
        count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (before is not null and before || i not in ('su', 'ua', 'au')) as illegal
    from judged group by conv_id)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
    coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, best.c::bigint as cost, best.s as audit,
    sha256(array_to_string(best.o, chr(10))) as repaired_sha256
from ended e left join counted c on c.conv_id is not distinct from e.conv_id
""",
)
def _(spark, sf_dir):
    return repair.digests(repair.repair(repair.damaged(table(spark, sf_dir, "conversations"))))
