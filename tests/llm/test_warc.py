import gzip
import random

import pytest

from tallyforge.llm import warc

SCHEMA = "file string, offset long, length long, digest string"


def replica(seed=0, files=9, each=120):
    rng = random.Random(seed)
    rows = []
    for f in range(files):
        at = 0
        for _ in range(each):
            n = rng.choice([200, 3000, 40000, 900000])
            rows.append((f"f{f}", at, n, f"{rng.random()}"))
            at += n
    return rows


def audit(spark, one, other):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    got = warc.audit(frame(one), frame(other)).collect()
    return {(r.file, r.offset): r.status for r in got}


def test_damage_is_found_and_nothing_else(spark):
    rows = replica()
    copy = [list(r) for r in rows]
    copy[3][3] = "x"
    copy[700][3] = "y"
    copy[701][2] += 1
    gone = copy.pop(500)
    copy.append(["f2", 10**9 * 9, 5, "new"])
    copy.append(["other", 0, 5, "new"])
    want = {
        (rows[3][0], rows[3][1]): "corrupt",
        (rows[700][0], rows[700][1]): "corrupt",
        (rows[701][0], rows[701][1]): "resized",
        (gone[0], gone[1]): "missing",
        ("f2", 10**9 * 9): "extra",
        ("other", 0): "extra",
    }
    assert audit(spark, rows, [tuple(c) for c in copy]) == want


def test_same_nulls_repeats_and_empty(spark):
    rows = replica(files=2, each=20) + [(None, 0, 1, None), ("f0", None, 4, "q"), ("d", 0, 5, "a"), ("d", 0, 5, "a")]
    assert audit(spark, rows, rows[::-1]) == {}
    assert audit(spark, rows, rows[:-1]) == {("d", 0): "resized"}
    assert audit(spark, [], []) == {}
    assert set(audit(spark, rows[:5], []).values()) == {"missing"}


def test_only_differing_branches_are_read(spark):
    rows = replica(files=4, each=50)
    a = warc.leaves(spark.createDataFrame(rows, SCHEMA))
    shape = warc.shape_of(a, a)
    tree = warc.tree(a, shape)
    per_level = {r.level: r["count"] for r in tree.groupBy("level").count().collect()}
    assert per_level[0] == 200 and per_level[shape.depth] == 1
    assert len(warc.roots(tree, shape)) == 1


def test_files(spark, tmp_path):
    parts, at = [], []
    for i, body in enumerate([b"", b"<p>x</p>" * 40000, "é\r\n\r\nWARC/1.1".encode()]):
        at.append(sum(map(len, parts)))
        parts.append(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/%d\r\nContent-Length: %d\r\n\r\n" % (i, len(body)) + body + b"\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    (tmp_path / "c.warc").write_bytes(b"".join(parts)[:-3])
    rows = warc.read_records(spark, str(tmp_path)).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file.rsplit("/", 1)[1], []).append((r.offset, r.length, r.digest, r.target_uri))
    assert [x[0] for x in sorted(by_file["a.warc"])] == at
    assert sorted(by_file["a.warc"]) == sorted(by_file["b.warc.gz"])
    assert len(by_file["c.warc"]) == 2


def test_query_against_every_page(spark):
    import duckdb

    from tallyforge.llm.queries import ORACLES, QUERIES

    at = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.sql(f"create view pages as select * from read_parquet('{at}/pages.parquet')")
    cols = ["page_id", "file", "offset", "status", "length", "copy_length", "digest", "copy_digest"]
    want = con.sql("select " + ", ".join(f'"{c}"' for c in cols) + f" from ({ORACLES['op2_warc_fixity']})").fetchall()
    got = [tuple(r) for r in QUERIES["op2_warc_fixity"](spark, at).select(*cols).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[3] for r in got} == {"missing", "resized", "corrupt"}
