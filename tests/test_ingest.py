import json

import pytest
from samples import ITEMS

from tallyforge import schemas as S
from tallyforge.operators.contract import split_quarantine
from tallyforge.sources.files import read_json, read_receipts
from tallyforge.sources.normalise import IngestError, complete_receipts, fold_line_items, normalise, orphan_lines
from tallyforge.sources.sinks import topic_records


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


ONE = {"receipt_id": "R1", "store_id": "ST001", "total": 15.75, "submitted_at": "2026-06-20T10:00:00Z", "items": ITEMS}


def test_json_array_object_and_wrapper_give_canonical_rows(spark, tmp_path):
    for i, doc in enumerate(([ONE], ONE, {"receipts": [ONE, {**ONE, "receipt_id": "R2"}]})):
        df = read_receipts(spark, put(tmp_path, f"x{i}.json", json.dumps(doc)))
        assert df.columns == S.CANONICAL_COLUMNS
        rows = df.orderBy("receipt_id").collect()
        assert len(rows) == (2 if i == 2 else 1)
        assert rows[0]["items"][0]["sku"] == "SKU1001" and rows[0]["items"][1]["qty"] == 3
        assert rows[0]["subtotal"] == pytest.approx(14.55) and rows[0]["tax"] == pytest.approx(1.2)


def test_json_lines(spark, tmp_path):
    text = "\n".join(json.dumps({**ONE, "receipt_id": f"R{i}"}) for i in range(3))
    assert read_receipts(spark, put(tmp_path, "x.ndjson", text)).count() == 3


def test_csv_with_items_as_json_text(spark, tmp_path):
    quoted = json.dumps(ITEMS).replace('"', '""')
    text = f'receipt_id,store_id,total,submitted_at,items\nR1,ST001,15.75,2026-06-20T10:00:00Z,"{quoted}"\n'
    row = read_receipts(spark, put(tmp_path, "x.csv", text)).first()
    assert len(row["items"]) == 2 and row["total"] == 15.75


def test_line_grain_folds_to_receipts(spark, tmp_path):
    text = (
        "receipt_id,sku,item_name,qty,unit_price,store_id\n"
        "R1,SKU1,Milk,2,4.29,ST001\nR1,SKU2,Pasta,3,1.99,ST009\nR2,SKU1,Milk,1.9,4.29,ST002\n"
    )
    rows = {r["receipt_id"]: r for r in read_receipts(spark, put(tmp_path, "x.csv", text)).collect()}
    assert set(rows) == {"R1", "R2"}
    assert rows["R1"]["subtotal"] == pytest.approx(14.55)
    assert rows["R1"]["store_id"] == "ST001" and [i["sku"] for i in rows["R1"]["items"]] == ["SKU1", "SKU2"]
    assert rows["R2"]["items"][0]["qty"] == 1
    assert rows["R1"]["total"] == pytest.approx(15.75)


def test_absent_columns_are_defaulted_and_nulls_kept(spark):
    df = normalise(spark.createDataFrame([("R1", "9.99", None)], "receipt_id string, total string, user_id string"))
    row = df.first()
    assert row["currency"] == "USD" and row["payment_method"] == "card" and row["submitted_at"] is not None
    assert row["user_id"] is None and row["items"] == [] and row["total"] == 9.99


def test_errors_say_what_is_wrong(spark, tmp_path):
    with pytest.raises(IngestError, match="receipt_id"):
        read_receipts(spark, put(tmp_path, "a.json", json.dumps([{"total": 1.0}])))
    with pytest.raises(IngestError, match="empty"):
        read_receipts(spark, put(tmp_path, "b.csv", ""))
    with pytest.raises(IngestError, match=r"\.csv"):
        read_receipts(spark, put(tmp_path, "c.txt", "x"))
    with pytest.raises(IngestError, match="JSON"):
        read_receipts(spark, put(tmp_path, "d.csv", 'receipt_id,total,items\nR1,1.0,"not json"\n'))
    with pytest.raises(IngestError, match="list"):
        read_receipts(spark, put(tmp_path, "e.csv", 'receipt_id,total,items\nR1,1.0,"{""sku"":""a""}"\n'))
    with pytest.raises(IngestError, match="submitted_at"):
        read_receipts(spark, put(tmp_path, "f.csv", "receipt_id,total,submitted_at\nR1,1.0,soon\n"))
    with pytest.raises(IngestError, match="no rows"):
        read_receipts(spark, put(tmp_path, "g.csv", "receipt_id,total\n"))
    with pytest.raises(IngestError, match="cannot be parsed"):
        read_receipts(spark, put(tmp_path, "h.jsonl", "{broken\n"))


def test_lines_without_an_id_do_not_become_one_receipt(spark):
    lines = spark.createDataFrame([("R1", 1, 2.0), (None, 1, 3.0), (None, 2, 4.0)], "receipt_id string, qty int, unit_price double")
    assert [r["receipt_id"] for r in fold_line_items(lines).collect()] == ["R1"]
    assert orphan_lines(lines).count() == 2


def test_inline_check_raises_from_the_job(spark):
    bad = spark.createDataFrame([("R1", "1", "soon")], "receipt_id string, total string, submitted_at string")
    with pytest.raises(Exception, match="submitted_at"):
        normalise(bad, check="inline").collect()


def test_upload_takes_the_gate_like_any_batch(spark, tmp_path):
    doc = [{**ONE, "receipt_id": "R_OK"}, {**ONE, "receipt_id": "R_BAD", "store_id": "ZZ999"}]
    df = read_receipts(spark, put(tmp_path, "x.json", json.dumps(doc)))
    clean, held = split_quarantine(df, "2026-06-30 00:00:00")
    assert [r["receipt_id"] for r in clean.collect()] == ["R_OK"]
    assert held.first()["quarantine_reason"] == "unknown_store"


def test_complete_receipts_fills_from_items_and_rejects_empty(spark):
    items = [(i["sku"], i["name"], i["qty"], i["unit_price"]) for i in ITEMS]
    df = spark.createDataFrame(
        [("A", items, None, None, 15.75), ("B", [], 1.0, 1.0, 2.0)],
        "receipt_id string, items array<struct<sku:string,name:string,qty:int,unit_price:double>>, subtotal double, tax double, total double",
    )
    done, rejected = complete_receipts(df)
    row = done.first()
    assert done.columns == S.CANONICAL_COLUMNS and row["subtotal"] == pytest.approx(14.55) and row["tax"] == pytest.approx(1.2)
    assert [r["receipt_id"] for r in rejected.collect()] == ["B"]


def test_topic_record_key_and_payload(spark, tmp_path):
    df = read_receipts(spark, put(tmp_path, "x.json", json.dumps([ONE])))
    rec = topic_records(df).first()
    body = json.loads(rec["value"])
    assert rec["key"] == body["receipt_id"] == "R1"
    assert set(S.CANONICAL_COLUMNS) <= set(body) and body["submitted_at"].startswith("2026-06-20T10:00:00")
    assert body["total"] == 15.75


def test_fold_needs_its_columns(spark):
    with pytest.raises(IngestError, match="qty"):
        fold_line_items(spark.createDataFrame([("a",)], "receipt_id string"))


def test_json_reader_takes_a_schema(spark, tmp_path):
    path = put(tmp_path, "x.jsonl", json.dumps({"receipt_id": "a", "total": 1.5}))
    schema = S.T.StructType([S.RECEIPT["receipt_id"], S.RECEIPT["total"]])
    assert read_json(spark, path, schema=schema, lines=True).first()["total"] == 1.5


def test_wrapped_json_is_read_about_as_fast_as_lines(spark, tmp_path):
    """Numbers of a document keep their text without a look into the file for each."""
    import time

    item = '{"sku": "007", "name": "x", "qty": 1, "unit_price": 1.50}'
    rows = ['{"receipt_id": %d, "total": 1.50, "submitted_at": "2024-01-01T00:00:00Z", "items": [%s]}' % (i, ",".join([item] * 8)) for i in range(6000)]
    (tmp_path / "w.json").write_text('{"receipts": [%s]}' % ",\n".join(rows))
    (tmp_path / "l.jsonl").write_text("\n".join(rows))
    took = []
    for name, lines in (("l.jsonl", True), ("w.json", False), ("l.jsonl", True), ("w.json", False)):
        began = time.time()
        got = read_json(spark, str(tmp_path / name), lines=lines).where("receipt_id = '5999'").collect()
        took.append(time.time() - began)
        assert [(r.receipt_id, r.total, r["items"][7].unit_price, r["items"][7].sku) for r in got] == [("5999", "1.50", "1.50", "007")]
    assert took[3] < 3 * took[2] + 1


def test_documents_are_whole_or_refused(spark, tmp_path):
    text = '[{"receipt_id": "\u0101\u0100\u0201",\r\n "total": 1.50}, {"receipt_id": "b", "total": 2}]'
    for encoding in ("utf-8", "utf-8-sig", "utf-16-le", "utf-32-be"):
        (tmp_path / f"{encoding}.json").write_bytes(text.encode(encoding))
        df = lambda: read_json(spark, str(tmp_path / f"{encoding}.json")).collect()
        if encoding.startswith("utf-8"):
            assert [(r.receipt_id, r.total) for r in df()] == [("\u0101\u0100\u0201", "1.50"), ("b", "2")]
        else:
            with pytest.raises(Exception):
                df()


def test_wrapped_documents_are_kept_small_and_dealt_once(spark, tables):
    """The text of all receipts is written compressed, by the tasks that collected the documents."""
    from pathlib import Path

    from tallyforge.catalog import ingest
    from tallyforge.session import shared_dir

    held = lambda: set(Path(shared_dir(spark).removeprefix("file:"), "tallyforge").glob("*/receipts.json"))
    before = held()
    got = ingest.QUERIES["source_json_wrapper"](spark, tables.dir)
    assert got.count() == tables.orders.count()
    (path,) = held() - before
    files = list(path.glob("part=*/part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)
