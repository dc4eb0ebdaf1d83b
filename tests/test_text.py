import pytest

from tallyforge.operators.receipt_text import best_read, parse_receipt_texts, text_to_receipts


def parse(spark, *texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "receipt_id string, text string")
    return [r.asDict(recursive=True) for r in parse_receipt_texts(df).orderBy("receipt_id").collect()]


def test_misread_tax_label_degrades_to_null(spark):
    (p,) = parse(spark, "2 Whole Milk 4.29\n3 Pasta 1.99\nSUBTOTAL 14.55\nTAK 1.20\nTOTAL 15.75")
    assert p["tax"] is None and p["subtotal"] == pytest.approx(14.55) and p["total"] == pytest.approx(15.75)
    assert len(p["items"]) == 2 and p["unparsed"] == ["TAK 1.20"]


def test_total_falls_back_to_the_items(spark):
    (p,) = parse(spark, "2 Whole Milk 4.29\n3 Pasta 1.99")
    assert p["total_was_read"] is False and p["total"] == pytest.approx(14.55 * 1.0825, abs=0.02)


def test_garbage_is_kept(spark):
    (p,) = parse(spark, "~~~ \n \n ????")
    assert p["items"] == [] and p["unparsed"] == ["~~~", "????"]


def test_layouts(spark):
    (p,) = parse(
        spark,
        "BREAD 007225003712 F 2.88 N\r\nGV PARM 16OZ 007874201510 F 4,98 O\nBREAD007225003712F2.88N\n"
        "VISA 12.00\n2x Eggs Large 3.89\nTAX 1 7.000 %  3.26\nTOTAL 10.00\nTOTAL 11.00\nX 1.00",
    )
    got = [(i["name"], i["qty"], i["unit_price"]) for i in p["items"]]
    assert got[0] == ("BREAD", 1, 2.88)
    assert got[1] == ("GV PARM 16OZ", 1, 4.98)
    assert got[2][2] == 2.88 and got[2][0].startswith("BREAD")
    assert ("Eggs Large", 2, 3.89) in got
    assert p["tax"] == 3.26 and p["total"] == 10.0
    assert "VISA 12.00" in p["unparsed"] and "TOTAL 11.00" in p["unparsed"]
    assert p["items"][1]["sku"] == "OCR-GVPARM16"


def test_best_read_prefers_more_items_then_the_first(spark):
    df = spark.createDataFrame(
        [("A", 0, "noise"), ("A", 1, "2 Whole Milk 4.29\n3 Pasta 1.99"), ("A", 2, "3 Pasta 1.99\n2 Whole Milk 4.29"), ("B", 0, "x"), ("B", 1, "y")],
        "receipt_id string, read_id int, text string",
    )
    got = {r["receipt_id"]: (r["read_id"], r["n_item_lines"]) for r in best_read(df).collect()}
    assert got == {"A": (1, 2), "B": (0, 0)}


def test_texts_without_items_are_rejected(spark):
    df = spark.createDataFrame([("A", "2 Whole Milk 4.29\nTOTAL 9.29"), ("B", "???")], "receipt_id string, text string")
    done, rejected = text_to_receipts(df)
    row = done.first()
    assert row["receipt_id"] == "A" and row["tax"] == pytest.approx(0.71) and row["total"] == 9.29
    assert [r["receipt_id"] for r in rejected.collect()] == ["B"]
