import json

import pytest
from pyspark.sql import functions as F

from tallyforge import bridge, schemas as S
from tallyforge.bridge import AS_OF
from tallyforge.catalog import ingest
from tallyforge.catalog.analytics import trained
from tallyforge.operators import attribution, defects, features, model
from tallyforge.plans import batch, scoring
from tallyforge.session import settle
from tallyforge.sources.sinks import topic_records
from tallyforge.streaming import landing


@pytest.fixture(scope="module")
def messages(spark, tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("stream")
    topic_records(bridge.receipts(tables)).select("value").repartition(3).write.text(str(root / "in"))
    (root / "in" / "broken.txt").write_text('{"receipt_id": "X1", "total"\n{"total": 3.0}\n')
    return root


def test_messages_are_made_once_and_delivered_twice(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)
    rows = spark.range(40).rdd.map(lambda r: (made.add(1), (f"message {r.id}" if r.id else None,))[1])
    ingest.deliver(spark.createDataFrame(rows, "value string"), str(tmp_path / "in"), 2)
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "in")).collect())
    assert got == sorted([f"message {i}" if i else "" for i in range(40)] * 2) and made.value == 40
    assert {p.suffix for p in (tmp_path / "in").glob("part-*")} == {".gz"}


def test_drain_lands_every_receipt_once(spark, tables, messages):
    run = lambda: landing.drain(
        landing.file_source(spark, str(messages / "in"), max_files=2), str(messages / "landed"), str(messages / "dead"), str(messages / "ckpt")
    )
    n = bridge.receipt_heads(tables).count()
    first = run()
    assert (first.received, first.landed, first.dead) == (n + 2, n, 2)
    again = run()
    assert (again.received, again.landed) == (0, 0)
    landed = landing.read_landed(spark, str(messages / "landed"))
    assert landed.schema.fieldNames() == S.LABELLED_RECEIPT.fieldNames() == bridge.receipts(tables).columns
    both = landed.select("receipt_id", F.col("total").alias("l")).join(bridge.receipt_heads(tables).select("receipt_id", "total"), "receipt_id")
    assert landed.count() == n and both.where("l = total").count() == n


def test_failed_write_commits_nothing(spark, messages, tmp_path):
    blocker = tmp_path / "landed"
    blocker.write_text("a file where the folder should be")
    source = lambda: landing.file_source(spark, str(messages / "in"))
    with pytest.raises(Exception):  # noqa: B017
        landing.drain(source(), str(blocker), str(tmp_path / "dead"), str(tmp_path / "ckpt"))
    blocker.unlink()
    done = landing.drain(source(), str(blocker), str(tmp_path / "dead"), str(tmp_path / "ckpt"))
    assert done.landed > 0 and done.dead == 2


def test_redeliveries_inside_the_watermark_are_dropped(spark, tables, tmp_path):
    lines = topic_records(bridge.receipts(tables)).select("value")
    lines.unionByName(lines).write.text(str(tmp_path / "in"))
    decoded = landing.good(landing.decode(landing.file_source(spark, str(tmp_path / "in"))))
    query = (
        landing.without_redeliveries(decoded)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("receipt_id").distinct().count() == bridge.receipt_heads(tables).count()


def test_skewed_stamps_are_kept_by_the_live_dedupe(spark, tmp_path):
    stamps = {"a": "2026-06-01T10:00:00Z", "b": "2025-06-01T10:00:00Z", "c": "2029-01-01T00:00:00Z"}
    for i, (rid, at) in enumerate([*stamps.items(), ("b", stamps["b"])]):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.txt").write_text(json.dumps({"receipt_id": rid, "submitted_at": at, "total": 1.0}) + "\n")
    rows = landing.good(landing.decode(landing.file_source(spark, str(tmp_path / "in"), max_files=1)))
    query = landing.without_redeliveries(rows).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(r["receipt_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_drain_stops_at_enough_and_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(6):
        (tmp_path / "in" / f"{i}.txt").write_text(f'{{"receipt_id": "r{i}", "total": 1.0}}\n')
    run = lambda ckpt, **more: landing.drain(
        landing.file_source(spark, str(tmp_path / "in"), max_files=1), str(tmp_path / "landed"), str(tmp_path / "dead"), str(tmp_path / ckpt), **more
    )
    first = run("one", enough=2)
    rest = run("one")
    assert (first.received, rest.received) == (2, 4)
    assert landing.read_landed(spark, str(tmp_path / "landed")).count() == 6
    assert run("two").landed == 6
    assert landing.read_landed(spark, str(tmp_path / "landed")).count() == 12


def test_defects_are_labelled_and_replayable(spark, tables):
    base = bridge.receipts(tables)
    one = defects.inject_defects(base, anomaly_rate=0.5, malformed_rate=0.1)
    kinds = {r[0]: r[1] for r in one.groupBy("anomaly_type").count().collect()}
    assert set(defects.KINDS) | {"malformed_payload", None} == set(kinds)
    assert one.where("is_anomaly = 1 and anomaly_type is null").isEmpty() and one.count() == base.count()
    assert one.select("receipt_id", "total").exceptAll(defects.inject_defects(base.repartition(7), 0.5, 0.1).select("receipt_id", "total")).isEmpty()
    qty = one.where("anomaly_type = 'impossible_quantity'").select(F.array_max(F.transform("items", lambda i: i["qty"])).alias("q"), "subtotal", "total").collect()
    assert all(r["q"] >= 40 and r["total"] == pytest.approx(r["subtotal"] * 1.0825, abs=0.02) for r in qty)
    more = defects.inject_resubmissions(base, rate=0.3)
    extra = more.count() - base.count()
    assert 0 < extra < base.count() and more.where("anomaly_type = 'duplicate_submission'").count() == extra


def test_model_scores_and_reasons(spark, tables):
    feats, fitted = trained(tables)
    m = fitted.metrics
    assert m["n_train"] + m["n_test"] == feats.count() and 0 <= m["pr_auc"] <= 1 and m["pr_auc"] > m["positive_rate_test"]
    assert fitted.threshold == round(fitted.threshold, 4) == m["threshold"]
    scored = model.score(fitted, feats)
    assert scored.where("anomaly_score < 0 or anomaly_score > 1").isEmpty()
    raw = feats.select("receipt_id", fitted.booster.margin().alias("margin"))
    values = settle(attribution.attributions(fitted.booster, feats))
    total = F.col("base_value") + F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    assert raw.join(values, "receipt_id").agg(F.max(F.abs(F.col("margin") - total))).first()[0] < 1e-9
    told = attribution.explain_values(values)
    assert told.where(~F.col("top_factors").rlike(r"[+-]")).isEmpty() and told.select("top_factors").distinct().count() > 1
    glob = attribution.mean_abs(values).collect()
    assert {r["feature"] for r in glob} == set(S.FEATURE_COLUMNS)
    means = [r["mean_abs_shap"] for r in glob]
    assert means == sorted(means, reverse=True)
    out = scoring.score_batch(bridge.receipts(tables), fitted)
    assert out.scored.count() == out.clean.count() and out.held.count() > 0


def test_shares_match_the_plain_shapley_sum():
    kept = [0.3, 0.8, 0.5]
    table = attribution._shares(2.0, kept)
    for pattern in range(8):
        met = [(pattern >> g) & 1 for g in range(3)]
        value = 2.0 * met[0] * met[1] * met[2]
        assert table[pattern].sum() == pytest.approx(value - 2.0 * 0.3 * 0.8 * 0.5)


def test_whole_batch(spark, tables, tmp_path):
    broken = defects.inject_resubmissions(defects.inject_defects(bridge.receipts(tables), seed=7), seed=7)
    summary = batch.run(spark, settle(broken), bridge.store_feed(tables), str(tmp_path), as_of=AS_OF, rounds=3)
    assert summary["n_receipts_clean"] + summary["n_receipts_quarantined"] == broken.count()
    stored = json.loads("".join(r[0] for r in spark.read.text(str(tmp_path / "artifacts/run_summary")).collect()))
    assert stored["gate"] == summary["gate"] and set(stored["drift"]["feature_psi"]) == set(S.FEATURE_COLUMNS)
    queue = spark.read.parquet(str(tmp_path / "warehouse/mart_review_queue"))
    assert queue.where("model_reasoning is null").isEmpty()
    report = spark.read.json(str(tmp_path / "artifacts/drift_report")).first()
    assert report["fairness_passed"] == summary["fairness_passed"]
    with pytest.raises(batch.GateFailed):
        batch.run(spark, broken.limit(5), bridge.store_feed(tables), str(tmp_path), as_of=AS_OF, strict=True)
    reused = model.load(spark, str(tmp_path / "artifacts/model"))
    assert reused.threshold == summary["metrics"]["threshold"]
