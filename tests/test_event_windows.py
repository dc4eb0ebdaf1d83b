import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.streaming import event_windows, landing

ROW = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType())])


def put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03}.txt"
    path.write_text("".join(json.dumps(dict(zip(("event_id", "ts", "k", "v"), r))) + "\n" for r in rows))
    os.utime(path, (1_780_000_000 + number,) * 2)  # files are taken in the order of their times


def run(spark, root, salts=2):
    rows = landing.good(landing.decode(landing.file_source(spark, str(root / "in"), max_files=1), ROW, "event_id"))
    found = event_windows.windowed(rows, F.col("k"), F.col("ts"), F.col("event_id"), F.col("v"), late_after="2 hours", salts=salts)
    event_windows.drain_windows(found, str(root / "out"), str(root / "ckpt"))
    figures = {(r.key, r.window_start.day): (r.n, r.total) for r in event_windows.window_figures(spark, str(root / "out")).collect()}
    return figures, sorted(int(r.id) for r in event_windows.late_rows(spark, str(root / "out")).collect())


def test_late_rows_restart_and_updates(spark, tmp_path):
    at = lambda day, hour: f"2026-06-{day:02}T{hour:02}:00:00Z"
    put(tmp_path / "in", 0, [(1, at(1, 10), "a", 1.5), (2, at(1, 23), "a", 2.25), (3, at(1, 9), "b", None), (4, None, "a", 7.0), (5, at(1, 8), None, 1.0)])
    figures, late = run(spark, tmp_path)
    assert figures == {("a", 1): (2, 3.75), ("b", 1): (1, 0.0), (None, 1): (1, 1.0)} and late == [4]
    # within two hours of the newest row: day 1 is still open, after a restart too
    put(tmp_path / "in", 1, [(6, at(2, 1), "a", 1.0), (7, at(1, 20), "a", 1.0)])
    put(tmp_path / "in", 2, [(8, at(1, 21), "a", 0.25), (9, at(2, 3), "b", 1.0)])
    figures, late = run(spark, tmp_path)
    assert figures[("a", 1)] == (4, 5.0) and figures[("a", 2)] == (1, 1.0) and late == [4]
    # the watermark has passed midnight: day 1 is closed for every key, also one not seen before
    put(tmp_path / "in", 3, [(10, at(2, 12), "a", 1.0)])
    put(tmp_path / "in", 4, [(11, at(1, 22), "a", 9.0), (12, at(1, 22), "new", 9.0), (13, at(2, 5), "a", 1.0)])
    figures, late = run(spark, tmp_path)
    assert figures[("a", 1)] == (4, 5.0) and figures[("a", 2)] == (3, 3.0) and ("new", 1) not in figures
    assert late == [4, 11, 12]
    assert run(spark, tmp_path) == (figures, late)
    times = {int(r.id): r.ts for r in event_windows.late_rows(spark, str(tmp_path / "out")).collect()}
    assert times[4] is None and times[11].replace(tzinfo=dt.timezone.utc).day == 1


def test_one_key_with_nearly_all_rows(spark, tmp_path):
    rows = [(i, f"2026-06-{1 + i % 3:02}T{i % 24:02}:00:00Z", "hot" if i % 50 else "cold", 0.0001 * i) for i in range(3000)]
    put(tmp_path / "in", 0, rows)
    figures, late = run(spark, tmp_path, salts=8)
    want = {}
    for i, ts, k, v in rows:
        n, units = want.get((k, int(ts[8:10])), (0, 0))
        want[(k, int(ts[8:10]))] = (n + 1, units + i)
    assert figures == {k: (n, units / 10_000) for k, (n, units) in want.items()} and late == []
