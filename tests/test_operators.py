"""Operators on clock-change days, gaps and other edges."""

from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch import sources, streaming
from tidewatch.functions import timegrid as tg
from tidewatch.operators import baselines, calibration, capacity, cleaning, evaluation, features, ladder, quality

D = dt.date


def at(text):
    return dt.datetime.fromisoformat(text)


def series(spark, start, n, step=60, name="price", f=float):
    a = at(start)
    return spark.createDataFrame([(a + dt.timedelta(minutes=step * i), f(i)) for i in range(n)], f"ts timestamp_ntz, {name} double")


def days(spark, *texts):
    return spark.createDataFrame([(D.fromisoformat(x),) for x in texts], "day date")


@pytest.mark.parametrize(("day", "hours"), [("2024-03-31", 23), ("2025-10-26", 25), ("2026-10-25", 25), ("2025-03-30", 23), ("2024-06-01", 24)])
def test_spine_follows_the_clock(spark, day, hours):
    assert tg.spine(days(spark, day), 60).count() == hours
    assert tg.spine(days(spark, day), 15).count() == 4 * hours


def test_gate_on_clock_change(spark):
    r = days(spark, "2025-10-27", "2025-10-20").orderBy("day").select(tg.gate_closure(F.col("day")).alias("e"), tg.gate_closure(F.col("day"), wall_clock=True).alias("w")).collect()
    assert r[0].e == r[0].w == at("2025-10-19 10:00")
    assert (r[1].e, r[1].w) == (at("2025-10-26 10:00"), at("2025-10-26 11:00"))


def test_holidays(spark):
    got = days(spark, "2024-03-29", "2024-04-01", "2024-05-09", "2024-05-20", "2024-10-03", "2024-04-02").select("day", tg.is_nationwide_holiday(F.col("day")).alias("h")).collect()
    assert [r.h for r in sorted(got)] == [True, True, True, True, True, False][:1] + [True, False, True, True, True]


def test_bounded_ffill_is_elapsed_time(spark):
    df = spark.createDataFrame([(at("2024-01-01 00:00"), 1.0), (at("2024-01-01 02:00"), None), (at("2024-01-01 03:00"), None), (at("2024-01-01 23:00"), 2.0), (at("2024-01-02 01:00"), None)], "ts timestamp_ntz, v double")
    for by in ((), ("k",)):
        got = cleaning.bounded_ffill(df.withColumn("k", F.lit(1)), "v", 2, by=by).orderBy("ts").collect()
        assert [r.v_filled for r in got] == [1.0, 1.0, None, 2.0, 2.0]


def test_weighted_mean_falls_back(spark):
    df = spark.createDataFrame([("a", 10.0, 1.0), ("a", 20.0, 3.0), ("b", 10.0, None), ("b", 20.0, 3.0), ("c", 10.0, 0.0), ("c", 20.0, 0.0)], "k string, p double, w double")
    got = {r.k: r.v for r in df.groupBy("k").agg(cleaning.weighted_mean(F.col("p"), F.col("w")).alias("v")).collect()}
    assert got == {"a": 17.5, "b": 15.0, "c": 15.0}


def test_drop_columns_and_redaction(spark):
    df = spark.createDataFrame([("GET ?token=abc&x=1",)], "s string")
    with pytest.raises(ValueError, match="nope"):
        cleaning.drop_columns(df, ["nope"])
    assert df.select(cleaning.redact(F.col("s"))).first()[0] == "GET ?token=***&x=1"


def test_lags_keep_gaps_and_knowledge(spark):
    df = series(spark, "2024-01-01", 48).where(F.hour("ts") != 5)
    got = features.lags(df, "price", (24,))
    assert got.count() == 46 and got.where(F.hour("ts") == 5).count() == 0
    assert features.leaks(got).count() == 0
    late = features.lags(df.withColumnRenamed("price", "load"), "load", (1,))
    assert [r.feature for r in features.leaks(late).collect()] == ["load_lag_1"]
    with pytest.raises(features.LeakageError):
        features.build_matrix(late, ["load_lag_1"])
    with pytest.raises(KeyError):
        features.availability_of("unheard_of")


def test_rolling_mean_needs_a_full_window(spark):
    got = features.rolling_mean(series(spark, "2024-01-01", 30), "price", 24, 24).where("value IS NOT NULL").orderBy("ts").collect()
    assert [r.value for r in got] == [11.5 + i for i in range(7)] and got[0].ts == at("2024-01-02 23:00")


def test_persistence_over_clock_changes(spark):
    df = series(spark, "2025-10-24 22:00", 24 + 25 + 24)  # local days 25, 26 (25 hours) and 27
    got = baselines.persistence(df, "price", df.select("ts"))
    assert got.where("day = '2025-10-26' AND p IS NOT NULL").count() == 25
    assert got.where("day = '2025-10-27' AND p IS NOT NULL").count() == 24
    spring = series(spark, "2024-03-29 23:00", 24 + 23 + 24)
    assert baselines.persistence(spring, "price", spring.select("ts")).where("day = '2024-04-01' AND p IS NULL").count() == 1
    assert baselines.complete_days(baselines.persistence(spring, "price", spring.select("ts"))).select("day").distinct().count() == 1


def test_shape_adds_up_to_nothing(spark):
    q = series(spark, "2024-01-01 23:00", 96 * 10, 15, f=lambda i: 50.0 + (5, -5, 3, -3)[i % 4])
    shape = baselines.shape_profile(q, "price", 7, 3)
    assert {round(r.s, 9) for r in shape.groupBy("day", "hour").agg(F.sum("delta").alias("s")).collect()} == {0.0}
    assert [round(r.delta, 6) for r in shape.where("day = '2024-01-10' AND hour = 7").orderBy("quarter").collect()] == [5, -5, 3, -3]


def test_folds(spark):
    d = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i),) for i in range(10)], "day date")
    roll = baselines.folds(d, 3)
    assert roll.count() == 7 and baselines.folds(d, None).count() == 9
    assert baselines.train_rows(roll, d, 3).groupBy("fold_day").count().select("count").distinct().collect() == [(3,)]


def test_reference_day(spark):
    targets = days(spark, "2024-05-01", "2024-05-15", "2024-05-13")
    whole = days(spark, *[str(D(2024, 4, 1) + dt.timedelta(days=i)) for i in range(60)])
    got = {str(r.day): str(r.reference) for r in ladder.choose_reference_day(targets, whole).collect()}
    assert got == {"2024-05-01": "2024-04-28", "2024-05-15": "2024-05-14", "2024-05-13": "2024-05-06"}
    assert all(r.reference is None for r in ladder.choose_reference_day(targets, whole.where("false")).collect())


def test_patch_on_clock_change(spark):
    src = series(spark, "2025-10-18 22:00", 24, name="load")
    got = ladder.patched(src, "load", spark.createDataFrame([(D(2025, 10, 26), D(2025, 10, 19))], "day date, reference date")).orderBy("ts").collect()
    assert [r.value for r in got] == [0, 1, 2, 2, *range(3, 24)]
    spring = series(spark, "2024-03-30 23:00", 23, name="load")
    back = ladder.patched(spring, "load", spark.createDataFrame([(D(2024, 4, 7), D(2024, 3, 31))], "day date, reference date")).orderBy("ts").collect()
    assert [r.value for r in back] == [0, 1, 1, *range(2, 23)]


def test_student_t():
    for t, n, p in ((2.228, 10, 0.05), (1.96, 10**6, 0.05), (3.169, 10, 0.01), (0.0, 5, 1.0)):
        assert evaluation.two_sided_p(t, n) == pytest.approx(p, rel=2e-3)


def test_scores_skip_null_pairs(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", None, 2.0), ("a", 3.0, None), ("b", 0.0, 1.0)], "k string, y double, p double")
    got = {r.k: (r.n, r.mae, r.wape) for r in evaluation.point_scores(df, ["k"]).collect()}
    assert got == {"a": (3, 1.0, 1.0), "b": (1, 1.0, None)}
    assert evaluation.rearrange(spark.createDataFrame([(3.0, 1.0, 2.0)], "a double, b double, c double"), ["a", "b", "c"]).first()[:] == (1.0, 2.0, 3.0)


def test_local_scale_takes_the_nearest():
    rng = np.random.default_rng(3)
    level, y, query = rng.normal(50, 20, 300), rng.normal(0, 5, 300), rng.normal(50, 30, 40)
    for k in (5, 50, 300, 500):
        want = [np.std(y[np.argsort(np.abs(level - q), kind="stable")[:k]], ddof=1) for q in query]
        assert calibration.local_scale(query, level, y, k, 0.1) == pytest.approx(want)


def test_capacity_outside_is_null(spark):
    anchors = spark.createDataFrame([("s", D(2024, 1, 31), 100.0), ("s", D(2024, 2, 29), 129.0)], "kind string, day date, mw double")
    q = spark.createDataFrame([("s", D(2024, 1, 1)), ("s", D(2024, 2, 10)), ("s", D(2024, 3, 2)), ("s", D(2024, 9, 1))], "kind string, on date")
    got = {str(r.on): r.mw for r in capacity.at(anchors, q, "kind").collect()}
    assert got == {"2024-01-01": None, "2024-02-10": 110.0, "2024-03-02": 131.0, "2024-09-01": None}


def test_store_merge_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1.0)], "day int, row string, v double")
    new = spark.createDataFrame([(1, "a", 2.0), (2, "a", 3.0)], "day int, row string, v double")
    merged, conflicts = quality.merge_rows(old, new, ["day", "row"], "v")
    again, _ = quality.merge_rows(merged, new, ["day", "row"], "v")
    assert sorted(merged.collect()) == sorted(again.collect()) == [(1, "a", 1.0), (2, "a", 3.0)]
    assert [r.day for r in conflicts.collect()] == [1]


def test_payload_checks(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), ([1.0, float("nan")],)], "v array<double>")
    assert [r.problem for r in quality.payload_checks(df, "v", F.lit(2)).collect()] == [None, "count", "not finite"]


def test_sources_round_trip(spark, tmp_path):
    a, b = series(spark, "2024-01-01", 3), series(spark, "2024-01-01 02:00", 3, name="load")
    a.write.parquet(f"{tmp_path}/drift/a")
    b.write.parquet(f"{tmp_path}/drift/b")
    got = sources.read_drifting(spark, f"{tmp_path}/drift/*").orderBy("ts").collect()
    assert [(r.price, r.load) for r in got] == [(0, None), (1, None), (2, 0), (None, 1), (None, 2)]
    assert sources.read_or_empty(spark, f"{tmp_path}/none", a.schema).count() == 0
    (tmp_path / "a.csv").write_text("# c\n# d\nanchor_date,production_type,capacity_mw\n2024-02-29,solar,2\n2024-01-31,solar,1\n2024-01-31,wind,9\n")
    assert [r.capacity_mw for r in sources.read_anchors(spark, f"{tmp_path}/a.csv", "solar").collect()] == [1.0, 2.0]
    (tmp_path / "runs.json").write_text(json.dumps({"run_id": "r", "reasons": ["x"], "versions": {"m": "1"}, "extra": 1}) + "\n" + json.dumps({"rank": 2}) + "\n")
    runs = sources.read_protocol(spark, f"{tmp_path}/runs.json").collect()
    assert (runs[0].reasons, runs[0].versions, runs[0].rank, runs[1].run_id) == (["x"], {"m": "1"}, None, None)
    sources.write_monthly(a, f"{tmp_path}/monthly")
    sources.write_monthly(a, f"{tmp_path}/monthly")
    assert spark.read.parquet(f"{tmp_path}/monthly").count() == 3
    assert [r.file for r in sources.checksums(spark, f"{tmp_path}/a.csv").collect()] == ["a.csv"]


def test_landed_json(spark):
    docs = spark.createDataFrame([("a", '{"unix_seconds":[0,900],"values":[1.0,null]}'), ("b", '{"unix_seconds":[0],"values":[]}'), ("c", "junk")], "source string, body string")
    rows, bad = sources.flatten_series(docs)
    assert [(r.ts, r.value) for r in rows.orderBy("ts").collect()] == [(at("1970-01-01"), 1.0), (at("1970-01-01 00:15"), None)]
    assert sorted(r.source for r in bad.collect()) == ["b", "c"]
    cap = spark.createDataFrame([('{"time":["01.2024","02.2024"],"types":{"solar":[1.5,2.0]}}',)], "body string")
    got = sources.melt_capacity(cap, F.lit("2024-02-15").cast("date")).collect()
    assert [(str(r.anchor_date), r.production_type, r.capacity_mw) for r in got] == [("2024-01-31", "solar", 1500.0)]
    fc = spark.createDataFrame([("r", '[{"latitude":1,"longitude":2,"hourly":{"time":["2024-01-01T00:00","2024-01-01T01:00"],"values":{"wind":[1,2],"sun":[3]}}}]')], "run string, body string")
    rows, bad = sources.flatten_forecast(fc)
    assert [(r.variable, r.value) for r in rows.orderBy("valid").collect()] == [("wind", 1.0), ("wind", 2.0)] and [r.problem for r in bad.collect()] == ["length"]


def test_streams_equal_batches(spark, tmp_path):
    df = spark.createDataFrame([(at("2024-01-01 00:10"), 1.0, 1), (at("2024-01-01 00:50"), 3.0, 2), (at("2024-01-01 01:10"), 5.0, 1), (at("2024-02-01 00:00"), 9.0, 9)], "ts timestamp_ntz, value double, k int")
    df.write.parquet(f"{tmp_path}/in")
    stream = lambda: streaming.source(spark, f"{tmp_path}/in", df.schema)
    streaming.run_available(streaming.hourly(stream()), f"{tmp_path}/hour", f"{tmp_path}/c1")
    assert sorted(r.price for r in spark.read.parquet(f"{tmp_path}/hour").collect()) == [2.0, 5.0]
    streaming.run_available(streaming.trailing_mean(stream(), 2), f"{tmp_path}/mean", f"{tmp_path}/c2")
    assert {(r.mean, r.n) for r in spark.read.parquet(f"{tmp_path}/mean").collect()} == {(2.0, 2), (3.0, 3), (5.0, 1)}
    streaming.run_available(streaming.revised(stream(), ["k"]), f"{tmp_path}/once", f"{tmp_path}/c3")
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/once").collect()) == [1, 2, 9]
    rows = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0)], "day int, row string, v double")
    sink = streaming.append_once(f"{tmp_path}/store", ["day", "row"], "v")
    sink(rows, 0)
    sink(rows, 0)
    assert spark.read.parquet(f"{tmp_path}/store").count() == 2


def test_first_full_coverage(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, at("2024-01-01 00:00")), ("a", 1, at("2024-01-01 02:00")), ("a", 1, at("2024-01-01 03:00")), ("b", 0, at("2024-01-01 00:00"))], "series string, slot int, ts timestamp_ntz")
    df.write.parquet(f"{tmp_path}/in")
    streaming.run_available(streaming.first_full_coverage(streaming.source(spark, f"{tmp_path}/in", df.schema), "series", 2), f"{tmp_path}/out", f"{tmp_path}/c")
    assert [(r.series, r.slots, r.complete_at[:16]) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("a", 2, "2024-01-01T02:00")]


def test_ffill_by_series_keeps_null_keys_apart(spark):
    rows = [(k, at("2024-01-01 00:00") + dt.timedelta(hours=h), v) for k in ("a", "b", None) for h, v in ((0, 1.0), (1, None), (2, None), (3, None), (9, None))]
    got = cleaning.bounded_ffill(spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double"), "v", 2, by=["k"]).orderBy("k", "ts").collect()
    assert [r.v_filled for r in got] == [1.0, 1.0, 1.0, None, None] * 3


def test_local_windows_over_clock_changes(spark):
    a, b = tg.local_window(F.col("day"), 14, -1)
    got = days(spark, "2025-04-02", "2025-10-28", "2025-06-15").orderBy("day").select(tg.expected_slots(a, b, 60).alias("n")).collect()
    assert [r.n for r in got] == [359, 360, 361]


def test_generation_columns(spark):
    long = spark.createDataFrame([(1, "Gas", 5.0), (1, "Water A", 1.0), (1, "Water B", 2.0), (1, "Odd", 7.0), (1, "Odder", 1.0), (2, "Gas", None), (2, "Water A", None)], "ts int, type string, mw double")
    got = {r.ts: r for r in cleaning.generation_columns(long, {"Gas": "gen_gas", "Coal": "gen_coal"}, ["Water A", "Water B"]).collect()}
    assert (got[1].gen_gas, got[1].gen_coal, got[1].gen_hydro, got[1].gen_other) == (5.0, None, 3.0, 8.0)
    assert (got[2].gen_gas, got[2].gen_hydro, got[2].gen_other) == (None, None, None)


def test_runs_store(spark, tmp_path):
    runs = [("m", at("2024-01-01 00:00"), 1.0), ("m", at("2024-01-02 00:00"), 2.0), ("n", at("2024-01-01 00:00"), 3.0)]
    df = spark.createDataFrame(runs, "model string, run timestamp_ntz, value double")
    for m in ("m", "n"):
        sources.write_runs(df.where(F.col("model") == m), f"{tmp_path}/runs")
    got = sources.read_runs(spark, f"{tmp_path}/runs", days(spark, "2024-01-02"), "m").collect()
    assert [r.value for r in got] == [1.0]


def test_logs_and_protocol(spark, tmp_path):
    df = spark.createDataFrame([("x", 1, True)], "b string, a int, c boolean")
    for _ in range(2):
        sources.append_log(df, f"{tmp_path}/log", ["a", "b"])
    back = spark.read.option("header", True).csv(f"{tmp_path}/log")
    assert back.columns == ["a", "b"] and back.count() == 2
    names = list(sources.RUN)[:2]
    sources.write_protocol(spark.createDataFrame([("7", "8", "9")], [names[1], names[0], "unknown"]), f"{tmp_path}/protocol")
    raw = "".join(f.read_text() for f in (tmp_path / "protocol").glob("*.json"))
    assert list(json.loads(raw)) == names
    assert sources.read_protocol(spark, f"{tmp_path}/protocol").columns == list(sources.RUN)


def test_schema_and_rejection(spark):
    df = spark.createDataFrame([(1, "s"), (2, "t")], "a int, source string")
    assert sources.check_schema(df.select("source", "a"), df.schema).columns == ["a", "source"]
    with pytest.raises(ValueError, match="'a'"):
        sources.check_schema(df.withColumn("a", F.col("a").cast("long")), df.schema)
    good, bad = cleaning.reject_invalid(df, "source", df.where("a = 1"))
    assert [r.a for r in good.collect()] == [1] and [r.a for r in bad.collect()] == [2]


def test_payload_archive(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"challenge_id": "c", "target_start": "2025-03-30T00:00:00+01:00", "values": list(range(100))}))
    got = sources.read_payloads(spark, f"{tmp_path}/a.json").orderBy("ts").collect()
    assert len(got) == 92 and got[0].ts == at("2025-03-29 23:00") and got[-1].ts == at("2025-03-30 21:45")


def test_vintages_are_written_once(spark, tmp_path):
    rows = [(D(2024, 1, 31), "solar", 1.0), (D(2024, 2, 29), "solar", 2.0)]
    df, path = spark.createDataFrame(rows, sources.ANCHORS), f"{tmp_path}/anchors"
    sources.write_vintage(df, path, "2024-03-01")
    sources.write_vintage(df.withColumn("capacity_mw", F.col("capacity_mw") + 1), path, "2024-04-01")
    with pytest.raises(Exception, match="already exists"):
        sources.write_vintage(df, path, "2024-03-01")
    got = sources.read_vintages(spark, path)
    assert {(str(r.as_of), r.capacity_mw) for r in got.collect()} == {("2024-03-01", 1.0), ("2024-03-01", 2.0), ("2024-04-01", 2.0), ("2024-04-01", 3.0)}
    listed = spark.read.option("header", True).csv(f"{path}/_checksums")
    assert sources.bad_checksums(spark, f"{path}/as_of=*/*.csv", listed).count() == 0
    changed = listed.withColumn("sha256", F.when(F.col("as_of") == "2024-04-01", F.lit("0")).otherwise(F.col("sha256"))).unionByName(spark.createDataFrame([("x", "gone.csv", "0")], "as_of string, file string, sha256 string"))
    assert sorted(r.problem for r in sources.bad_checksums(spark, f"{path}/as_of=*/*.csv", changed).collect()) == ["changed", "missing"]


def test_scaled_conformal_against_a_loop(spark):
    rng = np.random.default_rng(3)
    start, n, k = at("2024-06-01 22:00"), 24 * 14, 30
    p = rng.normal(50, 15, n)
    y = p + rng.normal(0, 5, n)
    rows = [(start + dt.timedelta(hours=i), D(2024, 6, 2) + dt.timedelta(days=i // 24), float(y[i]), float(p[i]), float(p[i] - 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, day date, y double, p double, low double")
    got = {(r.ts, r.level): r for r in calibration.scaled_conformal(df, {0.1: "low", 0.5: "p"}, window_days=5, every=2, k=k, least=72).collect()}
    assert len(got) == 2 * n
    for i, (ts, day, _, pi, li) in enumerate(rows):
        state = i // 24 // 2 * 2  # the day whose pool serves
        pool = range(max(0, 24 * (state - 6)), max(0, 24 * (state - 1)))
        for level, raw in ((0.1, li), (0.5, pi)):
            r = got[ts, level]
            if len(pool) < 72:
                assert r.uncalibrated and r.q == raw
                continue
            cp, cy = p[list(pool)], y[list(pool)]
            scale = lambda x: max(np.std(cy[np.argsort(np.abs(cp - x), kind="stable")[:k]], ddof=1), 0.05 * np.std(cy, ddof=1))  # noqa: E731, B023
            scores = sorted((cy[j] - (cp[j] - (3 if level == 0.1 else 0))) / scale(cp[j]) for j in range(len(cp)))
            rank = min(max(int(np.ceil((len(scores) + 1) * level)), 1), len(scores))
            assert not r.uncalibrated and r.n == len(pool) and abs(r.q - (raw + scores[rank - 1] * scale(pi))) < 1e-6


def test_window_verdict(spark):
    df = spark.createDataFrame([(w, d, x) for d in range(4) for w, x in ((7, 10.0), (14, 10.1 if d else 10.0))] + [(7, 9, 1.0)], "window_days int, day int, loss double")
    close = {r.window_days: r for r in calibration.window_verdict(df, 7, 14).collect()}
    assert close[14].chosen and not close[7].chosen and close[7].days == 4
    far = {r.window_days: r.chosen for r in calibration.window_verdict(df.withColumn("loss", F.when(F.col("window_days") == 14, 12.0).otherwise(F.col("loss"))), 7, 14).collect()}
    assert far == {7: True, 14: False}


def test_live_assembly_keeps_hours_without_a_price(spark):
    price = series(spark, "2025-10-24 22:00", 24)
    load = series(spark, "2025-10-24 22:00", 30, name="load")
    got = cleaning.live_assemble([price, load], days(spark, "2025-10-26")).orderBy("ts").collect()
    assert len(got) == 24 + 25 and len({r.ts for r in got}) == 49
    assert [r.price is None for r in got] == [False] * 24 + [True] * 25 and sum(r.load is not None for r in got) == 30


def test_existing_wins_or_fails(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, "a", 3.0)], "k int, s string, v double")
    new = spark.createDataFrame([(1, "a", 1.05), (2, "a", 2.0), (4, "a", 4.0)], "k int, s string, v double")
    assert sorted((r.k, r.v) for r in cleaning.existing_wins(old, new, ["k", "s"], "v", 0.1).collect()) == [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)]
    with pytest.raises(Exception, match=r"v disagrees at k=1, s=a: stored 1.0, fresh 1.05"):
        cleaning.existing_wins(old, new, ["k", "s"], "v").collect()


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    """Parts drained one after the other, with late rows among them, give what all rows at once give, once their windows are closed."""
    rows = [(at("2024-01-01 00:10") + dt.timedelta(minutes=20 * i), float(i), i) for i in range(400)]
    arrival = lambda r: (r[0] + dt.timedelta(hours=30 * (r[2] % 9 == 0))).date()
    parts = [[r for r in rows if arrival(r) == day] for day in sorted({arrival(r) for r in rows})]
    for part in parts:
        spark.createDataFrame(part, "ts timestamp_ntz, value double, k int").write.mode("append").parquet(f"{tmp_path}/in")
        streaming.run_available(streaming.hourly(streaming.source(spark, f"{tmp_path}/in", spark.createDataFrame(rows, "ts timestamp_ntz, value double, k int").schema), "4 days"), f"{tmp_path}/out", f"{tmp_path}/c")
    edge = max(r[0] for r in rows) - dt.timedelta(days=4)
    want = {}
    for ts, v, _ in rows:
        want.setdefault(ts.replace(minute=0), []).append(v)
    got = {r.ts.replace(tzinfo=None): r.price for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {h: sum(v) / len(v) for h, v in want.items() if h + dt.timedelta(hours=1) <= edge} and len(got) > 20
