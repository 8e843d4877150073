import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from finledger.operators import audit, control, dedup, filters, mutate, ranking, slices
from finledger.plans import alerts, reports

DAY = dt.datetime(2026, 1, 1)


def test_keep_last_and_first(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string").repartition(3)
    assert rows(dedup.keep_last(df, ["k"], ["o"])) == [(1, 2, "b"), (2, 1, "c")]
    assert rows(dedup.keep_first(df, ["k"], ["o"])) == [(1, 1, "a"), (2, 1, "c")]
    assert dedup.keep_last(df, ["k"], ["o"]).columns == df.columns


def stored(spark):
    return spark.createDataFrame(
        [(1, "a", 10, DAY, DAY), (2, "b", 20, DAY, DAY)],
        "k int, v string, id int, created_at timestamp_ntz, updated_at timestamp_ntz",
    )


@pytest.mark.parametrize("touch", [None, "updated_at"])
def test_merge_upsert(spark, now, touch):
    batch = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    stamps = ("created_at", "updated_at")
    args = (["k"], ["v"], now, touch, stamps)
    once = mutate.merge_upsert(stored(spark), batch, *args)
    new = dt.datetime(2026, 6, 1)
    assert rows(once) == sorted([
        (1, "a", 10, DAY, DAY), (2, None, 20, DAY, new if touch else DAY), (3, "c", None, new, new)], key=repr)
    assert rows(mutate.merge_upsert(once, batch, *args)) == rows(once)


def test_merge_upsert_edges(spark, now):
    empty = spark.createDataFrame([], "k int, v string")
    assert rows(mutate.merge_upsert(stored(spark), empty, ["k"], ["v"], now)) == rows(stored(spark))
    with pytest.raises(KeyError, match="my_table"):
        mutate.merge_upsert(stored(spark), empty.drop("v"), ["k"], ["v"], now, context="my_table")


def test_merge_on_several_keys(spark, now):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "x int, y int, v string")
    s = spark.createDataFrame([(1, 2, "B"), (2, 2, "n")], "x int, y int, v string")
    assert rows(mutate.merge_upsert(t, s, ["x", "y"], ["v"], now)) == [(1, 1, "a"), (1, 2, "B"), (2, 2, "n")]


@pytest.mark.parametrize("version, passes", [
    (DAY, False), (DAY - dt.timedelta(1), True), (DAY + dt.timedelta(1), True), (None, True),
])
def test_skip_unchanged(spark, version, passes):
    schema = "k int, ver timestamp_ntz"
    stored = spark.createDataFrame([(1, DAY)], schema)
    batch = spark.createDataFrame([(1, version)], schema)
    assert (mutate.skip_unchanged(batch, stored, "k", "ver").count() == 1) is passes
    nulls = spark.createDataFrame([(1, None)], schema)
    assert mutate.skip_unchanged(batch, nulls, "k", "ver").count() == 1


def test_replace_children(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "p int, v string")
    parents = spark.createDataFrame([(1,), (3,), (4,)], "p int")
    new = spark.createDataFrame([(1, "x"), (4, "y")], "p int, v string")
    once = mutate.replace_children(old, parents, new, "p")
    assert rows(once) == [(1, "x"), (2, "c"), (4, "y")]
    assert rows(mutate.replace_children(once, parents, new, "p")) == rows(once)


def test_reconcile_snapshot(spark, now):
    schema = "h string, source_account string, amount int, movement_source string"
    target = spark.createDataFrame(
        [("1", "A", 1, "dia"), ("2", "A", 2, "dia"), ("3", "B", 3, "dia"), ("9", "A", 9, "anteriores"), ("8", "A", 8, None)],
        schema,
    )
    feed = spark.createDataFrame([("1", "A", 10, "dia"), ("4", "A", 4, "dia")], schema)
    cols = ["source_account", "amount", "movement_source"]
    settled = [("8", "A", 8, None), ("9", "A", 9, "anteriores")]

    def run(current, scope=None, start=target):
        return mutate.reconcile_snapshot(start, current, ["h"], cols, now, scope=scope)

    everything = run(feed)
    assert rows(everything) == sorted([("1", "A", 10, "dia"), ("4", "A", 4, "dia"), *settled], key=repr)
    assert rows(run(feed, start=everything)) == rows(everything)
    only_a = spark.createDataFrame([("A",)], "source_account string")
    assert rows(run(feed, only_a)) == sorted([("1", "A", 10, "dia"), ("4", "A", 4, "dia"), ("3", "B", 3, "dia"), *settled], key=repr)
    assert rows(run(feed.limit(0))) == sorted(settled, key=repr)


def test_surrogates_follow_key_order(spark):
    target = spark.createDataFrame([(5, "a")], "id bigint, k string")
    new = spark.createDataFrame([(f"{i:03x}",) for i in range(300)], "k string").repartition(7)
    out = mutate.assign_surrogate(target, new, "id", "k", F.substring("k", 1, 1))
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(6 + i, f"{i:03x}") for i in range(300)]
    empty = mutate.assign_surrogate(target.limit(0), new, "id", "k", F.substring("k", 1, 1))
    assert empty.agg(F.min("id")).first()[0] == 1


def test_insert_missing_backfill_reset(spark, now):
    t = spark.createDataFrame([("a", "x")], "k string, v string")
    s = spark.createDataFrame([("a", "new"), ("b", None)], "k string, v string")
    seeded = mutate.insert_missing(t, s, ["k"])
    assert rows(seeded) == [("a", "x"), ("b", None)]
    assert rows(mutate.backfill_null(seeded, "v", "none")) == [("a", "x"), ("b", "none")]
    control_rows = spark.sql("SELECT 'p' process_name, 'IB' source_system, timestamp_ntz'2026-01-01' last_successful_sync, timestamp_ntz'2026-01-01' updated_at")
    empty, cleared = mutate.reset_tables({"t": seeded}, control_rows, now)
    assert empty["t"].count() == 0 and empty["t"].schema == seeded.schema
    assert tuple(cleared.first()) == ("p", "IB", None, dt.datetime(2026, 6, 1))


@pytest.mark.parametrize("hot", [False, True])
def test_running_index_matches_brute_force(spark, hot):
    rnd = random.Random(1)
    data = [("h" if hot and rnd.random() < 0.6 else str(rnd.randrange(5)), o) for o in range(2000)]
    df = spark.createDataFrame(data, "g string, o int").repartition(5)
    out = ranking.index_in_group(df, ["g"], ["o"], F.floor(F.col("o") / 37))
    seen, expected = {}, set()
    for g, o in data:
        expected.add((g, o, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + 1
    assert {tuple(r) for r in out.collect()} == expected


def test_exact_percentiles(spark):
    import numpy as np

    rnd = random.Random(2)
    data = [("h" if rnd.random() < 0.7 else "c", round(rnd.gauss(50, 40), 1)) for _ in range(3000)]
    out = ranking.exact_percentiles(
        spark.createDataFrame(data, "g string, v double"), ["g"], "v", {"p50": 0.5, "p99": 0.99}
    )
    for r in out.collect():
        values = [v for g, v in data if g == r["g"]]
        assert r["count"] == len(values)
        assert r["p50"] == pytest.approx(np.percentile(values, 50))
        assert r["p99"] == pytest.approx(np.percentile(values, 99))


def test_percentiles_of_crowded_and_extreme_values(spark):
    """99 % of a group within a hair's breadth, the rest anywhere; ends, copies, one row, NULLs."""
    import numpy as np

    rnd = random.Random(5)
    data = [("h", 7.0 + rnd.randrange(50) * 2 ** -50) for _ in range(2000)]
    data += [("h", v) for v in (-1e300, 1e300, -0.0, 0.0, 5e-324, -5e-324, 1e-9) * 3]
    data += [("one", -3.5), ("two", 1.0), ("two", 1.0), ("two", None), ("none", None)]
    probs = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p995": 0.995, "p100": 1.0}
    out = ranking.exact_percentiles(
        spark.createDataFrame(data, "g string, v double").repartition(3), ["g"], "v", probs, "n"
    ).collect()
    assert sorted(r["g"] for r in out) == ["h", "one", "two"]
    for r in out:
        values = [v for g, v in data if g == r["g"] and v is not None]
        assert r["n"] == len(values)
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.percentile(values, 100 * p), rel=1e-15)


def walked(counts, cap):
    """Slices of the sequential cursor: read from it on up to the cap, go on at the last instant read;
    where that does not move it, the instant is over the cap and the next one follows."""
    out, cursor = [], 0
    instants = [i for i, n in enumerate(counts) if n]
    while instants:
        rows = [i for i in instants if i >= cursor for _ in range(counts[i])]
        begin, taken = rows[0], rows[:cap]
        moved = taken[-1] > begin
        out.append((begin, taken[-1], len(taken), len(rows) > cap and counts[begin] > cap))
        if len(rows) <= cap:
            return out
        later = [i for i in instants if i > begin]
        if not moved and not later:
            return out
        cursor = taken[-1] if moved else later[0]
    return out


@pytest.mark.parametrize("counts, cap", [
    ([1] * 50, 7), ([3, 20, 1, 1, 9, 4, 6, 6, 1], 10), ([12], 5), ([5, 5, 5], 5), ([0, 2, 0, 9, 1], 3),
    ([4, 1, 1, 30, 1, 1, 2, 8, 8, 8, 3, 1, 1], 8), ([1, 2, 3], 100), ([30, 1], 4), ([1, 30], 4),
])
def test_cursor_slices_are_the_sequential_loops(spark, counts, cap):
    got = slices.cursor_slices(seconds(spark, counts), "ts", cap, "minute").collect()
    got = sorted(
        ((r["begin_ts"] - DAY).seconds, (r["end_ts"] - DAY).seconds, r["rows"], r["overfull"]) for r in got
    )
    assert got == walked(counts, cap)


def test_cursor_slices_of_many_instants(spark):
    rnd = random.Random(8)
    counts = [rnd.choice([0, 1, 1, 2, 5, 40]) for _ in range(600)]
    got = slices.cursor_slices(seconds(spark, counts), "ts", 30, "minute").collect()
    assert sorted(((r["begin_ts"] - DAY).seconds, r["rows"]) for r in got) == [
        (b, n) for b, _, n, _ in walked(counts, 30)
    ]
    assert slices.cursor_slices(seconds(spark, [1]).limit(0), "ts", 30).collect() == []


def seconds(spark, counts):
    """``counts[i]`` rows at second i."""
    data = [(i, n) for i, n in enumerate(counts)]
    df = spark.createDataFrame(data, "i int, n int").where("n > 0")
    ts = F.timestamp_add("SECOND", F.col("i"), F.lit(DAY).cast("timestamp_ntz"))
    return df.select(ts.alias("ts"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("x"))


@pytest.mark.parametrize("counts, cap, overfull", [
    ([1] * 120, 9900, 0), ([1] * 25000, 9900, 0), ([12000], 9900, 1),
    ([3, 200, 1, 1, 90, 40, 60, 60, 1], 100, 1),
])
def test_plan_slices(spark, counts, cap, overfull):
    df = seconds(spark, counts)
    plan = slices.plan_slices(df, "ts", cap, "hour").orderBy("begin_ts").collect()
    assert sum(r["rows"] for r in plan) == sum(counts)
    assert sum(r["overfull"] for r in plan) == overfull
    assert all(r["rows"] <= cap or r["overfull"] for r in plan)
    assert all(a["end_ts"] < b["begin_ts"] for a, b in zip(plan, plan[1:]))
    if sum(counts) <= cap // 2:
        assert len(plan) == 1


def test_plan_slices_empty(spark):
    assert slices.plan_slices(seconds(spark, [1]).limit(0), "ts", 10).count() == 0


def test_cap_cycle(spark):
    df = seconds(spark, [50, 100, 300]).withColumn("id", F.monotonically_increasing_id())
    df = df.withColumn("id", F.when(F.col("x") != 1, F.col("id")))
    taken, carry = slices.cap_cycle(df, "ts", "id", 150, "hour")
    assert taken.count() == 150 and taken.where("id IS NULL").count() == 0
    c = carry.first()
    assert c["carry_over_from"] == DAY + dt.timedelta(seconds=2) and c["left_over"] == 447 - 150
    taken, carry = slices.cap_cycle(df, "ts", "id", 10_000, "hour")
    assert taken.count() == 447 and carry.first()["left_over"] == 0


def test_windows():
    at = dt.datetime(2026, 6, 1, 12)
    assert control.rolling_window(at) == (at - dt.timedelta(hours=4), at)
    assert control.rolling_window(at, 24)[0] == at - dt.timedelta(days=1)
    assert control.rolling_window(at, initial_days=30)[0] == at - dt.timedelta(days=30)


def test_window_for(spark):
    rows_ = spark.sql("SELECT 'a' process_name, timestamp_ntz'2026-05-20 10:00:00' last_successful_sync UNION ALL SELECT 'b', NULL")
    at = dt.datetime(2026, 6, 1, 12)
    assert control.window_for(rows_, "a", at) == (dt.date(2026, 5, 13), dt.date(2026, 6, 1))
    assert control.window_for(rows_, "b", at)[0] == dt.date(2026, 5, 25)


def test_ledger_and_control(spark):
    at = dt.datetime(2026, 6, 1)
    ledger = (
        control.start_run(spark, 1, "a", "IB", at)
        .unionByName(control.finish_run(spark, 1, "a", "IB", at + dt.timedelta(seconds=5), False, 3, 2, error="boom"))
        .unionByName(control.start_run(spark, 2, "b", "IB", at))
    )
    runs = {r["sync_run_id"]: r for r in control.fold_runs(ledger).collect()}
    assert (runs[1]["status"], runs[1]["rows_read"], runs[1]["error_message"]) == ("ERROR", 3, "boom")
    assert runs[2]["status"] == "RUNNING" and runs[2]["finished_at"] is None

    from finledger.schemas import table_schema

    base = spark.createDataFrame(
        [("a", "IB", DAY, DAY, None, None, "SUCCESS", None, DAY), ("b", "IB", DAY, DAY, None, None, "SUCCESS", None, DAY)],
        table_schema("sync_control"),
    )
    out = spark.createDataFrame([("a", False, DAY, at, at, "boom")],
                                "process_name string, ok boolean, begin_date timestamp_ntz, end_date timestamp_ntz, at timestamp_ntz, error string")
    after = {r["process_name"]: r for r in control.advance_control(base, out).collect()}
    assert after["a"]["last_successful_sync"] == DAY and after["a"]["last_attempt_sync"] == at
    assert after["a"]["last_status"] == "ERROR" and after["a"]["last_error"] == "boom"
    assert after["b"] == base.where("process_name = 'b'").first()


def test_audit(spark):
    from finledger.schemas import SPECS

    payments = spark.createDataFrame([(1,), (1,), (2,)], "payment_id bigint")
    charges = spark.createDataFrame([(1, "a"), (1, "a"), (3, None), (3, "b")], "payment_id bigint, charge_id string")
    got = {(r[0], r[1], r[2]): r[3] for r in audit.audit_constraints({"mp_payments": payments, "mp_payment_charges": charges}, SPECS).collect()}
    assert got[("mp_payments", "unique", "payment_id")] == 1
    assert got[("mp_payment_charges", "unique", "payment_id,charge_id")] == 1
    assert got[("mp_payment_charges", "not_null", "charge_id")] == 1
    assert got[("mp_payment_charges", "foreign_key", "payment_id")] == 2


def test_absence_and_threshold(spark):
    def at(*minutes):
        data = [("j", DAY + dt.timedelta(minutes=m)) for m in minutes]
        return spark.createDataFrame(data, "k string, ts timestamp_ntz")

    gaps = alerts.absence_alert(at(0, 10, 41, 71.5, 71.6), "k", "ts").collect()
    assert [(r["gap_start"], r["gap_seconds"]) for r in gaps] == [
        (DAY + dt.timedelta(minutes=10), 31 * 60), (DAY + dt.timedelta(minutes=41), 30 * 60 + 30)]
    fired = alerts.threshold_alert(at(*[0.1 * i for i in range(6)]), "ts", alerts.SERVER_ERRORS)
    assert fired.count() == 5 and {r["value"] for r in fired.collect()} == {6}


def test_cycles_take_every_row_once(spark):
    df = spark.range(57).selectExpr(
        "id AS k", "timestamp_ntz'2026-01-01' + make_dt_interval(0, CAST(id % 7 AS INT)) AS ts"
    )
    odd = df.limit(2).selectExpr("CAST(NULL AS BIGINT) AS k", "ts").unionByName(
        df.limit(1).selectExpr("k", "CAST(NULL AS TIMESTAMP_NTZ) AS ts")
    )
    got = [r for taken in slices.cycles(df.unionByName(odd), "ts", "k", 10) for r in taken.collect()]
    assert sorted(r["k"] for r in got) == list(range(57))
    assert [(r["ts"], r["k"]) for r in got] == sorted((r["ts"], r["k"]) for r in got)
    whole, carry = slices.cap_cycle(df.unionByName(odd), "ts", "k")
    assert whole.count() == 57 and carry.first()["left_over"] == 0 and carry.first()["skipped"] == 3


def test_slices_hold_every_row_within_the_cap(spark):
    df = spark.range(500).selectExpr(
        "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, CAST(id * id % 83 AS INT)) AS ts"
    ).unionByName(spark.range(3).selectExpr("CAST(NULL AS TIMESTAMP_NTZ) AS ts"))
    rows = slices.plan_slices(df, "ts", 40).collect()
    dated = sorted((r for r in rows if r["begin_ts"]), key=lambda r: r["begin_ts"])
    assert [r["rows"] for r in rows if r["begin_ts"] is None] == [3]
    assert all(r["rows"] <= 40 for r in dated) and sum(r["rows"] for r in dated) == 500
    assert all(a["end_ts"] < b["begin_ts"] for a, b in zip(dated, dated[1:]))


def test_a_silent_source_is_reported(spark):
    at = [dt.datetime(2026, 1, 1, 0, m) for m in (0, 10)] + [dt.datetime(2026, 1, 1, 2, 0)]
    df = spark.createDataFrame([("a", t) for t in at[:2]] + [("b", t) for t in at], "p string, ts timestamp_ntz")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "p string")
    now = F.lit(dt.datetime(2026, 1, 1, 2, 10)).cast("timestamp_ntz")
    got = alerts.absence_alert(df, "p", "ts", 30, as_of=now, expected=expected).collect()
    assert sorted((r["p"], r["gap_seconds"] or 0) for r in got) == [("a", 7200), ("b", 6600), ("c", 0)]
    with pytest.raises(ValueError):
        alerts.absence_alert(df, "p", "ts", 5, bin_minutes=10)


def test_a_closed_range_ends_with_its_last_day(spark):
    at = [dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2, 10), dt.datetime(2026, 1, 3)]
    df = spark.createDataFrame([("a", t) for t in at], "source_account string, process_date timestamp_ntz")
    assert reports.movements_by_account(df, "a", "2026-01-01", "2026-01-02").count() == 2
    assert reports.movements_by_date(df, dt.date(2026, 1, 2), dt.date(2026, 1, 2)).count() == 1
    assert df.where(filters.up_to("process_date", dt.datetime(2026, 1, 2))).count() == 1
