"""Operators against plain Python, with one key holding most rows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymill.operators import quality, repair, versions, windows
from tallymill.operators.keys import dense_key


def skewed(n=3000, seed=7):
    """Rows of which two thirds share one key, many orders tied within a chunk."""
    rng = random.Random(seed)
    return [
        (i, "hot" if rng.random() < 0.66 else rng.choice("abcde"), rng.choice("xy"), rng.randint(-9, 9), i // 37)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def ledger(spark):
    return spark.createDataFrame(skewed(), "id int, k string, s string, v int, day int").repartition(5).cache()


def test_running_windows_match_a_plain_loop(ledger):
    out = windows.running_windows(
        ledger,
        [
            windows.Level(("k",), sums={"total": "v"}, moving={"last3": ("v", 3)}, lags={"before": "v"}),
            windows.Level(("k", "s"), sums={"sub": "v"}, moving={"sub2": ("v", 2)}),
        ],
        [F.col("id")],
        [F.col("day")],
    ).orderBy("id").collect()
    seen, sub = defaultdict(list), defaultdict(list)
    assert len(out) == 3000
    for r in out:
        mine, both = seen[r["k"]], sub[r["k"], r["s"]]
        assert r["before"] == (mine[-1] if mine else None)
        mine.append(r["v"])
        both.append(r["v"])
        assert r["total"] == sum(mine) and r["last3"] == sum(mine[-3:])
        assert r["sub"] == sum(both) and r["sub2"] == sum(both[-2:])


def test_running_windows_last_total_is_the_group_sum(ledger):
    out = windows.running_windows(ledger, [windows.Level(("k",), sums={"t": "v"})], [F.col("id")], [F.col("day")])
    last = out.groupBy("k").agg(F.max_by("t", "id").alias("v"))
    assert rows(last) == rows(ledger.groupBy("k").agg(F.sum("v").alias("v")))


def test_running_windows_share_one_shuffle_of_the_rows(ledger):
    out = windows.running_windows(
        ledger,
        [windows.Level(("k",), sums={"a": "v"}), windows.Level(("k", "s"), sums={"b": "v"})],
        [F.col("id")],
        [F.col("day")],
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k#") >= 1
    spine = plan[: plan.index("Union")]
    assert spine.count("Exchange") == 1


def test_lag_fill_looks_one_row_back_over_the_whole_table(spark):
    data = [(i, None if i % 3 else str(i), i // 4) for i in range(40)]
    df = spark.createDataFrame(data, "id int, x string, c int").repartition(4)
    out = {r["id"]: r["x"] for r in windows.lag_fill(df, "x", [F.col("id")], [F.col("c")]).collect()}
    assert out == {i: str(i) if i % 3 == 0 else (str(i - 1) if i % 3 == 1 else None) for i in range(40)}


def test_row_numbers(ledger):
    got = windows.row_numbers(ledger, ["k"], [F.col("id")], [F.col("day")], "n")
    seen = defaultdict(int)
    for r in got.orderBy("id").collect():
        seen[r["k"]] += 1
        assert r["n"] == seen[r["k"]]


def test_best_per_key_limits_before_the_shuffle(ledger):
    best = windows.best_per_key(ledger, ["k"], [F.col("v").desc(), F.col("id")])
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()
    expected = {}
    for i, k, _, v, _ in skewed():
        if k not in expected or (-v, i) < expected[k]:
            expected[k] = (-v, i)
    assert {r["k"]: (-r["v"], r["id"]) for r in best.collect()} == expected
    assert rows(windows.best_per_key(best, ["k"], [F.col("v").desc(), F.col("id")])) == rows(best)


def test_latest_per_key_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 5, 4)], "k string, d int, id int")
    assert sorted(r["id"] for r in windows.latest_per_key(df, ["k"], "d").collect()) == [2, 3, 4]


def test_dense_key_numbers_along_the_order(ledger):
    keyed = dense_key(ledger, [F.col("k"), F.col("v"), F.col("id")], "sk").collect()
    ordered = sorted(keyed, key=lambda r: (r["k"], r["v"], r["id"]))
    assert [r["sk"] for r in ordered] == list(range(1, 3001))


def test_dense_key_spreads_copies(spark):
    """Two thirds of the rows are copies of one row, and still fill many partitions."""
    data = [("copy", 1)] * 4000 + [(f"k{i:04d}", i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, v int").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    keyed = dense_key(df, [F.col("k"), F.col("v")], "sk", steady=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = keyed.collect()
    assert sorted(r["sk"] for r in got) == list(range(1, 6001))
    assert {r["sk"] for r in got if r["k"] == "copy"} == set(range(1, 4001))
    holding = [f for f in keyed.inputFiles() if not spark.read.parquet(f).where("k = 'copy'").isEmpty()]
    assert len(holding) > 1


def test_dense_key_writes_once_and_keeps_its_numbers(spark):
    import os

    from tallymill.session import work_dir

    data = [(f"k{i % 700:04d}", i % 3) for i in range(5000)]
    df = spark.createDataFrame(data, "k string, v int").repartition(5).groupBy("k", "v").count()
    folder = f"{work_dir(spark)}/tallymill"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    keyed = dense_key(df, [F.col("v")], "sk")
    assert len(set(os.listdir(folder)) - before) == 1
    first = {(r["k"], r["v"]): r["sk"] for r in keyed.collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # other splits, the same numbers
    again = {(r["k"], r["v"]): r["sk"] for r in keyed.collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert first == again and sorted(first.values()) == list(range(1, len(first) + 1))
    assert [v for (_, v), _ in sorted(first.items(), key=lambda x: x[1])] == sorted(v for _, v in first)
    assert dense_key(df.limit(0), [F.col("v")], "sk").collect() == []


def test_lag_without_keys_has_no_task_with_all_chunks(spark):
    data = [(i, None if i % 3 else str(i), i // 4) for i in range(400) if i % 50 < 30]
    df = spark.createDataFrame(data, "id int, x string, c int").repartition(4)
    out = windows.lag_fill(df, "x", [F.col("id")], [F.col("c")])
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    ordered, filled = [x for _, x, _ in data], {}
    for (i, x, _), was in zip(data, [None, *ordered]):
        filled[i] = x if x is not None else was
    assert {r["id"]: r["x"] for r in out.collect()} == filled
    moved = windows.running_windows(
        spark.range(300).withColumn("v", F.col("id") * 2), [windows.Level((), moving={"m": ("v", 5)})], [F.col("id")], [F.floor(F.col("id") / 3)]
    )
    assert {r["id"]: r["m"] for r in moved.collect()} == {i: sum(2 * j for j in range(max(0, i - 4), i + 1)) for i in range(300)}


DAY = date(2020, 1, 1)


def brute(vers, day):
    """The winner on a day: latest start, then the smallest number."""
    live = [(-(f - DAY).days, n) for n, f, t in vers if f <= day <= t]
    return min(live)[1] if live else None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 20), st.integers(0, 12)), min_size=1, max_size=12
    )
)
def test_disjoint_periods_match_a_day_by_day_search(spark, spans):
    vers = [(k, n, DAY + timedelta(f), DAY + timedelta(f + w)) for n, (k, f, w) in enumerate(spans)]
    df = spark.createDataFrame(vers, "k string, n int, valid_from date, valid_to date")
    out = versions.disjoint_periods(df, "k", "n", ["n"]).collect()
    for k in "ab":
        mine = [(n, f, t) for key, n, f, t in vers if key == k]
        for offset in range(36):
            day = DAY + timedelta(offset)
            hits = [r["n"] for r in out if r["k"] == k and r["valid_from"] <= day <= r["valid_to"]]
            want = brute(mine, day)
            assert hits == ([] if want is None else [want])


def test_four_thousand_versions_of_one_key(spark):
    """Chained, and with a base version that comes back after every later one."""
    n = 4000
    chain = [("chain", i, DAY + timedelta(i), DAY + timedelta(i + 3)) for i in range(n)]
    nested = [("nest", n, DAY, DAY + timedelta(3 * n))] + [("nest", i, DAY + timedelta(3 * i + 1), DAY + timedelta(3 * i + 1)) for i in range(n)]
    df = spark.createDataFrame(chain + nested, "k string, n int, valid_from date, valid_to date")
    out = versions.disjoint_periods(df, "k", "n", ["n"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    got = {(r["k"], r["valid_from"]): (r["n"], r["valid_to"]) for r in out.collect()}
    assert len(got) == n + 2 * n + 1
    for i in range(n - 1):
        assert got["chain", DAY + timedelta(i)] == (i, DAY + timedelta(i))
        assert got["nest", DAY + timedelta(3 * i + 1)] == (i, DAY + timedelta(3 * i + 1))
        assert got["nest", DAY + timedelta(3 * i + 2)] == (n, DAY + timedelta(3 * i + 3))


def test_hot_key_meets_its_versions_by_month(spark):
    vers = [("hot", n, DAY + timedelta(n * 31), DAY + timedelta(n * 31 + 30)) for n in range(40)]
    vers[-1] = ("hot", 39, DAY + timedelta(39 * 31), date(9999, 12, 31))
    facts = [(i, "hot", DAY + timedelta(i - 40)) for i in range(1500)] + [(5000, None, DAY), (5001, "hot", None)]
    v = spark.createDataFrame(vers, "k string, n int, valid_from date, valid_to date")
    f = spark.createDataFrame(facts, "id int, k string, day date")
    periods = versions.by_month(v, "k")
    assert periods.rows.count() < 3 * len(vers)  # an open end is no thousands of months
    joined = versions.point_in_time_join(f, periods, "day", ["n"])
    assert "_pm" in joined._jdf.queryExecution().optimizedPlan().toString()
    for r in joined.collect():
        days = (r["day"] - DAY).days if r["day"] and r["k"] else -1
        assert r["n"] == (min(days // 31, 39) if days >= 0 else None)


def test_point_in_time_joins_agree_and_keep_the_row_count(spark):
    rng = random.Random(3)
    vers = [("hot", n, DAY + timedelta(n * 5), DAY + timedelta(n * 5 + rng.randint(0, 40))) for n in range(30)]
    facts = [(i, "hot" if i % 3 else "cold", DAY + timedelta(rng.randint(-5, 200))) for i in range(600)]
    v = spark.createDataFrame(vers, "k string, n int, valid_from date, valid_to date")
    f = spark.createDataFrame(facts, "id int, k string, day date")
    periods = versions.disjoint_periods(v, "k", "n", ["n"])
    a = versions.point_in_time_join(f, versions.by_month(periods, "k"), "day", ["n"])
    b = versions.point_in_time_guarded(f, v, "k", "day", ["id"], "n")
    assert a.count() == 600
    assert rows(a) == rows(b)
    mine = [(n, x, y) for _, n, x, y in vers]
    assert all(r["n"] == (brute(mine, r["day"]) if r["k"] == "hot" else None) for r in a.collect())


def test_unpack_order(spark):
    data = [
        ("a", "Card", "Paid", "-10.5"),
        ("b", "150", "Card", "Paid,20"),
        ("c", "x", "-90", "Card, Paid,30"),
        ("d", "Card", "Paid", None),
        ("e", "Card", "Paid", "1,2,3,4"),
        ("f", "70", None, "nope"),
        ("g", "Card", "Paid", ""),
    ]
    df = spark.createDataFrame(data, "order_id string, payment_method string, status string, total_amount string")
    out = {
        r["order_id"]: (float(r["delivery_fee"]), r["payment_method"], r["order_status"], float(r["amount"]))
        for r in repair.unpack_order(df).collect()
    }
    assert out == {
        "a": (0, "Card", "Paid", 10.5),
        "b": (150, "Card", "Paid", 20),
        "c": (90, "Card", "Paid", 30),
        "d": (0, "Unknown", None, 0),
        "e": (0, "Unknown", None, 0),
        "f": (70, "70", None, 0),
        "g": (0, "Card", "Paid", 0),
    }


def test_quality(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (2, None)], "id int, x double")
    kept, rejected = quality.gate(df, F.col("x") >= 0)
    assert (kept.count(), rejected.count()) == (1, 2)
    assert rows(quality.duplicate_keys(df, ["id"])) == [(2, 2)]
    assert rows(quality.violations(df, {"x_ok": F.col("x") >= 0})) == [("x_ok", 1)]
    lines = {r["source"]: (r["row_count"], r["percentage"]) for r in quality.reconcile(df, kept).collect()}
    assert lines == {
        "Source Bronze": (3, "100.00%"),
        "Target Silver": (1, "33.33%"),
        "Missing Rows": (2, "66.67%"),
    }
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(quality.unmatched_keys(df, dim, "id", "k")) == [(2, 2)]


def test_movements_without_a_readable_date_are_kept_apart(spark):
    from tallymill.plans.silver_stock import inventory_movements

    columns = "movement_id string, movement_date string, store_id string, product_id string, movement_type string, quantity string, unit_cost_kes string"
    raw = spark.createDataFrame(
        [("M1", "2024-01-02", "S1", "P1", "IN", "3", "1"), ("M2", "31/12/2023", "S1", "P1", "IN", "4", "1")], columns
    )
    found = {r["movement_id"]: r for r in inventory_movements(raw).collect()}
    assert found["M2"]["quality_flag"] == "Unreadable value" and found["M2"]["running_quantity"] is None
    assert found["M1"]["quality_flag"] != "Unreadable value" and found["M1"]["running_quantity"] == 3


def test_quarantined_movements_keep_what_mends_them(spark):
    from tallymill.plans.silver_stock import inventory_movements
    from tallymill.plans.tables import SILVER

    columns = "movement_id string, movement_date string, store_id string, product_id string, movement_type string, quantity string, unit_cost_kes string"
    raw = spark.createDataFrame(
        [("M1", "2024-01-02", "S1", "P1", "IN", "3", "1"), ("M2", "31/12/2023", "S1", "P1", "IN", "4", "2.5"), ("M3", "?", "S1", "P1", "IN", "four", "x")],
        columns,
    )
    flagged = inventory_movements(raw)
    found = {r["movement_id"]: r for r in flagged.collect()}
    kept = ("quantity", "unit_cost_kes", "movement_value_kes", *SILVER["inventory_movements"].evidence)
    assert [found["M2"][c] for c in kept] == [4.0, 2.5, 10.0, "31/12/2023", "4", "2.5"]
    assert [found["M3"][c] for c in kept] == [None, None, None, "?", "four", "x"]
    assert [found["M1"][c] for c in kept] == [3.0, 1.0, 3.0, None, None, None]


def test_a_snapshot_rewrites_the_months_that_a_batch_touches(spark):
    import tempfile

    from tallymill.operators import accumulate

    path = tempfile.mkdtemp() + "/s"
    lines = [(i, date(2024, 1 + i % 3, 1)) for i in range(30)] + [(99, None)]
    lines = accumulate.by_month(spark.createDataFrame(lines, "k int, day date"), "day")
    early = spark.createDataFrame([(i, date(2024, 5, i + 1)) for i in range(12)], "k int, got date")
    later = spark.createDataFrame([(0, date(2024, 6, 1)), (3, date(2024, 4, 1)), (99, date(2024, 6, 2)), (500, DAY)], "k int, got date")
    measures = {"first": F.min("got"), "last": F.max("got"), "n": F.count("got")}
    assert accumulate.accumulate(lines, early, path, ["k"], measures) is None
    for _ in range(2):  # a batch that comes again changes nothing
        every = early.unionByName(later)
        assert accumulate.accumulate(lines, every, path, ["k"], measures, batch=later) == ["2024-01", "unknown"]
        found = spark.read.parquet(path)
        assert rows(found.select("k", "first", "last", "n")) == rows(
            lines.join(every.groupBy("k").agg(*[m.alias(n) for n, m in measures.items()]), "k", "left").select("k", "first", "last", "n")
        )


def test_running_sums_go_on_from_a_state(ledger):
    from tallymill.operators import accumulate

    level = windows.Level(("k",), sums={"total": "v", "n": "one"})
    rows_ = ledger.withColumn("one", F.lit(1).cast("long"))
    whole = windows.running_windows(rows_, [level], [F.col("id")], [F.col("day")])
    state, parts = None, []
    for low, high in ((0, 700), (700, 701), (701, 3000)):
        batch = rows_.where((F.col("id") >= low) & (F.col("id") < high))
        parts.append(accumulate.running_sums_from(batch, level, [F.col("id")], [F.col("day")], state))
        state = accumulate.next_state(batch, level, state)
    assert rows(parts[0].unionByName(parts[1]).unionByName(parts[2])) == rows(whole)


def test_long_periods_make_few_rows_and_no_broadcast_beyond_its_size(spark, monkeypatch):
    vers = [(k, n, date(2016, 1, 1) if n == 0 else date(2024, 1, 10), date(2024, 1, 9) if n == 0 else date(2024, 6, 30)) for k in range(50) for n in (0, 1)]
    v = spark.createDataFrame(vers, "k int, n int, valid_from date, valid_to date")
    f = spark.createDataFrame([(i, i % 60, date(2015, 12, 1) + timedelta(i * 7)) for i in range(460)], "id int, k int, day date")
    periods = versions.by_month(v, "k")
    assert periods.rows.count() == periods.n_rows <= 1.5 * len(vers)  # by months they were over 5,000
    for most in (10**6, 10):
        monkeypatch.setattr(versions, "_BROADCAST_ROWS", most)
        joined = versions.point_in_time_join(f, periods, "day", ["n"])
        assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) == (most > 10)
        for r in joined.collect():
            known = r["k"] < 50 and date(2016, 1, 1) <= r["day"] <= date(2024, 6, 30)
            assert r["n"] == (int(r["day"] >= date(2024, 1, 10)) if known else None)
