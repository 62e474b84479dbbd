import random
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from cdcmart.operators import reconcile
from cdcmart.operators.reconcile import ADDED, KEY_COUNT, LOST, ROW_COUNT

SCHEMA = "k string, x int, net_amount_local decimal(38,9), created_at timestamp"
SUM = "parity: sum(net_amount_local)"


def table(spark, data):
    df = spark.createDataFrame([(k, x, None if m is None else Decimal(m)) for k, x, m in data], "k string, x int, net_amount_local decimal(38,9)")
    return df.withColumn("created_at", F.lit("2024-01-05").cast("timestamp"))


def verdict(a, b, **options):
    return {r["check_name"]: r["failing_rows"] for r in reconcile.abcd_verdict(a, b, ["k"], **options).collect()}


def report(a, b, cols=("x",)):
    return {r["check_name"]: r["failing_rows"] for r in reconcile.parity_report(a, b, ["k"], cols).collect()}


def test_equal_tables_pass(spark):
    a = table(spark, [("a", 1, "1.5"), ("b", 2, "2")])
    assert verdict(a, a) == {LOST: 0, ADDED: 0, ROW_COUNT: 0, KEY_COUNT: 0, SUM: 0}
    assert set(report(a, a).values()) == {0}


def test_checks_are_sorted(spark):
    a = table(spark, [("a", 1, "1")])
    names = [r["check_name"] for r in reconcile.abcd_verdict(a, a, ["k"]).collect()]
    assert names == sorted(names)


# One injected fault per row: what is wrong with b, and the checks it must show up in.
@pytest.mark.parametrize(
    ("b", "expected"),
    [
        ([("a", 1, "1")], {LOST: 1, ADDED: 0, ROW_COUNT: 1, KEY_COUNT: 1, SUM: 2}),
        ([("a", 1, "1"), ("b", 2, "2"), ("c", 3, "0")], {LOST: 0, ADDED: 1, ROW_COUNT: 1, KEY_COUNT: 1, SUM: 0}),
        ([("a", 1, "1"), ("b", 2, "2"), ("b", 2, "0")], {LOST: 0, ADDED: 0, ROW_COUNT: 1, KEY_COUNT: 0, SUM: 0}),
        ([("a", 1, "1"), ("b", 2, "2.49")], {LOST: 0, ADDED: 0, ROW_COUNT: 0, KEY_COUNT: 0, SUM: 0}),
        ([("a", 1, "1"), ("b", 2, "2.495")], {LOST: 0, ADDED: 0, ROW_COUNT: 0, KEY_COUNT: 0, SUM: 1}),
    ],
)
def test_injected_faults(spark, b, expected):
    assert verdict(table(spark, [("a", 1, "1"), ("b", 2, "2")]), table(spark, b)) == expected


def test_swapping_sides_swaps_lost_and_added(spark):
    a, b = table(spark, [("a", 1, "1"), ("b", 1, "1"), ("c", 1, "1")]), table(spark, [("a", 1, "1")])
    forward, back = verdict(a, b), verdict(b, a)
    assert (forward[LOST], forward[ADDED]) == (back[ADDED], back[LOST]) == (2, 0)


def test_null_keys_never_match(spark):
    a = table(spark, [(None, 1, "1"), (None, 1, "1")])
    got = verdict(a, a)
    assert (got[LOST], got[ADDED], got[KEY_COUNT]) == (2, 2, 0)


def test_sum_over_nothing_is_null_and_counts_are_zero(spark):
    a = table(spark, [("a", 1, "1")])
    got = verdict(a, a.where("false"))
    assert got[SUM] is None and got[LOST] == 1 and got[ADDED] == 0
    empty = verdict(a.where("false"), a.where("false"))
    assert empty[LOST] == empty[ROW_COUNT] == 0 and empty[SUM] is None


def test_exact_sum_sees_the_ninth_decimal(spark):
    a, b = table(spark, [("a", 1, "1.000000001")]), table(spark, [("a", 1, "1")])
    assert verdict(a, b, exact_sum=True)[f"{SUM}, exact"] == 1


def test_only_in_keeps_duplicates_and_null_keys(spark, rows):
    a, b = table(spark, [("a", 1, "1"), ("a", 2, "1"), ("b", 3, "1"), (None, 4, "1")]), table(spark, [("b", 9, "1"), (None, 9, "1")])
    assert rows(reconcile.only_in(a, b, ["k"]), "x") == [(1,), (2,), (4,)]


def test_null_on_one_side_is_divergence_null_on_both_is_not(spark):
    a = table(spark, [("a", None, "1"), ("b", None, "1"), ("c", 1, "1")])
    b = table(spark, [("a", 1, "1"), ("b", None, "1"), ("c", 1, "1")])
    assert report(a, b)["rows_with_field_divergence"] == 1


def test_live_is_restricted_to_the_dates_of_the_baseline(spark):
    a = table(spark, [("a", 1, "1")])
    live = a.unionByName(table(spark, [("later", 1, "5")]).withColumn("created_at", F.lit("2024-01-06").cast("timestamp")))
    assert report(a, live) == {
        "rows_only_in_baseline": 0,
        "rows_only_in_live": 0,
        "rows_with_field_divergence": 0,
        "sum_net_amount_diff_cents": 0,
    }


def test_money_gap_in_cents(spark):
    assert report(table(spark, [("a", 1, "1.236")]), table(spark, [("a", 1, "1")]))["sum_net_amount_diff_cents"] == 24


def test_all_columns(spark):
    a, b = table(spark, [("a", 1, "1")]), table(spark, [("a", 1, "2")])
    assert report(a, b, ["x"])["rows_with_field_divergence"] == 0
    assert report(a, b, "all")["rows_with_field_divergence"] == 1


def test_counting_pairs_equals_joining_them(spark, rows):
    """Random tables with repeated and NULL keys, against a nested loop."""
    rng = random.Random(5)

    def draw(n):
        return [(rng.choice(["a", "b", "c", "d", None]), rng.choice([1, 2, None]), str(rng.randint(0, 3))) for _ in range(n)]

    for _ in range(3):
        da, db = draw(14), draw(11)
        pairs = {}
        for (ka, xa, _), (kb, xb, _) in product(da, db):
            if ka is not None and ka == kb and xa != xb:
                pairs[ka] = pairs.get(ka, 0) + 1
        a, b = table(spark, da), table(spark, db)
        found = rows(reconcile.diverging(a, b, ["k"], ["x"]), "k", "diverging_rows")
        assert found == sorted(pairs.items())
        got = report(a, b)
        assert got["rows_with_field_divergence"] == sum(pairs.values())
        keys_a, keys_b = {k for k, *_ in da} - {None}, {k for k, *_ in db} - {None}
        assert got["rows_only_in_baseline"] == sum(k not in keys_b for k, *_ in da)
        assert got["rows_only_in_live"] == sum(k not in keys_a for k, *_ in db)


def test_reports_do_not_join(spark):
    a = table(spark, [("a", 1, "1")])
    for df in (reconcile.abcd_verdict(a, a, ["k"]), reconcile.parity_report(a, a, ["k"], ["x"])):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_profile(spark):
    row = reconcile.profile(table(spark, [("a", 1, "1.5"), ("a", 1, "2"), (None, 1, None)]), "k", "created_at", "net_amount_local").first()
    assert (row["check_name"], row["total_rows"], row["distinct_keys"]) == ("baseline_snapshot", 3, 1)
    assert row["sum_net_amount_local"] == Decimal("3.5")


def lagged(spark, seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint")
    return df.select(
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
        F.struct(F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.col("s")).alias("source_timestamp")).alias("datastream_metadata"),
    )


def test_lag_quantiles_against_sorting(spark):
    rng = random.Random(3)
    seconds = [rng.choice([0, 0, 0, 60, rng.randint(-100_000, 400_000)]) for _ in range(301)]
    quantiles = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["quantile"]: r["lag_seconds"] for r in reconcile.lag_profile(lagged(spark, seconds), quantiles).collect()}
    ordered = sorted(seconds)
    for q in quantiles:
        at = q * (len(ordered) - 1)
        low = int(at)
        high = min(low + 1, len(ordered) - 1)
        assert got[q] == pytest.approx(ordered[low] + (ordered[high] - ordered[low]) * (at - low))


def test_lag_profile_approx(spark):
    got = {r["quantile"]: r["lag_seconds"] for r in reconcile.lag_profile_approx(lagged(spark, range(1000))).collect()}
    assert got[1.0] == 999 and abs(got[0.5] - 500) <= 2


def test_gaps_are_rounded_once(spark):
    gaps = spark.createDataFrame([(Decimal("0.004999999"),), (Decimal("0.005"),), (Decimal("12345678901.995000001"[:21]),)], "g decimal(38,9)")
    assert [r[0] for r in gaps.select(reconcile._cents(F.col("g"))).collect()] == [0, 1, 1234567890200]


def test_exact_sum_of_a_large_gap(spark):
    a = spark.createDataFrame([("k", Decimal(10**12))], "k string, m decimal(38,9)")
    b = spark.createDataFrame([("k", Decimal(1))], "k string, m decimal(38,9)")
    found = {r["check_name"]: r["failing_rows"] for r in reconcile.abcd_verdict(a, b, ["k"], "m", exact_sum=True).collect()}
    assert found["parity: sum(m), exact"] == (10**12 - 1) * 10**9
