"""SCD-2, serving masks, data-quality checks, report filters and scalar helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealstream import constants as K
from dealstream.functions import scalar as S
from dealstream.operators import quality as Q
from dealstream.operators import report as R
from dealstream.operators import scd as SCD
from dealstream.operators import serve as SV

CUR_SCHEMA = ("trade_id bigint, version bigint, product_type string, counterparty string, trader string, "
              "book string, currency string, notional double, price double, trade_date date, "
              "maturity_date date, processed_at timestamp_ntz")
T1 = dt.datetime(2026, 1, 1)
T2 = dt.datetime(2026, 2, 1)


def row(trade, version=1, notional=100.0, trade_date=dt.date(2025, 1, 1), processed=T1):
    return (trade, version, "IRS", "CP", "TR", "BK", "USD", notional, 1.0, trade_date, dt.date(2027, 1, 1),
            processed)


def test_scd_trade_date_only_change_opens_no_row(spark):
    h1 = SCD.scd2_apply(None, spark.createDataFrame([row(1), row(2)], CUR_SCHEMA), S.lit_ts(T1))
    cur2 = spark.createDataFrame([row(1, trade_date=dt.date(2025, 6, 1), processed=T2)], CUR_SCHEMA)
    h2 = SCD.scd2_apply(h1, cur2, S.lit_ts(T2)).collect()
    assert len(h2) == 2
    assert all(r.valid_to is None for r in h2)  # trade 2 missing from current: stays open


def test_scd_change_closes_and_opens(spark):
    h1 = SCD.scd2_apply(None, spark.createDataFrame([row(1)], CUR_SCHEMA), S.lit_ts(T1))
    h2 = SCD.scd2_apply(h1, spark.createDataFrame([row(1, version=2, notional=5.0)], CUR_SCHEMA),
                        S.lit_ts(T2)).orderBy("valid_from").collect()
    assert [(r.version, r.valid_from, r.valid_to) for r in h2] == [(1, T1, T2), (2, T2, None)]
    assert h2[0].updated_at == T1


def test_scd_one_pass_equals_runs(spark):
    acc_schema = CUR_SCHEMA + ", message_id string, batch_id bigint"
    acc = spark.createDataFrame([
        row(1) + ("a", 0), row(1, version=2) + ("b", 1), row(1, version=2, trade_date=dt.date(2025, 3, 3)) + ("c", 2),
        row(2) + ("d", 2), row(3) + ("e", 5)], acc_schema)
    hist = SCD.scd2_history(acc, [(0, T1), (2, T2)]).orderBy("trade_id", "valid_from").collect()
    assert [(r.trade_id, r.version, r.valid_from, r.valid_to) for r in hist] == [
        (1, 1, T1, T2), (1, 2, T2, None), (2, 1, T2, None)]  # trade 3 arrives after the last snapshot


REPORT_SCHEMA = "trade_id bigint, counterparty string, notional double, notional_usd double, currency string"


def test_masking_roles(spark):
    df = spark.createDataFrame([(1, "ACME", 1_499_999.0, 1_620_000.0, "EUR"), (2, None, 2_500_000.0, None, "XXX")],
                               REPORT_SCHEMA)
    objs = {"deal_report": df, "valid_fact": df}
    masked = {r.trade_id: r for r in SV.serve(objs, "deal_report", "analyst").collect()}
    assert masked[1].notional == 1_000_000.0 and masked[1].notional_usd == 2_000_000.0
    assert masked[2].notional == 3_000_000.0  # half away from zero
    assert masked[1].counterparty.startswith("CPTY_") and len(masked[1].counterparty) == 11
    assert masked[2].counterparty is None
    full = SV.serve(objs, "deal_report", "COMPLIANCE").collect()
    assert {r.notional for r in full} == {1_499_999.0, 2_500_000.0}
    with pytest.raises(SV.AccessDenied):
        SV.serve(objs, "valid_fact", "ANALYST")
    with pytest.raises(SV.AccessDenied):
        SV.serve(objs, "deal_report", "SOME_UNKNOWN_ROLE")


def test_pseudonym_is_stable_across_views(spark):
    df = spark.createDataFrame([(1, "ACME", 1.0, 1.0, "USD")], REPORT_SCHEMA)
    a = SV.serve({"deal_status": df}, "deal_status", "ANALYST").first().counterparty
    b = SV.serve({"deal_report": df}, "deal_report", "ANALYST").first().counterparty
    assert a == b


def test_quality_null_semantics(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "z"), (None, "z")], "k int, v string")
    assert Q.check_not_null(df, "k").count() == 2
    assert [r.k for r in Q.check_unique(df, "k").collect()] == [1]  # NULLs ignored
    assert Q.check_accepted(df, "v", ["a"]).count() == 2          # NULL passes, 'z' twice fails
    parent = spark.createDataFrame([(1,)], "pk int")
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    assert [r.fk for r in Q.check_relationship(child, "fk", parent, "pk").collect()] == [2]


def test_report_filter_empty_lists_and_half_ranges(spark):
    df = spark.createDataFrame([("A", "ACTIVE", dt.date(2025, 1, 1), dt.date(2026, 1, 1)),
                                ("B", "EXPIRED", dt.date(2025, 2, 1), dt.date(2024, 1, 1))],
                               "trader string, trade_status string, trade_date date, maturity_date date")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("book", "counterparty", "product_type",
                                                                         "currency")])
    assert R.report_filter(df, traders=[], statuses=None).count() == 2
    assert R.report_filter(df, trade_range=(dt.date(2025, 1, 15), None)).count() == 2
    assert R.report_filter(df, trade_range=(dt.date(2025, 1, 1), dt.date(2025, 1, 1))).count() == 1
    assert R.report_filter(df, statuses=[K.EXPIRED]).count() == 1


def py_money(value):
    sign = "-" if value < 0 else ""
    a = abs(value)
    for threshold, suffix in K.MONEY_SUFFIXES:
        if a >= threshold:
            return f"{sign}${a / threshold:,.2f}{suffix}"
    return f"{sign}${a:,.0f}"


def test_format_money_matches_python_away_from_halves(spark):
    vals = [44_755_314_601.0, -1_234_567.0, 999.4, 0.0, 12_345.0, 3.2e12, -15.0, 1_000.0]
    got = spark.createDataFrame([(v,) for v in vals], "x double").select(
        "x", S.format_money("x").alias("t")).collect()
    for r in got:
        assert r.t == py_money(r.x), r.x


def test_age_text(spark):
    now = dt.datetime(2026, 1, 1, 12, 0)
    df = spark.createDataFrame([(now - dt.timedelta(minutes=59, seconds=59),), (now - dt.timedelta(hours=5, minutes=3),),
                                (None,)], "ts timestamp_ntz")
    got = [r.a for r in df.select(S.age_text("ts", now).alias("a")).collect()]
    assert got == ["59 min ago", "5.1 hours ago", "No data yet"]


def test_minutes_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1, 10, 59, 59), dt.datetime(2026, 1, 1, 11, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(S.minutes_between("a", "b").alias("m")).first().m == 1


def test_to_usd_unknown_currency_is_null(spark):
    df = spark.createDataFrame([(100.0, "EUR"), (100.0, "XXX")], "n double, c string")
    got = [r.u for r in df.select(S.to_usd("n", "c").alias("u")).collect()]
    assert got == [100.0 * 1.08, None]


def test_layout_overlap_equals_pairwise_count(spark):
    """Rank counting over bucketed running sums equals counting overlapping
    pairs, with many more endpoints than buckets, shared endpoints and an
    all-NULL group (left out)."""
    import random

    from dealstream.operators import runlog as RL

    rnd = random.Random(7)
    rows = []
    for g in range(150):
        for _ in range(rnd.randint(1, 4)):
            rows.append((f"f{g:03d}", dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))))
    rows.append(("f_null", None))
    df = spark.createDataFrame(rows, "file_name string, k date")
    got = {r["file_name"]: (r["lo"], r["hi"], r["overlapping_groups"])
           for r in RL.layout_overlap(df, "file_name", "k", buckets=8).collect()}
    ranges = {}
    for f, k in rows:
        if k is not None:
            lo, hi = ranges.get(f, (k, k))
            ranges[f] = (min(lo, k), max(hi, k))
    want = {f: (lo, hi, sum(1 for g, (l2, h2) in ranges.items() if g != f and l2 <= hi and lo <= h2))
            for f, (lo, hi) in ranges.items()}
    assert got == want


def test_running_sums_are_exact_across_buckets(spark):
    from dealstream.operators import runlog as RL

    df = spark.range(1, 1001).select(F.col("id").alias("v"), (F.col("id") % 3).alias("n"))
    got = {r["v"]: r["n_le"] for r in RL.running_sums(df, "v", ("n",), buckets=16).collect()}
    acc, want = 0, {}
    for v in range(1, 1001):
        acc += v % 3
        want[v] = acc
    assert got == want


def test_upsert_touches_only_changed_keys_and_null_key_is_one_key(spark):
    from dealstream.operators import state as STT

    state = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], "k int, v string, ts int")
    changes = spark.createDataFrame([(2, "b2", 2), (2, "b_old", 0), (3, "c", 2), (None, "n2", 2)],
                                    "k int, v string, ts int")
    out = STT.upsert_latest(state, changes, ("k",), (F.col("ts").desc(),))
    assert sorted((r.k if r.k is not None else -1, r.v) for r in out.collect()) == \
        [(-1, "n2"), (1, "a"), (2, "b2"), (3, "c")]


def test_running_sums_on_string_keys(spark):
    """String keys are bucketed through an order-preserving byte prefix;
    shared prefixes, short strings and non-ASCII text stay exact."""
    import random

    from dealstream.operators import runlog as RL

    rnd = random.Random(3)
    alphabet = ["a", "b", "ab", "é", "z", "zz", "0", " "]
    vals = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12))) for _ in range(400)},
                  key=lambda x: x.encode("utf-8"))
    df = spark.createDataFrame([(v, 1) for v in vals], "v string, n int")
    got = {r["v"]: r["n_le"] for r in RL.running_sums(df, "v", ("n",), buckets=8).collect()}
    assert got == {v: i + 1 for i, v in enumerate(vals)}


def test_age_text_has_no_thousands_mark_and_null_days_do_not_count(spark):
    from dealstream.functions import scalar as S
    from dealstream.operators import report as R

    now = dt.datetime(2024, 6, 1)
    df = spark.createDataFrame([(now - dt.timedelta(hours=3648),)], "ts timestamp_ntz")
    assert df.select(S.age_text("ts", now).alias("t")).first().t == "3648.0 hours ago"
    days = spark.createDataFrame([(None,), (None,), (dt.date(2024, 1, 2),)], "trade_date date")
    assert tuple(R.busiest_day(days).first()) == (dt.date(2024, 1, 2), 1, 1)


def test_rate_file_with_a_bad_line_is_skipped_whole(spark, tmp_path):
    from dealstream.sources import ingest as I

    (tmp_path / "good.csv").write_text("d,c,r\n2024-01-01,EUR,1.1\n")
    (tmp_path / "bad.csv").write_text("d,c,r\n2024-01-01,GBP,1.3\n2024-01-02,GBP,oops\n")
    raw = I.ingest_rates_csv(spark, f"file://{tmp_path}")
    good, report = I.split_bad_files(raw, F.col("_corrupt_record").isNotNull())
    assert [r.currency for r in good.collect()] == ["EUR"] and [r.file_name for r in report.collect()] == ["bad.csv"]
