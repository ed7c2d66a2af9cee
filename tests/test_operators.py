from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillcast.operators import comparison, counts, geo, ranking, series, shares
from quillcast.functions.time import minute_bucket, minute_of_day
from quillcast.operators.counts import labelled

FACTS = (
    "id bigint, ts timestamp, lang string, rt_id bigint, rt_ts timestamp, rt_lang string, "
    "rt_screen_name string, rt_text string"
)
NOON = datetime(2018, 10, 29, 12)


def facts(spark, rows):
    """Rows of (seconds after noon, lang, rt_id, rt_lang)."""
    full = [
        (
            i, NOON + timedelta(seconds=at), lang, rt_id, NOON if rt_id is not None else None, rt_lang,
            f"u{rt_id}" if rt_lang is not None else None, f"t{rt_id}" if rt_id is not None else None,
        )
        for i, (at, lang, rt_id, rt_lang) in enumerate(rows)
    ]
    return spark.createDataFrame(full, FACTS)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all posts lies in one window, reposts one post and has one language."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(6000):
        if rng.random() < 1 / 3:
            rows.append((10, "en", 1, "en"))
        else:
            repost = int(rng.integers(2, 400)) if rng.random() < 0.5 else None
            author = [None, "de", "ja", "en"][repost % 4] if repost else None
            rows.append((int(rng.integers(0, 86_400)), [None, "de", "ja", "en"][rng.integers(0, 4)], repost, author))
    return rows, facts(spark, rows).repartition(16, "id").cache()


def window_of(at, size=900):
    return NOON + timedelta(seconds=at // size * size)


def test_counts_by_brute_force(skewed):
    rows, frame = skewed
    got = labelled(counts.reposts_per_post(frame)).collect()
    expected = Counter((window_of(at), rt) for at, _, rt, _ in rows if rt is not None)
    assert {(r.window_start, r.rt_id): r.cnt for r in got} == expected
    two_stage = labelled(counts.totals_of_windows(counts.reposts_per_post(frame), "1 hour")).collect()
    expected = Counter(window_of(at, 3600) for at, _, rt, _ in rows if rt is not None)
    assert {r.window_start: r.cnt for r in two_stage} == expected


def test_sums_agree_between_metrics(skewed):
    _, frame = skewed
    frame = counts.by_language(counts.reposts(frame), "author", keep_no_lang=True)
    per_lang = counts.windowed(frame, "15 minutes", "lang").agg(F.count("*").alias("cnt"))
    total = {r.win: r.cnt for r in counts.reposts_per_window(frame).collect()}
    summed = {r.win: r.cnt for r in per_lang.groupBy("win").agg(F.sum("cnt").alias("cnt")).collect()}
    assert total == summed
    percent = shares.percentage_of_window(per_lang).groupBy("win").agg(
        F.sum("pct").alias("pct"), F.count("*").alias("n")
    )
    assert all(abs(r.pct - 100) <= 0.005 * r.n + 1e-9 for r in percent.collect())


def test_top_x_by_brute_force(skewed):
    rows, frame = skewed
    counted = Counter((window_of(at, 3600), rt) for at, _, rt, _ in rows if rt is not None)
    expected = set()
    for window in {w for w, _ in counted}:
        ranked = sorted(((-n, rt) for (w, rt), n in counted.items() if w == window))[:5]
        expected |= {(window, rt, -n) for n, rt in ranked}
    got = labelled(ranking.top_posts(frame, "1 hour", require_author=False)).collect()
    assert {(r.window_start, r.rt_id, r.cnt) for r in got} == expected
    assert all(r.text == f"t{r.rt_id}" for r in got)
    shown = labelled(ranking.top_posts(frame, "1 hour")).collect()
    assert {(r.window_start, r.rt_id, r.cnt) for r in shown} == {
        row for row in expected if row[1] == 1 or row[1] % 4
    }


def test_top_x_keeps_the_largest(spark):
    rows = [(1, "en", 7, "en")] * 3 + [(2, "en", 8, "en")] + [(3, "en", 9, "en")] * 4
    top = ranking.top_x(counts.reposts_per_post(facts(spark, rows)), 2).collect()
    assert {(r.rt_id, r.cnt) for r in top} == {(7, 3), (9, 4)}


def test_top_x_limits_groups_before_the_shuffle(skewed):
    _, frame = skewed
    plan = ranking.top_x(counts.reposts_per_post(frame))._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 5, Partial" in plan


def test_shown_payload_is_that_of_the_first_repost(spark):
    frame = facts(spark, [(5, "en", 7, "en"), (1, "en", 7, "en")]).withColumn(
        "rt_text", F.concat(F.lit("seen "), F.col("id"))
    )
    assert ranking.top_posts(frame).first().text == "seen 1"


def test_percentage(spark):
    rows = [(1, "x", 1, "de")] + [(1, "x", 2, "en")] * 2
    got = shares.percentage_of_window(counts.reposts_per_language(facts(spark, rows))).collect()
    assert {(r.lang, r.pct, r.cnt) for r in got} == {("de", 33.33, 1), ("en", 66.67, 2)}


def test_share(spark):
    rows = [(1, "en", 5, "ja")] + [(1, "en", None, None)] * 3 + [(1, "de", None, None)] * 4
    (row,) = shares.share_of_posts(facts(spark, rows)).collect()
    assert (row.lang, row.rt_total, row.tw_total, row.share) == ("en", 1, 4, 0.25)


def test_share_by_author_may_exceed_one_and_equals_the_join(skewed, spark):
    rows = [(1, "en", 5, "en"), (1, "de", 6, "en"), (1, "de", 7, None), (1, None, 8, "fr")]
    (row,) = shares.share_of_posts(facts(spark, rows), lang_of="author").collect()
    assert (row.lang, row.rt_total, row.tw_total, row.share) == ("en", 2, 1, 2.0)
    _, frame = skewed
    one = shares.share_of_posts(frame, lang_of="author")
    joined = shares.share_of_counts(counts.posts_per_language(frame), counts.reposts_per_language(frame))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, joined.collect()))
    retweeter = shares.share_of_posts(frame).collect()
    assert all(0 < r.share <= 1 for r in retweeter)


def test_no_language_is_kept_on_demand(spark):
    rows = [(1, None, 5, "ja"), (1, "en", 6, "ja")]
    assert {r.lang for r in shares.share_of_posts(facts(spark, rows)).collect()} == {"en"}
    kept = shares.share_of_posts(facts(spark, rows), keep_no_lang=True).collect()
    assert {r.lang for r in kept} == {"en", "no-lang"}


def test_max_share_takes_the_earliest_of_equals(spark):
    rows = [
        (3700, "en", 5, "x"), (3701, "en", None, None),  # 13:00, 1 of 2
        (10, "en", 5, "x"), (11, "en", 6, "x"), (12, "en", None, None), (13, "en", None, None),  # 2 of 4
        (7300, "en", None, None), (7301, "en", 5, "x"), (7302, "en", None, None),  # 1 of 3
    ]
    (row,) = labelled(shares.max_share(shares.share_of_posts(facts(spark, rows), "1 hour"), "1 day")).collect()
    assert tuple(row) == (datetime(2018, 10, 29), "en", 2, 4, 0.5)


def test_geo(spark):
    rows = [(1, "x", 1, lang) for lang in ("en", "de", "xx")]
    counted = counts.reposts_per_language(facts(spark, rows))
    capitals = spark.createDataFrame([("us", 38.5, -77.0), ("de", 52.5, 13.4)], "code string, lat double, lon double")
    got = {r.lang: (r.lat, r.lon) for r in geo.with_capital(counted, capitals).collect()}
    assert got == {"en": (38.5, -77.0), "de": (52.5, 13.4), "xx": (0.0, 0.0)}
    unknown = geo.unknown_languages(counted, capitals).collect()
    assert [tuple(r) for r in unknown] == [("xx", "xx", 1)]


def test_slots_and_buckets_do_not_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # Across the clock change of 28 October 2018, and before the epoch.
        rows = [(n, ms) for n, ms in enumerate((1_540_685_999_000, 1_540_686_000_000, 1_540_690_500_000, -61_000))]
        frame = spark.createDataFrame(rows, "n int, ms long").withColumn("ts", F.timestamp_millis("ms"))
        got = frame.orderBy("n").select(
            minute_of_day(F.col("ts")).alias("slot"), F.unix_millis(minute_bucket(F.col("ts"), 25)).alias("bucket")
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.slot for r in got] == [ms // 60_000 % 1440 // 15 * 15 for _, ms in rows]
    assert [r.bucket for r in got] == [ms // 3_600_000 * 3_600_000 + ms % 3_600_000 // 1_500_000 * 1_500_000 for _, ms in rows]


def test_comparison_uses_24_hours_and_the_latest_day(spark):
    def result(rows):
        return spark.createDataFrame(rows, "window_start timestamp, cnt bigint")

    live = result([(datetime(2018, 10, 29, 13, 20), 5), (datetime(2018, 10, 29, 20, 0), 6)])
    batch = result([
        (datetime(2018, 10, 7, 1, 15), 9), (datetime(2018, 10, 8, 13, 15), 4), (datetime(2018, 10, 7, 13, 15), 3),
    ])
    got = comparison.compare_totals(live, batch).orderBy("window_start").collect()
    assert [(r.cnt, r.batch_cnt) for r in got] == [(5, 4), (6, 0)]


def series_of(spark, counted, step=timedelta(minutes=1), key=None):
    rows = [(NOON + i * step, c) for i, c in enumerate(counted) if c is not None]
    frame = spark.createDataFrame(rows, "window_start timestamp, cnt bigint")
    return frame.withColumn("key", F.lit(key)) if key else frame


def recurrence(points, history=5, step=0.1):
    """The predictors one window after the other: {(type, window): prediction}."""
    out, past, v = {}, [], 0.0
    for at, cnt in points:
        x = at.timestamp() * 1000
        recent = [c for _, c in past[-history:]]
        xx = sum(a * a for a, _ in past)
        out[series.AVERAGE, at] = sum(recent) / len(recent) if recent else 0.0
        out[series.REGRESSION, at] = x * sum(a * b for a, b in past) / xx if len(past) >= 2 else 0.0
        out[series.TRACKING, at] = v
        past.append((x, cnt))
        v += step * (cnt - v)
    return out


def predicted(frame, *args, **kwargs):
    rows = series.predict(frame, *args, **kwargs).collect()
    assert all(r.deviation == r.cnt - r.prediction for r in rows)
    return rows


@pytest.mark.parametrize("key", [None, "key"])
def test_carried_state_goes_on(spark, key):
    """Cut anywhere, also inside a block and with a key that has no new windows."""
    counted = [int(n) for n in np.random.default_rng(4).integers(0, 50, 2500)]
    whole = series_of(spark, counted).withColumn("key", F.when(F.col("cnt") % 2 == 0, "a").otherwise("b"))
    whole = whole if key else whole.drop("key")
    started, before, got = NOON, None, []
    for size in (3, 700, 1, 1796):
        ended = started + timedelta(minutes=size)
        part = whole.filter((F.col("window_start") >= started) & (F.col("window_start") < ended))
        predictions, after = series.advance(part, before, series_key=key)
        got += [tuple(r) for r in predictions.collect()]
        before, started = spark.createDataFrame(after.collect(), after.schema), ended
    want = sorted(tuple(r) for r in series.predict(whole, series_key=key).collect())
    assert len(got) == len(want)
    for a, b in zip(sorted(got), want, strict=True):
        assert a[:-2] == b[:-2] and a[-2:] == pytest.approx(b[-2:], rel=1e-9, abs=1e-9)


def test_one_predictor_computes_no_other(spark):
    plan = series.predict(series_of(spark, [1, 2, 3]), types=[series.TRACKING])._jdf.queryExecution().optimizedPlan().toString()
    assert "recent" not in plan and "xx" not in plan


def test_golden_predictions(spark):
    rows = predicted(series_of(spark, [10, 20, 5, 7]))
    by_type = {
        t: [r.prediction for r in sorted(rows, key=lambda r: r.window_start) if r.prediction_type == t]
        for t in (series.AVERAGE, series.REGRESSION, series.TRACKING)
    }
    assert by_type[series.AVERAGE] == pytest.approx([0, 10, 15, 35 / 3])
    assert by_type[series.TRACKING] == pytest.approx([0, 1.0, 2.9, 3.11])
    assert by_type[series.REGRESSION][:2] == [0, 0]


def test_golden_regression(spark):
    start = datetime(1970, 1, 1)
    frame = spark.createDataFrame(
        [(start + timedelta(milliseconds=i + 1), c) for i, c in enumerate([10, 20, 5, 7])],
        "window_start timestamp, cnt bigint",
    )
    rows = [r for r in predicted(frame, "1 millisecond") if r.prediction_type == series.REGRESSION]
    got = [r.prediction for r in sorted(rows, key=lambda r: r.window_start)]
    assert got == pytest.approx([0, 0, 30, 18.571428571428573])


@pytest.mark.parametrize("density, step, history", [(1.0, 0.1, 5), (0.02, 0.1, 5), (0.001, 0.1, 7), (0.5, 0.9, 1), (0.3, 0.01, 3)])
def test_predictions_across_blocks(spark, density, step, history):
    rng = np.random.default_rng(5)
    length = 4000 if density >= 0.3 else 60_000
    at = [i for i in range(length) if rng.random() < density]
    points = [(NOON + timedelta(minutes=i), int(rng.integers(0, 500))) for i in at]
    frame = spark.createDataFrame(points, "window_start timestamp, cnt bigint")
    expected = recurrence(points, history, step)
    rows = predicted(frame, history=history, step=step)
    assert len(rows) == len(expected)
    for r in rows:
        assert r.prediction == pytest.approx(expected[r.prediction_type, r.window_start], rel=1e-9, abs=1e-9)


def test_series_are_apart(spark):
    one, two = series_of(spark, [10, 20, 5, 7], key="a"), series_of(spark, [3, None, 8, 9], key="b")
    together = series.predict(one.unionByName(two), series_key="key").drop("key").collect()
    alone = series.predict(one.drop("key")).collect() + series.predict(two.drop("key")).collect()
    assert sorted(map(tuple, together)) == sorted(map(tuple, alone))


def test_history_of_one_is_the_previous_count(spark):
    rows = predicted(series_of(spark, [4, 8, None, 15, 16]), history=1)
    average = sorted((r.window_start, r.prediction) for r in rows if r.prediction_type == series.AVERAGE)
    assert [p for _, p in average] == [0.0, 4.0, 8.0, 15.0]


def test_one_predictor_without_its_type(spark):
    only = series.only(series.predict(series_of(spark, [1, 2])), series.TRACKING)
    assert only.columns == ["window_start", "cnt", "prediction", "deviation"] and only.count() == 2


def test_step_is_checked(spark):
    with pytest.raises(ValueError):
        series.predict(series_of(spark, [1]), step=1.0)


def test_a_wrong_window_length_is_noticed(spark):
    rows = [(NOON + timedelta(seconds=i), 1) for i in range(3000)]
    frame = spark.createDataFrame(rows, "window_start timestamp, cnt bigint")
    with pytest.raises(Exception, match="more than one row per 1 hour"):
        series.predict(frame, "1 hour").collect()
