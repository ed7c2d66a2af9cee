"""Streams over files that arrive in several batches."""

from __future__ import annotations

import json
import os
import tempfile
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillcast.operators import counts, ranking, series, shares
from quillcast.operators.counts import labelled
from quillcast.session import scratch_dir
from quillcast.sinks import files
from quillcast.sources import dumps, posts
from quillcast.streaming import metrics, predictors, runner

NOON = datetime(2018, 10, 29, 12)


def line(number, at, lang="en", rt_id=None, rt_lang="en"):
    post = {"id": number, "created_at": (NOON + timedelta(seconds=at)).strftime("%a %b %d %H:%M:%S +0000 %Y")}
    if lang is not None:
        post["user"] = {"lang": lang}
    if rt_id is not None:
        post["retweeted_status"] = {"id": rt_id, "text": f"t{rt_id}", "created_at": "x"}
        if rt_lang is not None:
            post["retweeted_status"]["user"] = {"lang": rt_lang, "screen_name": f"u{rt_id}"}
    return json.dumps(post)


class Inbox:
    """A folder of JSON lines and a stream over it, run whenever files have arrived."""

    def __init__(self, spark, metric=None, finish=None):
        self.spark = spark
        self.path = tempfile.mkdtemp(prefix="run-")
        self.work = scratch_dir(spark, "inbox")
        self.metric = metric
        self.finish = finish
        self.arrived = 0
        self.lines = []

    def receive(self, lines):
        path = f"{self.path}/{self.arrived:04d}.json"
        with open(path, "w") as out:
            out.write("\n".join(lines))
        # The file source takes files in order of their modification time.
        os.utime(path, (1_700_000_000 + self.arrived,) * 2)
        self.arrived += 1
        self.lines += lines

    def run(self):
        facts = metrics.with_event_time(posts.stream_facts(self.spark, self.path, 1))
        stream, finish = self.metric(facts)
        query = runner.start(
            stream, f"{self.work}/checkpoint", {f"{self.work}/out": runner.parquet}, finish, 4
        )
        runner.finish_query(query, 300)
        return self.result()

    def result(self):
        return self.spark.read.parquet(f"{self.work}/out").drop("batch_id")

    def facts(self):
        return posts.read_facts(self.spark, self.path)


def day_of_lines():
    out = []
    for i in range(2400):
        at = i * 36
        rt_id = i % 7 if i % 3 else None
        out.append(line(i, at, ["en", "de", None][i % 3 - 1], rt_id, ["ja", "en", None, "de"][i % 4]))
    return out


def rows(frame):
    return sorted(map(tuple, frame.select(sorted(frame.columns)).collect()), key=str)


BATCH_OF = {
    "reposts_per_window": lambda f: labelled(counts.reposts_per_window(f)),
    "reposts_two_stage": lambda f: labelled(
        counts.totals_of_windows(counts.reposts_per_post(f), "1 hour")
    ),
    "top_posts": lambda f: labelled(ranking.top_posts(f, "1 minute")),
    "percentage_per_language": lambda f: labelled(
        shares.percentage_of_window(counts.reposts_per_language(f))
    ),
    "share_per_language": lambda f: labelled(shares.share_of_posts(f)),
    "share_by_window_join": lambda f: labelled(shares.share_of_posts(f, lang_of="author")),
    "max_share_per_language": lambda f: labelled(
        shares.max_share(shares.share_of_posts(f, "1 hour"), "1 day")
    ),
}
SIZE = {
    "reposts_two_stage": timedelta(hours=1), "max_share_per_language": timedelta(days=1),
    "top_posts": timedelta(minutes=1),
}


@pytest.mark.parametrize("name", BATCH_OF)
def test_stream_equals_batch_up_to_the_last_window(spark, name):
    inbox = Inbox(spark, getattr(metrics, name))
    lines = day_of_lines()
    # Two days for the daily metric, so that a day closes.
    if name == "max_share_per_language":
        lines += [line(9000 + i, 90_000 + i * 600, "en", 3) for i in range(100)]
    for i in range(4):
        inbox.receive(lines[i * len(lines) // 4 : (i + 1) * len(lines) // 4])
    got = inbox.run()
    expected = BATCH_OF[name](inbox.facts())
    last = expected.agg(F.max("window_start")).first()[0]
    closed = expected.filter(F.col("window_start") < last)
    assert got.count() > 0
    late = SIZE.get(name, timedelta(minutes=15))
    assert rows(got.filter(F.col("window_start") < last - late)) == rows(
        closed.filter(F.col("window_start") < last - late)
    )
    assert got.filter(F.col("window_start") >= last).count() == 0


def test_geo_stream(spark):
    capitals = spark.createDataFrame([("us", 38.5, -77.0), ("de", 52.5, 13.4)], "code string, lat double, lon double")
    inbox = Inbox(spark, lambda f: metrics.reposts_per_country(f, capitals))
    inbox.receive([line(1, 0, "en", 5, "de"), line(2, 1, "en", 5, "xx"), line(3, 2000, "en", 5, "de")])
    got = {r.lang: (r.lat, r.lon, r.cnt) for r in inbox.run().collect()}
    assert got == {"de": (52.5, 13.4, 1), "xx": (0.0, 0.0, 1)}


def test_late_posts_are_dropped(spark):
    inbox = Inbox(spark, metrics.reposts_per_window)
    inbox.receive([line(1, 0, "en", 5), line(2, 1000, "en", 5)])
    inbox.run()
    inbox.receive([line(3, 10, "en", 5), line(4, 3000, "en", 5)])
    got = inbox.run().collect()
    assert {(r.window_start, r.cnt) for r in got} == {(NOON, 1), (NOON + timedelta(minutes=15), 1)}


def test_dropped_and_malformed_lines_are_reported(spark):
    path, work = tempfile.mkdtemp(prefix="run-"), scratch_dir(spark, "reported")

    def receive(name, lines):
        with open(f"{path}/{name}.json", "w") as out:
            out.write("\n".join(lines))
        facts = metrics.with_time(posts.stream_facts(spark, path), "event", "1 minute")
        query = runner.start(
            metrics.reposts_per_window(facts)[0], f"{work}/checkpoint", {f"{work}/out": runner.parquet}, state_partitions=2
        )
        runner.finish_query(query, 120)
        return runner.dropped_rows(query), runner.observed(query, posts.PARSED)

    assert receive("a", [line(1, 0, "en", 5), line(2, 3000, "en", 5), "{bad", '{"delete": null}']) == (
        0, {"lines": 4, "notices": 1, "malformed": 1},
    )
    dropped, seen = receive("b", [line(3, 10, "en", 5), line(4, 5000, "en", 5)])
    assert dropped == 1 and seen == {"lines": 2, "notices": 0, "malformed": 0}
    with pytest.raises(ValueError, match="event, arrival"):
        metrics.with_time(posts.stream_facts(spark, path), "processing")


def test_restart_goes_on_from_the_checkpoint(spark):
    inbox = Inbox(spark, metrics.reposts_per_window)
    inbox.receive([line(1, 0, "en", 5), line(2, 10, "en", 5)])
    assert inbox.run().count() == 0
    inbox.receive([line(3, 20, "en", 5), line(4, 2000, "en", 5)])
    assert [(r.window_start, r.cnt) for r in inbox.run().collect()] == [(NOON, 3)]
    assert inbox.run().count() == 1


def test_a_repeated_batch_overwrites_itself(spark):
    inbox = Inbox(spark, metrics.reposts_per_window)
    inbox.receive([line(1, 0, "en", 5), line(2, 2000, "en", 5)])
    before = rows(inbox.run())
    # As after a crash between writing a batch and committing it.
    for name in ("1", ".1.crc"):
        os.remove(f"{inbox.work.removeprefix('file:')}/checkpoint/commits/{name}")
    assert rows(inbox.run()) == before


def test_arrival_time(spark):
    path = tempfile.mkdtemp(prefix="run-")
    with open(f"{path}/a.json", "w") as out:
        out.write(line(1, 0, "en", 5))
    facts = metrics.with_arrival_time(posts.stream_facts(spark, path))
    stream, _ = metrics.reposts_per_window(facts, "1 day")
    query = (
        stream.writeStream.format("memory").queryName("arrival").outputMode("complete")
        .option("checkpointLocation", scratch_dir(spark, "arrival")).trigger(availableNow=True).start()
    )
    runner.finish_query(query, 120)
    (row,) = spark.table("arrival").collect()
    assert row.win.start.year >= 2024 and row.cnt == 1


def test_fan_out_of_dumps_and_replay(spark):
    inbox = Inbox(spark)
    for part in range(3):
        inbox.receive(day_of_lines()[part::3] + ['{"delete": null}'])
    outputs = {f"{inbox.work}/{kind}": files.dump_writer(kind) for kind in ("total", "lang", "top")}
    stream = posts.stream_facts(spark, inbox.path, 1)
    runner.finish_query(runner.start(stream, f"{inbox.work}/checkpoint", outputs), 300)
    replay = {
        kind: dumps.dump_facts(dumps.read_dump(spark, kind, f"{inbox.work}/{kind}/batch_id=*"), kind)
        for kind in ("total", "lang", "top")
    }
    direct = inbox.facts()
    assert rows(counts.reposts_per_window(replay["total"])) == rows(counts.reposts_per_window(direct))
    assert rows(shares.share_of_posts(replay["lang"])) == rows(shares.share_of_posts(direct))
    # The top-X dump writes "no repost" as id 0.
    without_zero = direct.filter("rt_id <> 0")
    assert rows(counts.reposts_per_post(replay["top"])) == rows(counts.reposts_per_post(without_zero))


def test_predictions_keep_state_across_batches(spark):
    path = tempfile.mkdtemp(prefix="run-")
    work = scratch_dir(spark, "predict")
    counted = [10, 20, 5, 7, 9, 0, 30, 2, 2, 8]
    all_rows = [(NOON + timedelta(minutes=i), c) for i, c in enumerate(counted)]

    def run(part, name):
        frame = pd.DataFrame(list(reversed(part)), columns=["window_start", "cnt"])
        spark.createDataFrame(frame, predictors.SERIES).coalesce(1).write.mode("append").parquet(path)
        outputs = {f"{work}/out": runner.parquet}
        carried = predictors.carrying(f"{work}/state")
        runner.finish_query(
            runner.start(predictors.stream_series(spark, path), f"{work}/checkpoint", outputs, finish_batch=carried), 300
        )

    run(all_rows[:4], "a")
    run(all_rows[4:5], "b")
    run(all_rows[5:], "c")
    got = spark.read.parquet(f"{work}/out").drop("batch_id")
    expected = series.predict(spark.createDataFrame(all_rows, predictors.SERIES))
    key = ["prediction_type", "window_start"]
    got, expected = (f.toPandas().sort_values(key).reset_index(drop=True) for f in (got, expected))
    pd.testing.assert_frame_equal(got[expected.columns], expected, rtol=1e-9)


def test_console_runs(spark):
    path = tempfile.mkdtemp(prefix="run-")
    with open(f"{path}/a.json", "w") as out:
        out.write(line(1, 0, "en", 5))
    query = runner.start_console(posts.stream_facts(spark, path), scratch_dir(spark, "console"))
    runner.finish_query(query, 120)


def test_a_failing_stream_raises(spark):
    inbox = Inbox(spark, lambda f: (counts.reposts_per_window(f), lambda batch: batch.select("nothing")))
    inbox.receive([line(1, 0, "en", 5)])
    with pytest.raises(Exception):
        inbox.run()
