"""The archive of facts, complete counts, silent streams, and batch folders that merge."""

from __future__ import annotations

import os
import tempfile
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import NOON, line, rows

from quillcast.operators import counts, ranking
from quillcast.operators.counts import labelled
from quillcast.plans import jobs
from quillcast.session import SHUFFLES_GO, cleared, file_names, scratch_dir, shuffles_removed, written
from quillcast.sinks import files
from quillcast.sources import dumps, posts
from quillcast.streaming import archive, batches, metrics, runner

QUARTER = "15 minutes"


class Archive:
    def __init__(self, spark, window=QUARTER, time="event"):
        self.spark, self.window, self.time = spark, window, time
        self.inbox, self.path = tempfile.mkdtemp(prefix="run-"), scratch_dir(spark, "archive")
        self.arrived = 0

    def receive(self, *lines, modified=None):
        path = f"{self.inbox}/{self.arrived:04d}.json"
        with open(path, "w") as out:
            out.write("\n".join(lines))
        os.utime(path, (modified or 1_700_000_000 + self.arrived,) * 2)
        self.arrived += 1

    def file(self, max_files=None):
        query = archive.start_filing(
            self.spark, self.inbox, f"{self.path}/facts", f"{self.path}/filed", self.window, metrics.DELAY, self.time, max_files=max_files
        )
        runner.finish_query(query, 300)
        return archive.totals(self.spark, f"{self.path}/facts")

    def counted(self, window=None):
        rows = archive.in_time(archive.stream_archive(self.spark, f"{self.path}/facts", self.time), self.window, metrics.DELAY, self.time)
        query = runner.start(
            counts.reposts_per_window(rows, window or self.window), f"{self.path}/counted", {f"{self.path}/out": runner.parquet}, labelled, 2
        )
        runner.finish_query(query, 300)
        return {(r.window_start - NOON).total_seconds(): r.cnt for r in self.spark.read.parquet(f"{self.path}/out").collect()}

    def close(self):
        latest = archive.totals(self.spark, f"{self.path}/facts")["latest"]
        archive.tick(self.spark, f"{self.path}/facts", latest + archive.length_of(self.spark, f"{self.window} {metrics.DELAY}"))


def test_counts_over_many_batches_and_restarts(spark):
    """More batches than a query remembers; late posts are counted one by one."""
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(remembered)
    spark.conf.set(remembered, 3)
    store, want = Archive(spark), {"lines": 0, "notices": 0, "malformed": 0, "posts": 0, "late": 0}
    latest = None
    for number in range(27):
        at = [number * 60, number * 60 + 30, number * 60 - 1200 * (number % 9 == 8)]
        ends = [(second // 900 + 1) * 900 for second in at]
        store.receive(*(line(number * 10 + k, second, rt_id=5) for k, second in enumerate(at)), '{"delete": null}', '{"id": 1', "{bad")
        late = sum(latest is not None and end <= latest - 5 for end in ends)
        latest = max(at) if latest is None else max(latest, *at)
        for name, more in zip(want, (6, 1, 2, 3, late), strict=True):
            want[name] += more
        if number in (10, 26):
            found = store.file(max_files=1)
            assert {name: found[name] for name in archive.COUNTS} == want
    assert want["late"] == 3
    spark.conf.set(remembered, before)
    store.close()
    assert sum(store.counted().values()) == want["posts"] - want["late"]
    assert len(file_names(spark, f"{store.path}/facts/_totals")) < 12


def test_a_repeated_filing_changes_nothing(spark):
    store = Archive(spark)
    store.receive(line(1, 0, rt_id=5), line(2, 10, rt_id=5))
    before = store.file()
    store.receive(line(3, 2000, rt_id=5))
    known = store.file()
    # As after a crash between filing a batch and committing it, once with its totals and once without.
    for batch, gone in ((1, []), (1, [f"{store.path}/facts/_totals/1"])):
        for path in [f"{store.path}/filed/commits/{batch}", f"{store.path}/filed/commits/.{batch}.crc", *gone]:
            os.remove(path.removeprefix("file:"))
        assert store.file() == known != before
    store.close()
    assert store.counted() == {0: 2, 1800: 1}


def test_ticks_close_windows_and_make_posts_late(spark):
    store = Archive(spark)
    store.receive(line(1, 0, rt_id=5), line(2, 10), line(3, 905, rt_id=6))
    assert store.file()["late"] == 0
    assert store.counted() == {0: 1}
    store.close()
    assert store.counted() == {0: 1, 900: 1}
    store.receive(line(4, 1000, rt_id=5), line(5, 1900, rt_id=5))
    assert store.file()["late"] == 1
    store.close()
    assert store.counted() == {0: 1, 900: 1, 1800: 1}


def test_the_clock_of_a_silent_stream(spark):
    store = Archive(spark, "1 minute")
    store.receive(line(1, 0, rt_id=5), line(2, 61, rt_id=5))
    facts = f"{store.path}/facts"
    trigger = {"processingTime": "100 milliseconds"}
    filing = archive.start_filing(spark, store.inbox, facts, f"{store.path}/filed", "1 minute", metrics.DELAY, **trigger)
    clock = archive.IdleClock(spark, facts, filing, f"1 minute {metrics.DELAY}", idle=0.5, pace=40.0)
    clock.start()
    try:
        assert clock.closed.wait(60)
        ticks = [int(name.partition("=")[2]) for name in file_names(spark, f"{facts}/slice=ticks")]
        latest = archive.totals(spark, facts)["latest"]
        # It moves on bit by bit and rests behind the last window.
        assert len(ticks) >= 2 and max(ticks) == latest + 65_000_000
        store.receive(line(3, 600, rt_id=5))
        filing.processAllAvailable()
        clock.closed.clear()
        assert clock.closed.wait(60)
    finally:
        clock.stop()
        filing.stop()
    assert store.counted() == {0: 1, 60: 1, 600: 1}


def test_arrival_is_that_of_the_file(spark):
    store = Archive(spark, time="arrival")
    noon = int(NOON.timestamp())
    store.receive(line(1, 99_999, rt_id=5), line(2, -99_999, rt_id=5), modified=noon + 10)
    store.receive(line(3, 0, rt_id=5), modified=noon + 1000)
    assert store.file(max_files=1)["late"] == 0
    # A file older than those filed before counts as arrived with the latest.
    store.receive(line(4, 0, rt_id=5), modified=noon)
    assert store.file()["late"] == 0
    store.close()
    assert store.counted() == {0: 2, 900: 2}


def test_top_posts_without_texts_in_state(spark):
    store = Archive(spark)
    lines = [line(i, i * 7, rt_id=i % 5, lang="en") for i in range(400)]
    store.receive(*lines[:200])
    store.receive(*lines[200:])
    store.file(max_files=1)
    store.close()
    facts = f"{store.path}/facts"
    rows_ = archive.in_time(archive.stream_archive(spark, facts), QUARTER, metrics.DELAY)
    stream, finish = metrics.top_posts(rows_, QUARTER, 2, lambda winners: archive.posts_at(spark, facts, winners))
    assert {f.dataType.typeName() for f in stream.schema if f.name != "win"} == {"long", "timestamp"}
    query = runner.start(stream, f"{store.path}/top", {f"{store.path}/top-out": runner.parquet}, finish, 2)
    runner.finish_query(query, 300)
    assert "SortAggregate" not in query._jsq.toString() and "SortAggregate" not in explained(query)
    want = labelled(ranking.top_posts(posts.read_facts(spark, store.inbox), QUARTER, 2))
    assert rows(spark.read.parquet(f"{store.path}/top-out").drop("batch_id")) == rows(want)
    assert archive.posts_at(spark, facts, spark.createDataFrame([(NOON - timedelta(days=9),)], "ts timestamp")).count() == 0


def explained(query) -> str:
    return query._jsq.streamingQuery().lastExecution().executedPlan().toString()


# Batch folders ----------------------------------------------------------------


def save(spark, path, batch_id, values):
    frame = spark.createDataFrame([(value,) for value in values], "n long").coalesce(1)
    batches.commit(spark, path, batch_id, lambda target: frame.write.mode("overwrite").parquet(target))


def numbers(spark, path):
    return sorted(r.n for r in spark.read.parquet(*batches.current(spark, path)).collect())


def test_merging_bounds_the_number_of_folders(spark):
    path = scratch_dir(spark, "merging")
    for batch_id in range(60):
        save(spark, path, batch_id, [batch_id])
        batches.merge(spark, path, batches.merge_parquet, fan=3)
        assert numbers(spark, path) == list(range(batch_id + 1))
    assert len(batches.current(spark, path)) <= 3 * 4 and len(file_names(spark, path)) <= 3 * 4 + 5
    assert max(len(name) for name in batches.current(spark, path)) > len(f"{path}/batch_id=0-2")


def test_a_merge_killed_half_way_loses_nothing(spark):
    path = scratch_dir(spark, "killed")
    for batch_id in range(5):
        save(spark, path, batch_id, [batch_id])

    def killed(spark, paths, target):
        batches.merge_parquet(spark, paths, target)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        batches.merge(spark, path, killed, fan=3)
    assert numbers(spark, path) == list(range(5)) and len(batches.current(spark, path)) == 5
    listed = batches.current(spark, path)
    assert batches.merge(spark, path, batches.merge_parquet, fan=3)
    assert numbers(spark, path) == list(range(5)) and len(batches.current(spark, path)) == 3
    # Whoever listed the folders before the merge still finds them.
    assert spark.read.parquet(*listed).count() == 5
    assert not batches.merge(spark, path, batches.merge_parquet, fan=3)


def test_batches_replace_themselves_but_no_merged_ones(spark):
    path = scratch_dir(spark, "replaced")
    for batch_id in range(5):
        save(spark, path, batch_id, [batch_id])
    save(spark, path, 4, [40])
    assert numbers(spark, path) == [0, 1, 2, 3, 40]
    batches.merge(spark, path, batches.merge_parquet, fan=3)
    with pytest.raises(ValueError, match="another checkpoint"):
        save(spark, path, 1, [10])
    batches.commit(spark, path, 9, lambda target: None)
    assert len(batches.current(spark, path)) == 3 and batches.current(spark, f"{path}/none") == []


def test_a_job_with_merged_outputs_and_closed_windows(spark):
    inbox, out = tempfile.mkdtemp(prefix="run-"), scratch_dir(spark, "merged-job")
    for part in range(12):
        with open(f"{inbox}/{part:02d}.json", "w") as lines:
            lines.write("\n".join(line(part * 50 + i, (part * 50 + i) * 20, rt_id=i % 3) for i in range(50)))
        os.utime(f"{inbox}/{part:02d}.json", (1_700_000_000 + part,) * 2)
        for query in jobs.stream_totals(spark, inbox, out, merge=3, idle=10.0 if part == 11 else None, state_partitions=2, outputs="dump,results"):
            runner.finish_query(query, 300)
    batch = labelled(counts.reposts_per_window(posts.read_facts(spark, inbox)))
    assert rows(dumps.read_results(spark, "total", batches.current(spark, f"{out}/results"))) == rows(batch)
    assert dumps.read_dump(spark, "total", batches.current(spark, f"{out}/dump")).count() == 600
    assert any("-" in path.rpartition("=")[2] for path in batches.current(spark, f"{out}/dump"))
    assert archive.totals(spark, f"{out}/facts")["late"] == 0


def test_a_batch_clears_its_scratch_folders(spark):
    with cleared(spark):
        frame = written(spark.range(3), "gone")
        path = frame.inputFiles()[0].rpartition("/")[0]
        assert frame.count() == 3 and file_names(spark, path)
    assert not file_names(spark, path)


def test_written_frames_leave_no_shuffle_files(spark):
    def left():
        names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {name for name in names if "/shuffle_" in name}

    earlier = left()
    found = written(spark.range(1_000).repartition(5, "id"), "dealt")
    until = time.time() + 3  # files are removed in the background
    while left() - earlier and time.time() < until:
        time.sleep(0.1)
    assert not left() - earlier
    assert found.count() == 1_000 and found.join(written(found, "again"), "id").count() == 1_000


@pytest.mark.parametrize("before", [None, "false", "true"])
def test_setting_is_restored_by_the_last(spark, before):
    spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)
    first, second = shuffles_removed(spark), shuffles_removed(spark)
    try:
        first.__enter__()
        second.__enter__()
        first.__exit__(None, None, None)
        assert spark.conf.get(SHUFFLES_GO) == "true"
        second.__exit__(None, None, None)
        assert spark.conf.get(SHUFFLES_GO, None) == before
    finally:
        spark.conf.unset(SHUFFLES_GO)
