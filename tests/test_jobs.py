"""The jobs end to end: a stream writes its dump, the batch job replays it."""

from __future__ import annotations

import glob
import json
import os
import shutil
import tempfile
import time

import pytest
from pyspark.sql import functions as F
from test_streaming import day_of_lines

from quillcast.plans import jobs
from quillcast.sinks import files
from quillcast.sources import dumps
from quillcast.streaming.predictors import TYPES
from quillcast.streaming.runner import finish_query, malformed_lines


@pytest.fixture(scope="module")
def inbox():
    path = tempfile.mkdtemp(prefix="run-")
    with open(f"{path}/posts.json", "w") as out:
        out.write("\n".join(day_of_lines()))
    return path


def run(queries):
    for query in queries:
        finish_query(query, 300)


def folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def rows(frame, upto=None):
    columns = [c for c in sorted(frame.columns) if c not in ("batch_id", "text", "screen_name")]
    if upto is not None:
        frame = frame.filter(F.col("window_start") < upto)
    return sorted(map(tuple, frame.select(columns).collect()), key=str)


def last_window(frame):
    return frame.agg(F.max("window_start")).first()[0]


def streamed(spark, kind, out, name=""):
    return dumps.read_results(spark, kind, f"{out}/results{name}/batch_id=*")


def test_totals(spark, inbox):
    out = folder()
    run(jobs.stream_totals(spark, inbox, out, state_partitions=2))
    jobs.batch_totals(spark, f"{out}/dump/batch_id=*", f"{out}/batch")
    batch = dumps.read_results(spark, "total", f"{out}/batch")
    stream = streamed(spark, "total", out)
    assert rows(stream) == rows(batch, last_window(batch)) and stream.count() > 50
    documents = spark.read.schema(files.DOCUMENTS["total"]).json(f"{out}/documents/batch_id=*")
    assert documents.count() == stream.count()
    live = folder()
    finish_query(jobs.compare_totals(spark, inbox, f"{out}/batch", live, "15 minutes", state_partitions=2), 300)
    compared = spark.read.parquet(f"{live}/comparison")
    assert compared.count() == stream.count() and compared.filter("cnt <> batch_cnt").count() <= 1


def test_top_posts(spark, inbox):
    out = folder()
    run(jobs.stream_top_posts(spark, inbox, out, "1 hour", 2, state_partitions=2))
    jobs.batch_top_posts(spark, f"{out}/dump/batch_id=*", f"{out}/batch", "1 hour", 2)
    batch = dumps.read_results(spark, "top", f"{out}/batch")
    assert batch.groupBy("window_start").count().filter("count > 2").count() == 0
    assert streamed(spark, "top", out).count() > 20


def test_countries(spark, inbox):
    out = folder()
    capitals = spark.createDataFrame([("us", 38.5, -77.0), ("de", 52.5, 13.4)], "code string, lat double, lon double")
    run(jobs.stream_countries(spark, inbox, out, capitals, lang_of="retweeter", state_partitions=2))
    jobs.batch_countries(spark, f"{out}/dump/batch_id=*", f"{out}/geo", f"{out}/pct", capitals)
    for kind, path in (("geo", "geo"), ("percentage", "pct")):
        batch = dumps.read_results(spark, kind, f"{out}/{path}")
        assert rows(streamed(spark, kind, out, f"-{kind}")) == rows(batch, last_window(batch))
    live = folder()
    finish_query(
        jobs.compare_percentages(
            spark, inbox, f"{out}/pct", live, "15 minutes", state_partitions=2
        ),
        300,
    )
    compared = spark.read.parquet(f"{live}/comparison")
    assert compared.count() > 0 and {"batch_pct", "batch_cnt"} < set(compared.columns)


def test_shares(spark, inbox):
    out = folder()
    run(jobs.stream_shares(spark, inbox, out, "15 minutes", state_partitions=2))
    jobs.batch_shares(spark, f"{out}/dump/batch_id=*", f"{out}/batch")
    batch = dumps.read_results(spark, "share", f"{out}/batch")
    assert rows(streamed(spark, "share", out)) == rows(batch, last_window(batch))
    live = folder()
    finish_query(jobs.compare_shares(spark, inbox, f"{out}/batch", live, state_partitions=2), 300)
    assert spark.read.parquet(f"{live}/comparison").filter("share <> batch_share").count() <= 6


def test_predictions(spark, inbox):
    out = folder()
    finish_query(jobs.stream_series(spark, inbox, out, state_partitions=2), 300)
    finish_query(jobs.stream_predictions(spark, out), 300)
    windows = spark.read.parquet(f"{out}/series").count()
    for name in TYPES:
        assert dumps.read_results(spark, "prediction", f"{out}/results-{name}/batch_id=*").count() == windows
    documents = spark.read.json(f"{out}/documents/batch_id=*")
    assert documents.count() == 3 * windows


def test_predictions_by_language(spark, inbox):
    out = folder()
    finish_query(jobs.stream_series(spark, inbox, out, series_key="lang", state_partitions=2), 300)
    finish_query(jobs.stream_predictions(spark, out, series_key="lang"), 300)
    closed = spark.read.parquet(f"{out}/series")
    assert closed.select("lang").distinct().count() > 1
    documents = spark.read.json(f"{out}/documents/batch_id=*")
    assert documents.count() == 3 * closed.count()


def test_outputs_documents_and_replacement(spark, inbox, capsys):
    out = folder()
    first = jobs.stream_totals(spark, inbox, out, "1 hour", time="arrival", outputs="documents,console", state_partitions=2)
    run(first)
    assert malformed_lines(first[0]) == 0 and len(first) == 2
    assert not os.path.exists(f"{out}/dump") and not os.path.exists(f"{out}/results")
    with pytest.raises(ValueError, match="unknown outputs: paper"):
        jobs.stream_totals(spark, inbox, folder(), outputs="paper")
    run(jobs.stream_totals(spark, inbox, out, "1 hour", state_partitions=2))
    run(jobs.stream_totals(spark, inbox, out, "1 hour", replace=True, state_partitions=2))
    documents = spark.read.json(f"{out}/documents")
    assert documents.count() == streamed(spark, "total", out).count() > 10
    for replace in (False, False, True):
        jobs.batch_totals(spark, f"{out}/dump/batch_id=*", f"{out}/batch", "1 hour", f"{out}/batch-documents", replace)
        found = spark.read.json(f"{out}/batch-documents").count()
    assert found == dumps.read_results(spark, "total", f"{out}/batch").count()


def test_a_comparison_needs_the_earlier_run_at_its_start_only(spark, inbox):
    out, live, arriving = folder(), folder(), folder()
    run(jobs.stream_totals(spark, inbox, out, outputs="dump", state_partitions=2))
    jobs.batch_totals(spark, f"{out}/dump/batch_id=*", f"{out}/batch")
    query = jobs.compare_totals(spark, arriving, f"{out}/batch", live, "15 minutes", state_partitions=2, processingTime="1 second")
    shutil.rmtree(f"{out}/batch")
    with open(f"{arriving}/.posts.json", "w") as lines:
        lines.write("\n".join(day_of_lines()))
    os.rename(f"{arriving}/.posts.json", f"{arriving}/posts.json")
    deadline = time.monotonic() + 120
    while time.monotonic() < deadline and not glob.glob(f"{live}/comparison/batch_id=*/part-*"):
        time.sleep(0.5)
    query.processAllAvailable()
    query.stop()
    compared = spark.read.parquet(f"{live}/comparison")
    assert compared.count() > 50 and compared.filter("cnt <> batch_cnt").count() <= 1


def test_the_input_is_parsed_once(spark, inbox):
    out = folder()
    started = jobs.stream_totals(spark, inbox, out, state_partitions=2)
    run(started)
    sources = [source.description for query in started for source in query.lastProgress.sources]
    assert sum(inbox in source for source in sources) == 1 and len(sources) == 3


def test_flatten(spark):
    path, out = folder(), folder() + "/flat"
    with open(f"{path}/dump.json", "w") as dump:
        json.dump([{"_source": {"b": "x,y", "loc": {"lat": 1.5, "lon": None}, "a": 3}}], dump)
    jobs.flatten_index_dump(spark, path, out, "b string, loc struct<lat double, lon double>, a bigint")
    assert [r.value for r in spark.read.text(out).collect()] == ["x,y,1.5,null,3"]


def test_jobs_from_the_command_line(spark, inbox):
    import run as command

    out = folder()
    command.main(["stream_totals", f"inbox={inbox}", f"out={out}", "window=1 hour", "state_partitions=2", "max_files=1"])
    command.main(["batch_totals", f"dump={out}/dump/batch_id=*", f"results={out}/batch", "window=1 hour"])
    batch = dumps.read_results(spark, "total", f"{out}/batch")
    assert rows(streamed(spark, "total", out)) == rows(batch, last_window(batch))
    with open(f"{out}/capitals.csv", "w") as capitals:
        capitals.write("Germany,Berlin,52.5,13.4,DE,Europe\n")
    command.main(["stream_countries", f"inbox={inbox}", f"out={out}/c", "state_partitions=2", f"capitals={out}/capitals.csv"])
    located = {(r.lang, r.lat) for r in streamed(spark, "geo", f"{out}/c", "-geo").collect()}
    assert ("de", 52.5) in located and ("ja", 0.0) in located
    assert len(command.JOBS) == 16
    with pytest.raises(SystemExit):
        command.main(["no_such_job"])


def test_a_failing_stream_fails_the_command(spark):
    import run as command

    broken = folder()
    with open(f"{broken}/a.json", "w") as out:
        out.write("\n".join(day_of_lines()))
    with pytest.raises(Exception):
        command.main(
            ["compare_totals", f"inbox={broken}", f"batch_results={broken}/nothing", f"out={broken}/out"]
        )
