"""JSON arrays cut at their elements, ragged documents, targets with a mapping, panes, predictor levels."""

from __future__ import annotations

import json
import random
import tempfile
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_operators import recurrence
from test_streaming import NOON, day_of_lines, rows

from quillcast.operators import counts, series
from quillcast.operators.counts import labelled
from quillcast.plans import catalog, jobs
from quillcast.session import file_names, scratch_dir
from quillcast.sinks import files
from quillcast.sources import dumps
from quillcast.streaming import archive, batches
from quillcast.streaming.runner import finish_query


def folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)

    def set_to(size):
        spark.conf.set(name, size)

    yield set_to
    spark.conf.set(name, before)


def odd_text(rng):
    return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", " ", "ä", "a", "\n", "}}", '\\"', "€"]) for _ in range(rng.randrange(12)))


def odd_value(rng, deep=0):
    kind = rng.randrange(7 if deep < 2 else 5)
    if kind == 5:
        return {odd_text(rng) or "k": odd_value(rng, deep + 1) for _ in range(rng.randrange(3))}
    if kind == 6:
        return [odd_value(rng, deep + 1) for _ in range(rng.randrange(3))]
    return [odd_text(rng), rng.randrange(-99, 99), None, True, 1.5][kind]


@pytest.mark.parametrize("size", [7, 64, 100_000])
def test_arrays_are_cut_at_their_elements(spark, small_splits, size):
    """Texts full of quotes, braces and backslashes; files of one line, of many, of several arrays; empty ones."""
    rng = random.Random(size)
    path, want = folder(), Counter()
    for number in range(5):
        documents = [{"_source": {f"k{n}": odd_value(rng) for n in range(rng.randrange(4))}} for _ in range(30)]
        want.update(json.dumps(d, sort_keys=True) for d in documents)
        text = [
            json.dumps(documents), json.dumps(documents, indent=1), json.dumps(documents, ensure_ascii=False) + "\n",
            json.dumps(documents[:9]) + "\n" + json.dumps([]) + "\r\n" + json.dumps(documents[9:], indent=2), "  [\n" + ",\n".join(map(json.dumps, documents)) + "\n]\n",
        ][number]
        with open(f"{path}/{number}.json", "w") as out:
            out.write(text)
    for name, text in (("empty", "[]"), ("nothing", ""), ("cut", '[{"_source": {"a": "lost')):
        with open(f"{path}/{name}.json", "w") as out:
            out.write(text)
    small_splits(str(size))
    found = dumps.array_elements(spark, path)
    assert Counter(json.dumps(json.loads(r.value), sort_keys=True) for r in found.collect()) == want
    assert all("\n" not in r.value for r in found.collect())


def test_one_long_line_is_read_by_several_tasks(spark, small_splits):
    path = folder()
    documents = [{"_source": {"n": n, "text": 'say "} ], {" \\'}} for n in range(2000)]
    with open(f"{path}/dump.json", "w") as out:
        json.dump(documents, out)
    small_splits("8k")
    found = dumps.array_elements(spark, path)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() >= 8
    assert sorted(json.loads(r.value)["_source"]["n"] for r in found.collect()) == list(range(2000))
    typed = dumps.read_index_dump(spark, path, "n bigint, text string")
    assert typed.filter(F.col("text") == 'say "} ], {" \\').count() == 2000
    assert rows(dumps.read_index_dump(spark, path)) == rows(typed)


def plain_line(document):
    def said(value):
        if value is None:
            return "null"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, float) and value == int(value):
            return str(int(value))
        if isinstance(value, dict | list):
            return json.dumps(value, separators=(",", ":"))
        return str(value)

    found = []
    for value in document.values():
        if isinstance(value, dict):
            found += map(said, value.values())
        elif isinstance(value, list):
            found += map(said, value)
        else:
            found.append(said(value))
    return ",".join(found)


def test_documents_are_flattened_by_their_own_keys(spark):
    documents = [
        {"b": "x,y", "a": 1}, {"a": 2, "b": None}, {"c": {"z": 1, "y": None, "x": "{t}"}, "a": [1, None, "q", 2.0]}, {}, {"e": {}, "l": [], "a": 3},
        {"n": 33.0, "m": -1.5, "t": True, "s": "33.0", "u": "null", "v": "[1]"}, {"deep": {"d": {"k": 1}, "l": [1, 2]}}, {"text": "\"}\\ ä\t"},
    ]
    path, out = folder(), folder() + "/flat"
    with open(f"{path}/dump.json", "w") as dump:
        json.dump([{"_source": d} for d in documents], dump)
    jobs.flatten_index_dump(spark, path, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(map(plain_line, documents))


# Targets ----------------------------------------------------------------------


def test_documents_of_another_kind_are_refused(spark):
    path = scratch_dir(spark, "target")
    total = spark.createDataFrame([(NOON, 3)], "window_start timestamp, cnt bigint")
    shares = spark.createDataFrame([(NOON, "en", 1, 2, 0.5)], "window_start timestamp, lang string, rt_total bigint, tw_total bigint, share double")
    files.write_documents(total, "total", path)
    with pytest.raises(ValueError, match="not of kind share"):
        files.write_documents(shares, "share", path)
    files.write_documents(total, "total", path)
    assert spark.read.json(path).count() == 2
    # Replacing the target gives it the new kind, also from its own documents.
    files.write_documents(shares, "share", path, replace=True)
    assert spark.read.json(path).columns == ["langcode", "percentage", "rt_total", "tw_total", "watermark"]
    with pytest.raises(ValueError, match="not of kind total"):
        files.prepare_target(spark, "total", path)


def test_a_stream_job_refuses_a_target_of_another_kind(spark):
    inbox, out = folder(), folder()
    with open(f"{inbox}/posts.json", "w") as lines:
        lines.write("\n".join(day_of_lines()[:100]))
    files.prepare_target(spark, "share", f"{out}/documents")
    with pytest.raises(ValueError, match="not of kind total"):
        jobs.stream_totals(spark, inbox, out)
    assert not file_names(spark, f"{out}/facts")


def test_outputs_of_predictions_and_comparisons(spark):
    inbox, out = folder(), folder()
    with open(f"{inbox}/posts.json", "w") as lines:
        lines.write("\n".join(day_of_lines()[:600]))
    finish_query(jobs.stream_series(spark, inbox, out, "15 minutes", state_partitions=2), 300)
    counted = spark.read.parquet(f"{out}/series").count()
    for replace in (False, True):
        finish_query(jobs.stream_predictions(spark, out, "15 minutes", outputs="documents,console", replace=replace), 300)
        assert spark.read.json(f"{out}/documents/batch_id=*").count() == 3 * counted > 0
    assert not file_names(spark, f"{out}/results-AVG")
    with pytest.raises(ValueError, match="unknown outputs: dump"):
        jobs.stream_predictions(spark, out, outputs="dump")
    for query in jobs.stream_totals(spark, inbox, f"{out}/run", outputs="dump", state_partitions=2):
        finish_query(query, 300)
    jobs.batch_totals(spark, f"{out}/run/dump/batch_id=*", f"{out}/batch")
    for _ in range(2):
        finish_query(jobs.compare_totals(spark, inbox, f"{out}/batch", f"{out}/live", "15 minutes", replace=True, state_partitions=2), 300)
        assert spark.read.parquet(f"{out}/live/comparison").count() == counted
    with pytest.raises(ValueError, match="unknown outputs: documents"):
        jobs.compare_totals(spark, inbox, f"{out}/batch", f"{out}/live", outputs="documents")


# Panes and predictors ---------------------------------------------------------


def test_panes_roll_up_to_every_size(spark):
    assert counts.common_pane(["15 minutes", "1 hour", "25 minutes"]) == f"{300 * 10**6} microseconds"
    inbox, out = folder(), folder()
    with open(f"{inbox}/posts.json", "w") as lines:
        lines.write("\n".join(day_of_lines()))
    for query in jobs.stream_panes(spark, inbox, out, "5 minutes", series_key="lang", idle=1.0, state_partitions=2):
        finish_query(query, 300)
    jobs.roll_up(spark, out, f"{out}/sizes", "5 minutes,15 minutes,1 day", series_key="lang")
    facts = archive.only_posts(spark.read.schema(archive.FACTS).parquet(f"{out}/facts/slice=*/batch_id=*"))
    found = spark.read.parquet(f"{out}/sizes")
    for size in ("5 minutes", "15 minutes", "1 day"):
        got = found.filter(F.col("size") == size).drop("size")
        assert rows(got) == rows(labelled(counts.reposts_per_language(facts, size)))
    assert len(batches.current(spark, f"{out}/panes")) >= 1


def test_several_sizes_are_one_scan_and_one_shuffle_of_posts(spark, sf_dir):
    plan = counts.reposts_per_windows(catalog.facts(spark, sf_dir), ["1 minute", "1 hour"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2


@pytest.mark.parametrize("key", [None, "k"])
def test_blocks_composed_over_many_levels(spark, monkeypatch, key):
    """Groups of four blocks, windows over three years and before 1970, a slow predictor."""
    monkeypatch.setattr(series, "FAN", 4)
    rng = random.Random(2)
    at = sorted(rng.sample(range(-2_000_000, 2_000_000), 400))
    points = [(NOON - timedelta(days=17_800) + timedelta(minutes=i), rng.randrange(100)) for i in at]
    assert series.levels_above("1 minute", 1024, 4) == 7
    frame = spark.createDataFrame([(*point, "one") for point in points], "window_start timestamp, cnt bigint, k string")
    frame = frame if key else frame.drop("k")
    found = series.predict(frame, "1 minute", 3, 0.001, key).collect()
    want = recurrence(points, 3, 0.001)
    assert len(found) == len(want)
    for r in found:
        assert r.prediction == pytest.approx(want[r.prediction_type, r.window_start], rel=1e-9, abs=1e-9)
