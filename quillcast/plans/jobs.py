"""The jobs as one would submit them: files in, result files and documents out.

Batch jobs replay a raw dump. Stream jobs take a folder that receives JSON lines and
return their started queries; the default trigger works off what is there and ends,
``processingTime='1 minute'`` keeps them running.

A stream job parses its input once, into ``facts`` under ``out``, and goes on from there:
``dump`` (all posts), ``results`` and ``documents``; ``archive.totals(spark, f"{out}/facts")`` counts
lines, notices, malformed lines and late posts. ``outputs`` chooses among dump, results, documents and console.
With the default trigger the parsing has ended before the rest starts.

Common settings: ``time`` (event or arrival) and ``delay`` of the windows, ``max_files`` per
micro-batch, ``state_partitions``, ``files_per_batch`` of results, ``merge`` (so many micro-batches' folders are
put together, none if 0; read them by ``batches.current`` then), and ``replace``, which
removes earlier results and documents first; without it documents are added.

``idle`` closes the windows of a silent stream: after so many seconds without posts its time goes on
with the clock, ``pace`` seconds per second. With the default trigger the present
input counts as complete, and all its windows are closed at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillcast.operators import comparison, counts, geo, ranking, shares
from quillcast.operators.counts import labelled
from quillcast.session import remove_folder, written
from quillcast.sinks import files
from quillcast.sources import dumps, posts
from quillcast.streaming import archive, batches, metrics, predictors, runner

ALL_OUTPUTS = "dump,results,documents"

# Batch ------------------------------------------------------------------------


def _replay(spark: SparkSession, kind: str, dump: str) -> DataFrame:
    return dumps.dump_facts(dumps.read_dump(spark, kind, dump), kind)


def _write_batch(result: DataFrame, kind: str, results: str, documents: str | None, replace: bool) -> None:
    """Result files replace earlier ones; documents are added unless ``replace`` is set."""
    if documents is not None:
        result = written(result, "result")
        files.write_documents(result, kind, documents, replace)
    files.write_results(result, kind, results)


def batch_totals(
    spark: SparkSession,
    dump: str,
    results: str,
    window: str = "15 minutes",
    documents: str | None = None,
    replace: bool = False,
) -> None:
    counted = counts.reposts_per_window(_replay(spark, "total", dump), window)
    _write_batch(labelled(counted), "total", results, documents, replace)


def batch_top_posts(
    spark: SparkSession,
    dump: str,
    results: str,
    window: str = "1 minute",
    x: int = 5,
    documents: str | None = None,
    replace: bool = False,
) -> None:
    """The dump holds no texts, so the result has none either."""
    facts = _replay(spark, "top", dump).selectExpr("*", "CAST(NULL AS STRING) AS rt_text")
    ranked = ranking.top_posts(facts, window, x, require_author=False)
    _write_batch(labelled(ranked), "top", results, documents, replace)


def batch_countries(
    spark: SparkSession,
    dump: str,
    geo_results: str,
    percentage_results: str,
    capitals: DataFrame,
    window: str = "15 minutes",
    keep_no_lang: bool = False,
    places: int = 2,
    documents: str | None = None,
    replace: bool = False,
) -> None:
    """Both country metrics from one count; the dump knows the poster's language only.

    Documents go to folders that end in ``-geo`` and ``-percentage``.
    """
    counted = written(
        counts.reposts_per_language(
            _replay(spark, "lang", dump), window, "retweeter", keep_no_lang
        ),
        "per-language",
    )
    for kind, finish, results in (
        ("geo", metrics.located(capitals), geo_results),
        ("percentage", metrics.percentages(places), percentage_results),
    ):
        _write_batch(finish(counted), kind, results, documents and f"{documents}-{kind}", replace)


def batch_shares(
    spark: SparkSession,
    dump: str,
    results: str,
    window: str = "15 minutes",
    keep_no_lang: bool = False,
    documents: str | None = None,
    replace: bool = False,
) -> None:
    shared = shares.share_of_posts(
        _replay(spark, "lang", dump), window, "retweeter", keep_no_lang
    )
    _write_batch(labelled(shared), "share", results, documents, replace)


# Streams ----------------------------------------------------------------------


def _file(
    spark: SparkSession,
    inbox: str,
    out: str,
    window: str,
    time: str,
    delay: str,
    max_files: int | None,
    idle: float | None,
    pace: float,
    trigger: dict,
) -> StreamingQuery:
    """Start the only parse of the input, and the clock that goes on when it is silent."""
    facts, reach = f"{out}/facts", f"{window} {delay}"
    query = archive.start_filing(spark, inbox, facts, f"{out}/checkpoints/facts", window, delay, time, max_files=max_files, **trigger)
    if not trigger or "availableNow" in trigger or "once" in trigger:
        runner.finish_query(query)
        latest = archive.totals(spark, facts).get("latest")
        if idle is not None and latest is not None:
            archive.tick(spark, facts, latest + archive.length_of(spark, reach))
    elif idle is not None:
        archive.IdleClock(spark, facts, query, reach, idle, pace).start()
    return query


def _chosen(outputs: str, known: str) -> list[str]:
    chosen = [name.strip() for name in outputs.split(",")]
    if unknown := set(chosen) - {*known.split(","), "console"}:
        raise ValueError(f"unknown outputs: {', '.join(sorted(unknown))}")
    return chosen


def _targets(kind: str, out: str, chosen: list[str], suffix: str = "") -> dict[str, runner.Write]:
    writers = {
        "results": files.result_writer(kind),
        "documents": files.document_writer(kind),
        "console": files.show,
    }
    return {f"{out}/{name}{suffix}": write for name, write in writers.items() if name in chosen}


def _start_job(
    spark: SparkSession,
    inbox: str,
    out: str,
    dump: str,
    counted,
    finishes: dict[str, runner.Finish],
    time: str,
    delay: str,
    outputs: str,
    max_files: int | None,
    state_partitions: int | None,
    files_per_batch: int,
    replace: bool,
    merge: int,
    idle: float | None,
    pace: float,
    window: str,
    trigger: dict,
) -> list[StreamingQuery]:
    """``counted`` turns facts into the stateful stream, ``finishes`` its closed windows into results by kind."""
    chosen = _chosen(outputs, ALL_OUTPUTS)
    targets: dict[str, runner.Write] = {}
    common, gathered = None, None
    if len(finishes) == 1:
        # One result is finished once for all its outputs, several each from the counts.
        ((kind, common),) = finishes.items()
        targets, gathered = _targets(kind, out, chosen), files_per_batch
    else:
        for kind, finish in finishes.items():
            for path, write in _targets(kind, out, chosen, f"-{kind}").items():
                targets[path] = runner.after(finish, write, files_per_batch)
    if replace:
        for path in (*targets, f"{out}/checkpoints/results"):
            remove_folder(spark, path)
    if "documents" in chosen:
        for kind in finishes:
            files.prepare_target(spark, kind, f"{out}/documents" + (f"-{kind}" if len(finishes) > 1 else ""))
    if time not in metrics.TIMES:
        raise ValueError(f"time is one of {', '.join(metrics.TIMES)}")
    started = [_file(spark, inbox, out, window, time, delay, max_files, idle, pace, trigger)]
    facts = f"{out}/facts"
    if "dump" in chosen:
        outputs_ = {f"{out}/dump": files.dump_writer(dump)}
        posted = archive.stream_archive(spark, facts).filter("id is not null")
        started.append(runner.start(posted, f"{out}/checkpoints/dump", outputs_, merge=merge, **trigger))
    if targets:
        stream = counted(archive.in_time(archive.stream_archive(spark, facts, time), window, delay, time))
        started.append(
            runner.start(
                stream, f"{out}/checkpoints/results", targets, common, state_partitions, gathered, merge=merge, **trigger
            )
        )
    return started


def stream_totals(
    spark: SparkSession,
    inbox: str,
    out: str,
    window: str = "15 minutes",
    time: str = "event",
    delay: str = metrics.DELAY,
    outputs: str = ALL_OUTPUTS,
    max_files: int | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 8,
    replace: bool = False,
    merge: int = 0,
    idle: float | None = None,
    pace: float = 1.0,
    **trigger,
) -> list[StreamingQuery]:
    return _start_job(
        spark, inbox, out, "total", lambda facts: counts.reposts_per_window(facts, window), {"total": labelled},
        time, delay, outputs, max_files, state_partitions, files_per_batch, replace, merge, idle, pace, window, trigger,
    )


def stream_top_posts(
    spark: SparkSession,
    inbox: str,
    out: str,
    window: str = "1 minute",
    x: int = 5,
    time: str = "event",
    delay: str = metrics.DELAY,
    outputs: str = ALL_OUTPUTS,
    max_files: int | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 8,
    replace: bool = False,
    merge: int = 0,
    idle: float | None = None,
    pace: float = 1.0,
    **trigger,
) -> list[StreamingQuery]:
    """The state holds numbers only; names and texts come from the slices of ``facts`` where winners were posted."""

    def look_up(winners: DataFrame) -> DataFrame:
        return archive.posts_at(winners.sparkSession, f"{out}/facts", winners, time)

    return _start_job(
        spark, inbox, out, "top",
        lambda facts: ranking.numbered(facts, window), {"top": lambda closed: metrics.ranked_again(closed, x, look_up)},
        time, delay, outputs, max_files, state_partitions, files_per_batch, replace, merge, idle, pace, window, trigger,
    )


def stream_countries(
    spark: SparkSession,
    inbox: str,
    out: str,
    capitals: DataFrame,
    window: str = "15 minutes",
    lang_of: str = "author",
    keep_no_lang: bool = False,
    places: int = 2,
    time: str = "event",
    delay: str = metrics.DELAY,
    outputs: str = ALL_OUTPUTS,
    max_files: int | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 8,
    replace: bool = False,
    merge: int = 0,
    idle: float | None = None,
    pace: float = 1.0,
    **trigger,
) -> list[StreamingQuery]:
    """Both country metrics from one count; their folders end in ``-geo`` and ``-percentage``."""
    finishes = {"geo": metrics.located(capitals), "percentage": metrics.percentages(places)}
    return _start_job(
        spark, inbox, out, "lang",
        lambda facts: counts.reposts_per_language(facts, window, lang_of, keep_no_lang), finishes,
        time, delay, outputs, max_files, state_partitions, files_per_batch, replace, merge, idle, pace, window, trigger,
    )


def stream_shares(
    spark: SparkSession,
    inbox: str,
    out: str,
    window: str = "15 seconds",
    lang_of: str = "retweeter",
    keep_no_lang: bool = False,
    time: str = "event",
    delay: str = metrics.DELAY,
    outputs: str = ALL_OUTPUTS,
    max_files: int | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 8,
    replace: bool = False,
    merge: int = 0,
    idle: float | None = None,
    pace: float = 1.0,
    **trigger,
) -> list[StreamingQuery]:
    return _start_job(
        spark, inbox, out, "lang",
        lambda facts: shares.share_of_posts(facts, window, lang_of, keep_no_lang), {"share": labelled},
        time, delay, outputs, max_files, state_partitions, files_per_batch, replace, merge, idle, pace, window, trigger,
    )


def stream_panes(
    spark: SparkSession,
    inbox: str,
    out: str,
    pane: str = "1 minute",
    series_key: str | None = None,
    time: str = "event",
    delay: str = metrics.DELAY,
    max_files: int | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 8,
    merge: int = 10,
    idle: float | None = None,
    pace: float = 1.0,
    **trigger,
) -> list[StreamingQuery]:
    """Reposts per short window into ``panes``, per language if ``series_key`` is ``lang``.

    :func:`roll_up` makes windows of any sizes of them, as often as asked for.
    """
    filing = _file(spark, inbox, out, pane, time, delay, max_files, idle, pace, trigger)
    facts = archive.in_time(archive.stream_archive(spark, f"{out}/facts", time), pane, delay, time)
    counted = counts.reposts_per_language(facts, pane) if series_key == "lang" else counts.panes(counts.reposts(facts), pane)
    outputs = {f"{out}/panes": runner.parquet}
    panes = runner.start(counted, f"{out}/checkpoints/panes", outputs, None, state_partitions, files_per_batch, merge=merge, **trigger)
    return [filing, panes]


def roll_up(
    spark: SparkSession, out: str, results: str, sizes: str = "1 minute,15 minutes,1 hour", series_key: str | None = None
) -> None:
    """Totals of several window sizes from the panes under ``out``: parquet, a folder ``size=…`` each."""
    panes = spark.read.parquet(*batches.current(spark, f"{out}/panes"))
    wanted = [size.strip() for size in sizes.split(",")]
    rolled = counts.rolled_up(panes, wanted, *([series_key] if series_key else []))
    rolled.write.mode("overwrite").partitionBy("size").parquet(results)


def _facts(
    spark: SparkSession, inbox: str, max_files: int | None, time: str, delay: str
) -> DataFrame:
    return metrics.with_time(posts.stream_facts(spark, inbox, max_files), time, delay)


def stream_series(
    spark: SparkSession,
    inbox: str,
    out: str,
    window: str = "1 minute",
    time: str = "event",
    delay: str = metrics.DELAY,
    series_key: str | None = None,
    max_files: int | None = None,
    state_partitions: int | None = None,
    **trigger,
) -> StreamingQuery:
    """First half of the prediction job: closed windows into ``series``, per language if ``series_key`` is ``lang``."""
    facts = _facts(spark, inbox, max_files, time, delay)
    counted = counts.reposts_per_language(facts, window) if series_key == "lang" else counts.reposts_per_window(facts, window)
    return runner.start_file_sink(
        labelled(counted), f"{out}/series", f"{out}/checkpoints/series", state_partitions, **trigger
    )


def stream_predictions(
    spark: SparkSession,
    out: str,
    window: str = "1 minute",
    history: int = 5,
    step: float = 0.1,
    series_key: str | None = None,
    outputs: str = "results,documents",
    files_per_batch: int = 8,
    replace: bool = False,
    merge: int = 0,
    **trigger,
) -> StreamingQuery:
    """Second half: predictions for the windows in ``series``, one result folder per predictor.

    With ``replace`` earlier predictions and the state go, and the series is predicted from its beginning.
    """
    chosen = _chosen(outputs, "results,documents")
    targets: dict[str, runner.Write] = {}
    if "documents" in chosen:
        targets[f"{out}/documents"] = files.document_writer("prediction")
    if "results" in chosen:
        targets |= {f"{out}/results-{name}": files.prediction_writer(name) for name in predictors.TYPES}
    if "console" in chosen:
        targets[f"{out}/console"] = files.show
    if replace:
        for path in (*targets, f"{out}/state", f"{out}/checkpoints/predictions"):
            remove_folder(spark, path)
    if "documents" in chosen:
        files.prepare_target(spark, "prediction", f"{out}/documents")
    return runner.start(
        predictors.stream_series(spark, f"{out}/series", series_key),
        f"{out}/checkpoints/predictions",
        targets,
        files_per_batch=files_per_batch,
        finish_batch=predictors.carrying(f"{out}/state", window, history, step, series_key),
        merge=merge,
        **trigger,
    )


def _start_comparison(
    metric,
    kind: str,
    earlier: DataFrame,
    out: str,
    state_partitions: int | None,
    files_per_batch: int,
    outputs: str,
    replace: bool,
    merge: int,
    trigger: dict,
) -> StreamingQuery:
    """The earlier run is read once, before the start, and reduced to its time-of-day slots."""
    chosen = _chosen(outputs, "comparison")
    targets = {f"{out}/{name}": {"comparison": runner.parquet, "console": files.show}[name] for name in chosen}
    if replace:
        for path in (*targets, f"{out}/checkpoints/comparison"):
            remove_folder(earlier.sparkSession, path)
    stream, finish = metric
    slots = written(comparison.earlier_slots(earlier, kind), "slots")
    return runner.start(
        stream,
        f"{out}/checkpoints/comparison",
        targets,
        lambda closed: comparison.with_slots(finish(closed), slots, kind),
        state_partitions,
        files_per_batch,
        merge=merge,
        **trigger,
    )


def compare_totals(
    spark: SparkSession,
    inbox: str,
    batch_results: str,
    out: str,
    window: str = "15 seconds",
    time: str = "event",
    delay: str = metrics.DELAY,
    max_files: int | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 8,
    outputs: str = "comparison",
    replace: bool = False,
    merge: int = 0,
    **trigger,
) -> StreamingQuery:
    metric = metrics.reposts_per_window(_facts(spark, inbox, max_files, time, delay), window)
    earlier = dumps.read_results(spark, "total", batch_results)
    return _start_comparison(
        metric, "total", earlier, out, state_partitions, files_per_batch, outputs, replace, merge, trigger
    )


def compare_percentages(
    spark: SparkSession,
    inbox: str,
    batch_results: str,
    out: str,
    window: str = "15 seconds",
    lang_of: str = "retweeter",
    keep_no_lang: bool = False,
    places: int = 2,
    time: str = "event",
    delay: str = metrics.DELAY,
    max_files: int | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 8,
    outputs: str = "comparison",
    replace: bool = False,
    merge: int = 0,
    **trigger,
) -> StreamingQuery:
    """By the reposter's language, as the replayed batch results are."""
    facts = _facts(spark, inbox, max_files, time, delay)
    metric = metrics.percentage_per_language(facts, window, lang_of, places, keep_no_lang)
    earlier = dumps.read_results(spark, "percentage", batch_results)
    return _start_comparison(
        metric, "percentage", earlier, out, state_partitions, files_per_batch, outputs, replace, merge, trigger
    )


def compare_shares(
    spark: SparkSession,
    inbox: str,
    batch_results: str,
    out: str,
    window: str = "15 minutes",
    lang_of: str = "retweeter",
    keep_no_lang: bool = False,
    time: str = "event",
    delay: str = metrics.DELAY,
    max_files: int | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 8,
    outputs: str = "comparison",
    replace: bool = False,
    merge: int = 0,
    **trigger,
) -> StreamingQuery:
    facts = _facts(spark, inbox, max_files, time, delay)
    metric = metrics.share_per_language(facts, window, lang_of, keep_no_lang)
    earlier = dumps.read_results(spark, "share", batch_results)
    return _start_comparison(
        metric, "share", earlier, out, state_partitions, files_per_batch, outputs, replace, merge, trigger
    )


def flatten_index_dump(spark: SparkSession, dump: str, out: str, schema: str | None = None) -> None:
    """Index dumps (JSON arrays of hits) to plain comma-separated lines.

    Each document by its own keys in its own order, or all by the fields of a given schema.
    """
    if schema is None:
        lines = dumps.flattened_lines(dumps.array_elements(spark, dump))
        lines.write.mode("overwrite").text(out)
    else:
        files.write_flattened(dumps.read_index_dump(spark, dump, schema), out)
