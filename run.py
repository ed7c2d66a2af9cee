"""Submit one job: ``spark-submit run.py <job> <name>=<value> …``.

    spark-submit run.py stream_totals inbox=s3://…/inbox out=s3://…/totals processingTime='1 minute'
    spark-submit run.py batch_countries dump=… geo_results=… percentage_results=… capitals=s3://…/capitals.csv

Jobs and their settings are the functions of ``quillcast.plans.jobs``; ``capitals`` names
a file of capital coordinates. Stream jobs run until their queries end.
"""

from __future__ import annotations

import inspect
import sys

from pyspark.sql import SparkSession

from quillcast.plans import jobs
from quillcast.sources.capitals import read_capitals

JOBS = {
    name: job
    for name, job in inspect.getmembers(jobs, inspect.isfunction)
    if job.__module__ == jobs.__name__ and not name.startswith("_")
}
TYPES = {"int": int, "int | None": int, "float": float, "float | None": float, "bool": lambda text: text == "true"}


def settings(spark: SparkSession, job, arguments: list[str]) -> dict[str, object]:
    parameters = inspect.signature(job).parameters
    given = {}
    for argument in arguments:
        name, _, value = argument.partition("=")
        if name == "capitals":
            given[name] = read_capitals(spark, value)
        elif name in parameters:
            given[name] = TYPES.get(parameters[name].annotation, str)(value)
        else:
            given[name] = value
    return given


def main(arguments: list[str]) -> None:
    if not arguments or arguments[0] not in JOBS:
        sys.exit(f"{__doc__}\nJobs: {', '.join(JOBS)}")
    job = JOBS[arguments[0]]
    spark = SparkSession.builder.appName(f"quillcast-{arguments[0]}").getOrCreate()
    started = job(spark, **settings(spark, job, arguments[1:])) or []
    queries = started if isinstance(started, list) else [started]
    while any(query.isActive for query in queries):
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
    for query in queries:
        query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
