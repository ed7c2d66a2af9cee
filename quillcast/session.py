"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "quillcast", cores: str = "8", memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for stream checkpoints and written intermediates.

    It lies under ``spark.checkpoint.dir``, the shared folder a cluster names.
    Only a local master may go without that setting: there all tasks see the
    machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a file or folder another name in the same file system; the target must not exist yet."""
    source, system = _file_system(spark, path)
    goal, _ = _file_system(spark, target)
    system.mkdirs(goal.getParent())
    if not system.rename(source, goal):
        raise OSError(f"cannot move {path} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file."""
    target, system = _file_system(spark, path)
    out = system.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small file."""
    source, system = _file_system(spark, path)
    stream = system.open(source)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    """Give all files of a folder a time of modification."""
    folder, system = _file_system(spark, path)
    for status in system.listStatus(folder):
        system.setTimes(status.getPath(), millis, -1)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create an empty folder in whatever file system the path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a result folder that is about to be written anew."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder."""
    folder, system = _file_system(spark, path)
    return system.getContentSummary(folder).getLength()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


_taken = threading.local()


@contextmanager
def taken_since() -> Iterator[list[str]]:
    """The folders that :func:`written` takes meanwhile in this thread, complete at the end."""
    before, found = getattr(_taken, "folders", []), []
    _taken.folders = []
    try:
        yield found
    finally:
        found += _taken.folders
        _taken.folders = [*before, *found]


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what :func:`written` has written meanwhile in this thread.

    For work whose results are written elsewhere before it ends, a micro-batch say.
    """
    with taken_since() as folders:
        try:
            yield
        finally:
            for path in _taken.folders:
                remove_folder(spark, path)


#: Whether a query's shuffle files go when it ends, and not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: By session, how many threads are in :func:`shuffles_removed` and what the setting was before the first.
_removing: dict[str, tuple[int, str | None]] = {}
_turn = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin meanwhile leave no shuffle files.

    Only for frames that are computed once: a second run of the same frame would have to write the files anew.
    """
    own = spark._jsparkSession.sessionUUID()
    with _turn:
        inside, before = _removing.get(own) or (0, spark.conf.get(SHUFFLES_GO, None))
        _removing[own] = inside + 1, before
        spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        with _turn:
            inside, before = _removing.pop(own)
            if inside > 1:
                _removing[own] = inside - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLES_GO)
            else:
                spark.conf.set(SHUFFLES_GO, before)


def written(frame: DataFrame, label: str) -> DataFrame:
    """Compute a frame once into the scratch folder and go on from the files.

    Cuts the lineage so that lost executors cost no recomputation of it, and gives
    the planner the true size. What was shuffled for it is removed at once.
    """
    path = scratch_dir(frame.sparkSession, label)
    _taken.folders = [*getattr(_taken, "folders", []), path]
    with shuffles_removed(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
