"""Tables written between jobs: they cut the lineage, so a lost executor costs its own tasks alone."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder: str | None = None
_recording = threading.local()  # queries may be planned in threads of their own
_writing: dict[int, list[str | None]] = {}  # by session: for each write under way the setting before the first
_turn = threading.Lock()


def work_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where a
    local session names none, as in tests. A cluster must name one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/ledgertide"
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    global _local_folder
    _local_folder = _local_folder or tempfile.mkdtemp(prefix="spark-ledgertide-")
    return _local_folder


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """A block whose writes delete their shuffles at their end. Writes may overlap: the setting goes with the last one."""
    with _turn:
        held = _writing.setdefault(id(spark), [])
        held.append(held[0] if held else spark.conf.get(CLEAN_UP, None))
        spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        with _turn:
            before = held.pop()
            if not held and before is None:
                spark.conf.unset(CLEAN_UP)
            elif not held:
                spark.conf.set(CLEAN_UP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back. The shuffles of the write go with its end, as nothing reads them again."""
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    for folders in getattr(_recording, "open", ()):
        folders.append(path)
    with shuffles_go(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that ``staged`` writes in the block, in this thread."""
    folders: list[str] = []
    _recording.open = [*getattr(_recording, "open", ()), folders]
    try:
        yield folders
    finally:
        _recording.open = _recording.open[:-1]


def release(spark: SparkSession, folders: Sequence[str]) -> None:
    """Deletes folders that ``staged`` wrote. Nothing may read them any more."""
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, staged; the tables that ``make`` staged on the way are deleted once that is written."""
    with recorded() as folders:
        df = make()
    out = staged(df, name)
    release(df.sparkSession, folders)
    return out
