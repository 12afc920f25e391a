"""Helpers shared by the operators of this subpackage: staged tables, and set filters of fixed size."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a
    local session gets a folder of its own; a cluster must name one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-stage-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


_recording: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that ``staged`` writes in the block."""
    folders: list[str] = []
    _recording.append(folders)
    try:
        yield folders
    finally:
        del _recording[next(i for i, own in enumerate(_recording) if own is folders)]  # equal lists are not the same list


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def set_for(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session with a setting that holds in the block only."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, so that a
    lost executor costs no more than its own tasks. The shuffles of the write go with its end, as nothing reads them again."""
    path = new_folder(df.sparkSession, name)
    for folders in _recording:
        folders.append(path)
    with set_for(df.sparkSession, CLEAN_UP, "true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Deletes folders that ``staged`` wrote, or all of this session. Call it when the results that read them are written."""
    jvm = spark.sparkContext._jvm
    for folder in folders if folders is not None else [f"{shared_dir(spark)}/llm"]:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, staged; the tables that ``make`` staged on the way are deleted once that is written."""
    with recorded() as folders:
        df = make()
    out = staged(df, name)
    release(df.sparkSession, folders)
    return out


def is_table(df: DataFrame) -> bool:
    """Whether ``df`` is a written table as it was read, so that file and row number tell its rows apart."""
    return df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation" and bool(df.inputFiles())


def row_keys(df: DataFrame) -> tuple[Column, Column]:
    """File and row number of a written table's rows: stable keys, also where a task runs again."""
    meta = df.metadataColumn("_metadata")
    return meta["file_path"].alias("__file"), meta["row_index"].alias("__row")


def small_batches(spark: SparkSession, rows: int = 1000):
    """A block in which texts go to Python in batches of fewer rows than the default of 10,000, to bound what a task holds at
    once. What reads them must run inside the block."""
    return set_for(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_hash(text: Column) -> Column:
    """Tells rows with the same id apart, and orders them."""
    return F.xxhash64(text)


def hex_position(col: Column) -> Column:
    """The first 60 bits of the MD5 of a string, as a long of at least 0: a position that
    other engines can compute too."""
    return F.conv(F.substring(F.md5(col.cast("binary")), 1, 15), 16, 10).cast("long")


# A set filter of fixed size: two bits for each member in a bit table. It answers "surely not
# a member" or "perhaps". Its size is a parameter, so it may be sent to every task however
# much the members grow; once it is full it merely lets everything through.

FILTER_BITS = 1 << 25


def filter_bits(members: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """The bit table over a long column: at most ``bits / 32`` rows reach the driver."""
    one = members.select(F.col(column).alias("h"))
    slot = F.explode(F.array(F.col("h").bitwiseAND(F.lit(bits - 1)),
                             F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(bits - 1))))
    words = (one.select(slot.alias("slot"))
             .groupBy(F.shiftright("slot", 5).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 AS int))")).alias("mask")))
    with set_for(members.sparkSession, CLEAN_UP, "true"):
        got = words.toArrow()
    out = np.zeros(bits // 32, np.uint32)
    out[got.column("word").to_numpy()] = got.column("mask").to_numpy().astype(np.uint32)
    return out


def perhaps(table_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For uint64 hashes: False where the filter rules membership out."""
    size = np.uint64(len(table_bits) * 32 - 1)
    a, b = hashes & size, (hashes >> np.uint64(32)) & size
    five, low = np.uint64(5), np.uint64(31)

    def at(s: np.ndarray) -> np.ndarray:
        return (table_bits[(s >> five).astype(np.int64)] >> (s & low).astype(np.uint32)) & np.uint32(1)

    return (at(a) & at(b)).astype(bool)


def arrow_batches(columns: dict[str, pa.DataType], parts):
    """Record batches of the given columns from dicts of arrays, at least one so that the schema is known."""
    schema = pa.schema(list(columns.items()))
    empty = True
    for part in parts:
        empty = False
        yield pa.RecordBatch.from_arrays([pa.array(part[k], t) for k, t in columns.items()], schema=schema)
    if empty:
        yield pa.RecordBatch.from_arrays([pa.array([], t) for t in columns.values()], schema=schema)
