"""Table and file sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import markets
from ..operators.cdc import latest_image
from ..operators.ordered import join_same
from ..operators.submissions import market_file

# Table: date its folders come from, columns that cluster the rows inside a file
LAYOUT = {
    "fct_lifecycle": ("placed_at", ["slip_status"]),
    "fct_activity": ("occurred_at", ["vertical", "account_id"]),
    "fct_payments": ("requested_ts", ["jurisdiction", "status"]),
    "fct_ledger": ("ts", ["account_id"]),
    "platform_sessions": ("started_at", ["account_id"]),
}
ROWS_PER_FILE = 20_000_000


def write_table(df: DataFrame, path: str, name: str) -> None:
    """Full refresh, one folder per date, rows clustered inside the files. The
    range exchange cuts a date that outgrows a task into several files."""
    date_of, cluster = LAYOUT[name]
    dated = df.withColumn("dt", F.to_date(date_of))
    (dated.repartitionByRange("dt", *cluster).sortWithinPartitions("dt", *cluster)
     .write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("dt").parquet(path))


def table_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def touched_partitions(old: DataFrame, new: DataFrame, keys: list[str], partitions: list[str]) -> DataFrame:
    """Partitions of ``new``, and of the rows of ``old`` with its keys: a scan of the
    key and partition columns alone."""
    held = old.select(*dict.fromkeys([*keys, *partitions]))
    held = held.join(new.select(*keys).distinct(), keys, "left_semi").select(*partitions)
    return held.union(new.select(*partitions)).distinct()


def merge_incremental(old: DataFrame | None, new: DataFrame, keys: list[str], partitions: list[str],
                      version: str) -> DataFrame:
    """Old rows of the touched partitions with new rows put over them by key. Touched
    are the partitions ``new`` writes to and those that hold an older row of its keys,
    so a key that moves to another partition leaves none behind. Only touched
    partitions come back, so a dynamic overwrite leaves the rest."""
    fresh = new.withColumns({"_commit_ts": F.col(version), "_op": F.lit("U"), "_gen": F.lit(1)})
    if old is None:
        merged = fresh
    else:
        kept = join_same(old, touched_partitions(old, new, keys, partitions), partitions).withColumns(
            {"_commit_ts": F.col(version), "_op": F.lit("U"), "_gen": F.lit(0)})
        merged = kept.unionByName(fresh, allowMissingColumns=True)
    return latest_image(merged, [*keys], ["_gen"]).drop("_commit_ts", "_op", "_gen")


INDEX_WORDS = 1 << 14  # 64-bit words in the bit table of one partition
INDEX_PROBES = 3


def index_path(path: str) -> str:
    return path.rstrip("/") + "__index"


def _probes(keys: list[str]) -> Column:
    """The (word, bit) places of a key in a bit table."""
    h = [F.xxhash64(F.lit(i), *[x for k in keys for x in (F.col(k), F.col(k).isNull())]) for i in range(INDEX_PROBES)]
    return F.array(*[F.struct(F.pmod(x, F.lit(INDEX_WORDS)).cast("int").alias("word"),
                              F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(x, 32), F.lit(64)).cast("int")).alias("bit")) for x in h])


def key_bits(rows: DataFrame, keys: list[str], partitions: list[str]) -> DataFrame:
    """The bit table of each partition: its words that are not empty. At most ``INDEX_WORDS`` rows for a partition."""
    return (rows.select(*partitions, F.inline(_probes(keys))).groupBy(*partitions, "word").agg(F.bit_or("bit").alias("mask")))


def may_hold(bits: DataFrame, new: DataFrame, keys: list[str], partitions: list[str]) -> DataFrame:
    """Partitions whose bit table has every bit of at least one key of ``new``; all that hold such a key are among them."""
    asked = new.select(*keys).distinct().withColumn("_key", F.xxhash64(*[x for k in keys for x in (F.col(k), F.col(k).isNull())]))
    asked = asked.select("_key", F.inline(F.array_distinct(_probes(keys))))
    asked = asked.groupBy("_key", "word").agg(F.bit_or("bit").alias("bit"))
    wanted = asked.groupBy("_key").agg(F.count("*").alias("_words"))
    met = bits.join(asked, "word").where(F.col("mask").bitwiseAND(F.col("bit")) == F.col("bit"))
    met = met.groupBy("_key", *partitions).agg(F.count("*").alias("_met")).join(wanted, "_key")
    return met.where("_met = _words").select(*partitions).distinct()


def only_partitions(table: DataFrame, wanted: list, partitions: list[str]) -> DataFrame:
    """Rows of the named partitions, as a condition that prunes folders."""
    keep = F.lit(False)
    for row in wanted:
        one = F.lit(True)
        for p in partitions:
            one = one & (F.col(p).isNull() if row[p] is None else F.col(p) == F.lit(row[p]))
        keep = keep | one
    return table.where(keep)


def upsert_partitions(spark: SparkSession, new: DataFrame, path: str, keys: list[str],
                      partitions: list[str], version: str) -> None:
    """Keyed upsert on plain Parquet: rewrites only the touched partitions and reads only those that may hold a key of
    ``new``, as the bit tables beside the table say (``index_path``; a table without them is scanned once to build them). The
    merged rows go to a staging folder first, so the table is never read and
    overwritten by one job, and a retried task cannot lose rows. Partitions that all
    rows have left are removed last; an upsert that stopped before can run again: bit tables only gain bits
    until the rows are written, so they never miss a key."""
    old, index = spark.read.parquet(path) if table_exists(spark, path) else None, index_path(path)
    if old is not None:
        if not table_exists(spark, index):
            key_bits(old, keys, partitions).write.partitionBy(*partitions).parquet(index)
        bits = spark.read.schema(_typed(old, partitions, "word int, mask bigint")).parquet(index)
        wanted = may_hold(bits, new, keys, partitions).union(new.select(*partitions)).distinct().collect()  # as many as partitions at most
        old = only_partitions(old, wanted, partitions)
    merged = merge_incremental(old, new, keys, partitions, version)
    staging = path.rstrip("/") + "__staging"
    merged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staging)
    rows = spark.read.schema(merged.schema).parquet(staging)
    left = [] if old is None else _left_folders(old, new, rows, keys, partitions)
    order = dict.fromkeys([*partitions, *keys])
    fresh = key_bits(rows, keys, partitions)
    if old is None:
        fresh.write.mode("overwrite").partitionBy(*partitions).parquet(index)
    else:  # the bits of what is there and of what comes, until the rows are in place
        touched = only_partitions(bits, wanted, partitions)
        both = touched.unionByName(fresh).groupBy(*partitions, "word").agg(F.bit_or("mask").alias("mask"))
        both.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(index + "__staging")
        _overwrite(spark.read.schema(both.schema).parquet(index + "__staging"), index, partitions)
    _overwrite(rows.repartitionByRange(*order), path, partitions)
    if old is not None:
        _overwrite(fresh, index, partitions)
    for folder in left:
        for root in (folder, index + folder[len(_root(folder, path)):]):
            target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(root))
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _typed(table: DataFrame, partitions: list[str], columns: str) -> str:
    return columns + "".join(f", `{p}` {table.schema[p].dataType.simpleString()}" for p in partitions)


def _root(folder: str, path: str) -> str:
    """The part of a folder's address that names the table."""
    name = path.rstrip("/").split("/")[-1] + "/"
    return folder[:folder.rindex("/" + name) + len(name)]


def _overwrite(rows: DataFrame, path: str, partitions: list[str]) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def _left_folders(old: DataFrame, new: DataFrame, merged: DataFrame, keys: list[str],
                  partitions: list[str]) -> list[str]:
    """Folders of touched partitions that have no row in ``merged``; as many as partitions at most."""
    touched = touched_partitions(old, new, keys, partitions)
    empty = touched.exceptAll(merged.select(*partitions).distinct())
    files = old.select(*partitions, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_folder"))
    return [r[0] for r in join_same(files.distinct(), empty, partitions).select("_folder").distinct().collect()]


def log_append(log: DataFrame, new: DataFrame) -> DataFrame:
    """New delivery rows that are not in the log yet; (type, key) is logged once."""
    key = ["record_type", "record_key"]
    return new.dropDuplicates(key).join(log.select(*key), key, "left_anti")


def log_replace(log: DataFrame, new: DataFrame) -> DataFrame:
    """The log with re-filed records superseding the older receipt."""
    both = log.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)))
    cols = [c for c in log.columns if c not in ("record_type", "record_key")]
    best = both.groupBy("record_type", "record_key").agg(
        F.max(F.struct("submitted_at", "_gen", *[c for c in cols if c != "submitted_at"])).alias("r"))
    return best.select("record_type", "record_key", *[F.col(f"r.{c}").alias(c) for c in cols])


def fan_out(df: DataFrame, root: str, wanted: list[str], folders: tuple[str, ...] = ("jurisdiction", "report_date")) -> None:
    """The files of all markets in one write: a folder per market and report date (or per market alone). A column that a market
    does not declare is NULL in its rows and takes no room in its files; :func:`market_rows` gives each market exactly its own."""
    declared = {m: [*markets.BETTING_FILES[m], *markets.EXTENSIONS.get(m, [])] for m in wanted}
    columns = []
    for name in dict.fromkeys(x for names in declared.values() for x in names):
        has = [m for m in wanted if name in declared[m]]
        columns.append(F.when(F.col("jurisdiction").isin(has), F.col(name)).alias(name) if len(has) < len(wanted) else F.col(name))
    rows = df.filter(F.col("jurisdiction").isin(wanted)).select("jurisdiction", "report_date", *columns)
    order = [F.col("jurisdiction"), F.col("report_date")]
    (rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", ROWS_PER_FILE)
     .partitionBy(*folders).parquet(root))


def market_rows(spark: SparkSession, root: str, market: str) -> DataFrame:
    """One market's file as written by :func:`fan_out`: its folders and exactly its declared columns are read."""
    return market_file(spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/jurisdiction={market}"), market).drop("jurisdiction")


def write_documents(documents: DataFrame, root: str) -> None:
    """Serialised documents, one folder per file name below market and record type, and a manifest that tells each name's
    record, suffix and receipt. ``documents``: jurisdiction, record_type, record_key, record_id, suffix (or NULL),
    receipt_id, seq, payload."""
    name = F.concat(F.format_string("%06d-%s", "seq", "record_id"), F.coalesce(F.concat(F.lit("-"), "suffix"), F.lit("")), F.lit(".xml"))
    named = documents.withColumn("file_name", name)
    place = ["jurisdiction", "record_type", "file_name"]
    (named.select(*place, F.col("payload").alias("value")).repartitionByRange(*place).sortWithinPartitions(*place)
     .write.mode("overwrite").partitionBy(*place).text(f"{root.rstrip('/')}/files"))
    (named.select(*place, "record_key", "record_id", "suffix", "receipt_id", F.octet_length("payload").alias("bytes"))
     .write.mode("overwrite").parquet(f"{root.rstrip('/')}/manifest"))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/manifest")


def write_xml(df: DataFrame, root: str, root_tag: str, row_tag: str) -> None:
    """Rows as XML files by market and record type through Spark's XML source."""
    (df.write.format("xml").mode("overwrite").option("rootTag", root_tag).option("rowTag", row_tag)
     .partitionBy("jurisdiction", "record_type").save(root))


def document_paths(spark: SparkSession, root: str) -> DataFrame:
    """Paths of stored documents; the file content is never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(f"{root.rstrip('/')}/files").select("path"))
