"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words and a schedule of intensity over training time 0 to 1. Integrating
the schedule gives its cumulative demand; a document that begins after ``c`` words of its source stands where the
demand reaches ``c``, found by inverting the integral. Range-sorting all documents by that position gives the
training order. A source whose target exceeds its size is passed through again, up to ``max_passes`` times.

Targets: every source shares the total by weight; a target stops at ``max_passes`` times its source's size and the
excess is reshared by weight among the others (solved at once by sorting sources by the point at which they fill).
A document is taken in a pass if its middle word lies before the target, so each source's words come within half
a document of its target.

Within a source, documents follow the MD5 of their id, the same on every run. Running sums come from sums per cell
(source and leading bits of the MD5) and sums within a cell, so that no task holds a source.

Defined results: a null text has size 0. Null is a source of its own, last in order. A null id is placed by its
text. Repeated rows are separate documents. A source without words has target 0 and its documents are taken once, with
0 words. An empty table gives an empty result. Extra columns are ignored, or carried where asked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertide.llm.common import SPACE_CLASS, hex_position, is_table, row_keys, staged, table, text_hash

MAX_PASSES = 3
CELLS = 1 << 12
# Intensity at evenly spaced times, by weight: light sources early, heavy sources late.
SCHEDULES = [[1.5, 1.0, 0.5], [1.0, 1.0, 1.0], [0.5, 1.0, 1.5]]


def word_count(text: Column) -> Column:
    parts = F.split(text, SPACE_CLASS)
    return F.coalesce(F.size(F.array_remove(parts, "")), F.lit(0)).cast("long") * text.isNotNull().cast("long")


def source_targets(rows: DataFrame, weights: list[int], max_passes: int) -> DataFrame:
    """Per source: ``weight``, ``source_size`` and ``target``. ``rows`` has ``src`` and ``size``. The table has one
    row per source, so its windows need no partitions."""
    per = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("src").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)).cast("int")))
    per = per.withColumn("full", F.col("source_size") * F.lit(float(max_passes)))
    fills = W.orderBy(F.col("full") / F.col("weight"), F.col("src").asc_nulls_last())
    everything = W.partitionBy()
    total = F.sum("source_size").over(everything)
    # Sources fill in this order as the level (words per unit of weight) rises.
    filled_before = F.coalesce(F.sum("full").over(fills.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(fills.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("level", (total - filled_before) / weight_left)
    fills_up = F.col("full") <= F.col("level") * F.col("weight")
    # Levels rise until the first source that doesn't fill and fall from there: that one's level is final.
    final = F.max(F.when(~fills_up, F.col("level"))).over(everything)
    return per.withColumn("target", F.when(fills_up, F.col("full")).otherwise(F.col("weight") * final)).select(
        "src", "weight", "source_size", "target")


def inverse_demand(fraction: Column, intensity: Column) -> Column:
    """The time at which a piecewise linear intensity, integrated from 0 and scaled to 1, reaches ``fraction``."""
    pieces = F.size(intensity) - 1
    area = F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: F.struct(
        i.alias("i"), ((F.get(intensity, i) + F.get(intensity, i + 1)) / 2).alias("size")))
    whole = F.aggregate(area, F.lit(0.0), lambda a, x: a + x["size"])
    start = F.struct(F.lit(0).alias("i"), (fraction * whole).alias("rest"))
    found = F.aggregate(area, start, lambda s, x: F.when(  # moves on only from the piece it stands in
        (s["i"] == x["i"]) & (s["rest"] > x["size"]) & (s["i"] < pieces - 1),
        F.struct((s["i"] + 1).alias("i"), (s["rest"] - x["size"]).alias("rest"))).otherwise(s))
    a, b = F.get(intensity, found["i"]), F.get(intensity, found["i"] + 1)
    slope, rest = b - a, F.greatest(found["rest"], F.lit(0.0))
    root = F.sqrt(F.greatest(a * a + 2 * slope * rest, F.lit(0.0)))
    step = F.when(rest <= 0, 0.0).otherwise(2 * rest / (a + root))
    return F.least((found["i"] + F.least(step, F.lit(1.0))) / pieces, F.lit(1.0))


def mix(docs: DataFrame, weights: list[int] | None = None, schedules: list[list[float]] | None = None,
        max_passes: int = MAX_PASSES, cells: int = CELLS, carry: list[str] | None = None) -> DataFrame:
    """Per document: the carried columns (default doc_id), ``size``, ``source_size``, ``target``, ``copies``, ``taken`` and
    ``positions`` (the training position of each copy)."""
    carry = carry or ["doc_id"]
    weights = weights or [1, 2, 3]
    schedules = schedules or SCHEDULES
    names = [f"c{i}" for i in range(len(carry))]
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text-"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    rows = staged(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)], F.col("source").alias("src"),
                              word_count(F.col("text")).alias("size"), hex_position(key).alias("place"),
                              text_hash(F.col("text")).alias("th")), "mix-rows")
    rows = rows.withColumn("cell", F.shiftright("place", 60 - (cells.bit_length() - 1)).cast("int"))
    targets = source_targets(rows, weights, max_passes)
    per_cell = rows.groupBy("src", "cell").agg(F.sum("size").alias("cell_size"))
    cell_start = F.sum("cell_size").over(W.partitionBy("src").orderBy("cell")) - F.col("cell_size")
    cell_table = per_cell.withColumn("cell_start", cell_start).join(targets, per_cell["src"].eqNullSafe(targets["src"])).select(
        per_cell["src"].alias("cell_src"), F.col("cell").alias("cell_no"), "cell_start", "weight", "source_size", "target")
    in_cell = F.sum("size").over(W.partitionBy("src", "cell").orderBy("place", "th", "size")
                                 .rowsBetween(W.unboundedPreceding, -1))
    placed = rows.withColumn("in_cell", F.coalesce(in_cell, F.lit(0))).join(
        cell_table, F.col("src").eqNullSafe(F.col("cell_src")) & (F.col("cell") == F.col("cell_no")))
    placed = placed.withColumn("begins", (F.col("cell_start") + F.col("in_cell")).cast("double"))
    passes = F.floor((F.col("target") - F.col("begins") - F.col("size") / 2) / F.col("source_size")) + 1
    copies = F.when(F.col("source_size") == 0, 1).otherwise(F.least(F.greatest(passes, F.lit(0)), F.lit(max_passes))).cast("int")
    placed = placed.withColumn("copies", copies)
    which = F.array_position(F.array(*[F.lit(float(w)) for w in weights]), F.col("weight")) - 1
    intensity = F.get(F.array(*[F.array(*map(F.lit, s)) for s in (schedules * len(weights))[:len(weights)]]), which.cast("int"))
    at = F.when(F.col("copies") > 0, F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1),
        lambda e: F.when(F.col("target") > 0, inverse_demand(
            F.least((F.col("begins") + e * F.col("source_size")) / F.col("target"), F.lit(1.0)), F.col("intensity"))
        ).otherwise(F.lit(0.0)))).otherwise(F.array().cast("array<double>"))
    placed = placed.withColumn("intensity", intensity).withColumn("positions", at)
    return placed.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], "size", "source_size", "target", "copies",
                         (F.col("size") * F.col("copies")).cast("long").alias("taken"), "positions")


def in_training_order(mixed: DataFrame, *order: str) -> DataFrame:
    """Rows range-sorted by position; further columns part rows without a position, or with the same one."""
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``first_position`` is the training position of a document's first copy (null: not taken), to nine decimals."""
    mixed = mix(table(spark, sf_dir, "documents")).withColumn("first_position", F.get("positions", F.lit(0)))
    return in_training_order(mixed, "first_position", "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "copies", F.round("first_position", 9).alias("first_position"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Pipeline stage: one row per copy taken, with all columns of the documents, in training order. Positions are found for
    row keys alone; the documents meet them once and are range-sorted."""
    docs = docs if is_table(docs) else staged(docs, "mix-documents")
    narrow = docs.select("doc_id", "text", "source", *row_keys(docs))
    copies = staged(mix(narrow, carry=["__file", "__row"]).select("__file", "__row", F.explode("positions").alias("__position")), "mix-copies")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__columns"), *row_keys(docs))
    return in_training_order(copies.join(whole, ["__file", "__row"]), "__position").select("__columns.*")


OP6_SQL = """
WITH doc AS (
    SELECT doc_id, source, text,
           CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text-' || md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS place
    FROM documents),
per AS (SELECT source, sum(size)::DOUBLE AS s FROM doc GROUP BY source),
ranked AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM per),
lev AS (
    SELECT *, (sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked),
tgt AS (
    SELECT source, s, w, CASE WHEN 3 * s <= level * w THEN 3 * s
                           ELSE w * max(CASE WHEN 3 * s > level * w THEN level END) OVER () END AS target FROM lev),
run AS (
    SELECT doc.doc_id, doc.size, s, w, target,
           coalesce(sum(size) OVER (PARTITION BY doc.source ORDER BY place, text, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
    FROM doc JOIN tgt ON doc.source IS NOT DISTINCT FROM tgt.source),
-- Intensity falls from 1.5 to 0.5 at weight 1, is flat at 2 and rises at 3: in time t its integral is c0*t + (c1/2)*t*t.
demand AS (
    SELECT *, CASE WHEN s = 0 THEN 1 ELSE least(greatest(floor((target - c - size / 2.0) / s) + 1, 0), 3) END AS copies,
           CASE WHEN target > 0 THEN least(c / target, 1.0) ELSE 0.0 END AS f,
           CASE w WHEN 1 THEN 1.5 WHEN 2 THEN 1.0 ELSE 0.5 END AS c0, CASE w WHEN 1 THEN -1.0 WHEN 2 THEN 0.0 ELSE 1.0 END AS c1
    FROM run)
SELECT doc_id, size, s::BIGINT AS source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS INTEGER) AS copies,
       CASE WHEN copies > 0 THEN round(CASE WHEN f <= 0 THEN 0.0 ELSE 2 * f / (c0 + sqrt(greatest(c0 * c0 + 2 * c1 * f, 0.0))) END, 9) END AS first_position
FROM demand
"""
