"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations alone.

Each shard has ``virtual_nodes`` points on the ring; a point owns the arc that ends at it, and a row hashes to
an arc. A shard keeps rows of its own arcs up to its capacity, arc after arc; rows beyond it continue
clockwise, first in first out, to the next arc whose shard still has room. Capacities are
``ceil((1 + epsilon) * rows / shards)``; with epsilon 0 they add up to the rows exactly, so counts differ by one at
most. Only overflowing rows leave the shard that plain hashing gives them.

Rows are counted per cell (arc and the leading bits of the hash) before anything is placed. The ring's state
then has one row per arc, a number fixed by the parameters, and is walked in SQL. Each row's rank within its arc
is its cell's offset plus its rank within the cell, so no task sorts more than one cell. Slots follow from the same
figures without another shuffle of rows. Where the rows have an order, slots follow it: rows are counted per shard and chunk of
the order, and a row's slot is its chunk's offset plus its rank in the chunk, so copies of a row, which share a place on
the ring, stand as far apart in their shard as they do in the order.

Defined results: a null text has size 8 and CRC-32 0 (as the empty text). A null id hashes by its text.
Repeated rows are rows of their own; ties within a cell are ordered by id, CRC and size, and rows equal in all
of these are interchangeable. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertide.llm.common import hex_position, staged, table

SHARDS = 24
VIRTUAL_NODES = 64
CELLS = 1 << 14
RING = 1 << 60
CHUNK_BITS = 12


def ring(spark: SparkSession, shards: int, virtual_nodes: int) -> DataFrame:
    """One row per arc: ``arc`` in clockwise order, the point ``lo`` it begins after, its end ``hi`` and ``shard``.
    The last arc wraps round to the first point: it is cut in two at 0, both owned by the first point's shard."""
    points = spark.range(shards * virtual_nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        hex_position(F.concat(F.lit("node-"), F.col("id").cast("string"))).alias("hi"))
    end = points.orderBy("hi", "shard").limit(1).select("shard", F.lit(RING).cast("long").alias("hi"))
    w = W.orderBy("hi", "shard")
    return (points.unionByName(end).withColumn("arc", F.row_number().over(w) - 1)
            .withColumn("lo", F.lag("hi", 1, -1).over(w)))


def arc_of(position: Column, highs: Column) -> Column:
    """The arc of a ring position: a binary search in the sorted array of arc ends, unrolled by ``aggregate``."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(highs) + F.lit(1))).cast("int") + 1)
    start = F.struct(F.lit(0).alias("a"), (F.size(highs) - 1).alias("b"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["a"] + s["b"]) / 2).cast("int")
        right = F.get(highs, middle) < position
        return F.struct(F.when(right, F.least(middle + 1, s["b"])).otherwise(s["a"]).alias("a"),
                        F.when(right, s["b"]).otherwise(middle).alias("b"))

    return F.aggregate(steps, start, halve, lambda s: s["a"])


def placements(arcs: DataFrame, counts: DataFrame, shards: int, epsilon: float) -> DataFrame:
    """Segments of each arc's ranks: ``arc, from_rank, to_rank, shard, slot0``. ``counts`` has ``arc, n``."""
    per_arc = arcs.join(counts, "arc", "left").select("arc", "shard", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    total = per_arc.agg(F.sum("n").alias("total"))
    rows = per_arc.crossJoin(F.broadcast(total))  # one row of totals
    low = F.floor(F.col("total") * F.lit(1 + epsilon) / shards).cast("long")
    spare = F.when(F.lit(epsilon) == 0, F.col("total") % shards).otherwise(F.lit(shards)).cast("long")
    capacity = low + (F.col("shard") < spare).cast("long")
    before = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("arc").rowsBetween(W.unboundedPreceding, -1)),
                        F.lit(0))
    rows = (rows.withColumn("capacity", capacity)
            .withColumn("kept", F.greatest(F.lit(0), F.least(F.col("n"), F.col("capacity") - before)))
            .withColumn("room", F.greatest(F.lit(0), F.col("capacity") - F.sum("n").over(W.partitionBy("shard"))))
            .withColumn("excess", F.col("n") - F.col("kept")))
    # The walk: two rounds clockwise with the overflow carried along. State: what is carried, the room
    # left by shard, how much was placed so far, and the placements made.
    walked = rows.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("arc", "shard", "excess"))).alias("a"),
        F.array_sort(F.collect_set(F.struct("shard", "room"))).alias("rooms"))
    laps = F.concat(F.col("a"), F.transform("a", lambda x: F.struct(
        x["arc"].alias("arc"), x["shard"].alias("shard"), F.lit(0).cast("long").alias("excess"))))
    state = F.struct(
        F.lit(0).cast("long").alias("carried"), F.transform("rooms", lambda r: r["room"]).alias("room"),
        F.lit(0).cast("long").alias("placed"),
        F.array().cast("array<struct<shard:int,lo:bigint,hi:bigint>>").alias("out"))

    def visit(s: Column, arc: Column) -> Column:
        carried = s["carried"] + arc["excess"]
        room = F.get(s["room"], arc["shard"])
        take = F.least(carried, room)
        some = take > 0
        return F.struct(
            (carried - take).alias("carried"),
            F.when(some, F.transform(s["room"], lambda r, i: F.when(i == arc["shard"], r - take).otherwise(r)))
            .otherwise(s["room"]).alias("room"),
            (s["placed"] + take).alias("placed"),
            F.when(some, F.concat(s["out"], F.array(F.struct(
                arc["shard"].alias("shard"), s["placed"].alias("lo"), (s["placed"] + take).alias("hi")))))
            .otherwise(s["out"]).alias("out"))

    moved = walked.select(F.explode(F.aggregate(laps, state, visit, lambda s: s["out"])).alias("m")).select("m.*")
    # Overflowing rows in ring order meet the placements in walking order: the r-th row takes the r-th place.
    queued = rows.where("excess > 0").withColumn(
        "q1", F.sum("excess").over(W.orderBy("arc").rowsBetween(W.unboundedPreceding, 0))).withColumn(
        "q0", F.col("q1") - F.col("excess"))
    cut_lo, cut_hi = F.greatest("q0", "lo"), F.least("q1", "hi")
    over = (queued.drop("shard").join(F.broadcast(moved), (F.col("lo") < F.col("q1")) & (F.col("hi") > F.col("q0")))
            .select("arc", (F.col("kept") + cut_lo - F.col("q0")).alias("from_rank"),
                    (F.col("kept") + cut_hi - F.col("q0")).alias("to_rank"), "shard"))
    own = rows.where("kept > 0").select("arc", F.lit(0).cast("long").alias("from_rank"),
                                        F.col("kept").alias("to_rank"), "shard")
    w = W.partitionBy("shard").orderBy("arc", "from_rank").rowsBetween(W.unboundedPreceding, -1)
    return own.unionByName(over).withColumn(
        "slot0", F.coalesce(F.sum(F.col("to_rank") - F.col("from_rank")).over(w), F.lit(0)))


def written_order(docs: DataFrame) -> DataFrame:
    """Rows read from files with ``__part``, ``__file`` and ``__row``, by which they stand in the order in which a sorted table was
    written: tasks number their files, and write their rows in order."""
    file = docs.metadataColumn("_metadata")
    part = F.regexp_extract(file["file_name"], r"^part-(\d{1,9})", 1)
    return docs.select("*", F.when(part != "", part).cast("int").alias("__part"), file["file_path"].alias("__file"),
                       file["row_index"].alias("__row"))


def shard(docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, epsilon: float = 0.0,
          cells: int = CELLS, carry: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Rows with ``size``, ``text_crc32``, ``home`` (the shard of plain hashing), ``shard`` and ``slot``, besides the
    carried columns (default doc_id). ``order`` names columns that tell all rows apart, the last a row number; slots follow
    it."""
    carry = carry or ["doc_id"]
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(carry))]
    nth = [f"n{i}" for i in range(len(order or []))]
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text-"), F.md5(text.cast("binary"))))
    rows = staged(docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(carry + (order or []), names + nth)], F.col("doc_id").alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        hex_position(key).alias("position")), "shard-rows")
    arcs = staged(ring(spark, shards, virtual_nodes), "shard-ring")  # shards * virtual_nodes + 1 rows
    highs = arcs.agg(F.array_sort(F.collect_list("hi")).alias("highs"))
    rows = rows.crossJoin(F.broadcast(highs)).withColumn("arc", arc_of(F.col("position"), F.col("highs"))).drop("highs")
    rows = rows.withColumn("cell", F.shiftright("position", 60 - (cells.bit_length() - 1)).cast("int"))
    per_cell = staged(rows.groupBy("arc", "cell").agg(F.count("*").alias("n")), "shard-cells")
    offsets = per_cell.select("arc", "cell", (F.sum("n").over(W.partitionBy("arc").orderBy("cell")) - F.col("n")).alias("before"))
    segments = placements(arcs, per_cell.groupBy("arc").agg(F.sum("n").alias("n")), shards, epsilon)
    segments = staged(segments, "shard-segments")
    within = F.row_number().over(W.partitionBy("arc", "cell").orderBy("position", "id", "crc", "size", *nth)) - 1
    ranked = (rows.withColumn("in_cell", within).join(offsets, ["arc", "cell"])
              .withColumn("rank", F.col("before") + F.col("in_cell")))
    placed = ranked.join(F.broadcast(segments.withColumnRenamed("arc", "seg_arc")),
                         (F.col("arc") == F.col("seg_arc")) & (F.col("rank") >= F.col("from_rank"))
                         & (F.col("rank") < F.col("to_rank")))
    placed = placed.withColumn("slot", (F.col("slot0") + F.col("rank") - F.col("from_rank")).cast("long"))
    if nth:
        chunk = F.struct(*nth[:-1], F.shiftright(nth[-1], CHUNK_BITS).alias("chunk"))
        placed = placed.withColumn("chunk", chunk)
        counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
        before = F.sum("n").over(W.partitionBy("shard").orderBy("chunk")) - F.col("n")
        starts = counts.select(F.col("shard").alias("at_shard"), F.col("chunk").alias("at_chunk"), before.alias("start"))
        in_chunk = F.row_number().over(W.partitionBy("shard", "chunk").orderBy(*nth)) - 1
        placed = placed.withColumn("in_chunk", in_chunk).join(
            starts, (F.col("shard") == F.col("at_shard")) & F.col("chunk").eqNullSafe(F.col("at_chunk")))
        placed = placed.withColumn("slot", (F.col("start") + F.col("in_chunk")).cast("long"))
    home = F.broadcast(arcs.select("arc", F.col("shard").alias("home")))
    return placed.join(home, "arc").select(
        *[F.col(n).alias(c) for n, c in zip(names, carry)], "size", F.col("crc").alias("text_crc32"), "home", "shard", "slot")


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
