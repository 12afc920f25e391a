"""Repeated byte strings by distributed prefix doubling.

A byte is removed if a string of ``length`` bytes that covers it also starts earlier (smaller doc_id, or the same
document and an earlier start). Positions carry ranks: two positions have the same rank at length h if the same h bytes follow
them. Spark sorts pairs of rank and rank at a growing offset; equal pairs have one rank at the greater length. A
position whose rank is unique, and one whose rank has reached ``length``, leaves the rounds.

Sorting every byte position would shuffle many times the text, so two properties of ranks thin the rounds out first:

* Round 1, sampled positions, rank at ``gram`` bytes. Every window of ``length`` bytes holds one position that its content alone
  chooses (the least hash among its ``gram``-byte strings), so equal windows have it at the same offset and
  consecutive windows mostly share it: a *run*. Where that position's rank is unique, no window of the run repeats.
* Round 2, pairs (rank of the sampled position, rank of the run's whole text). Of the runs with one pair all windows but
  the first run's repeat, whatever the copies' number; a sampled position whose runs all have one pair is done.
* Round 3, the byte positions left, in the first run of each pair: pairs of the rank at i and the rank at
  ``i + length - half``, both ``half`` bytes long, which overlap to ``length`` bytes. All but the first of a pair repeat.

Ranks up to ``half`` bytes, and of a run's text, are named by 64-bit fingerprints that a task computes from the text at
hand; a pair has 128 bits. Each task sends only its own first position of a pair into rounds 2 and 3 and marks the others
itself, so a passage in a third of all documents reaches a later task once per task, not once per copy. Which ranks are
not unique is told to the tasks by bit filters whose size follows their members up to ``filter_size`` bits; a false
"perhaps" moves some more rows and changes no result.

Defined results: null and empty texts have 0 bytes; texts shorter than ``length`` stay whole; very long texts are read
whole, one at a time. Null ids come last; rows of one id are ordered by a hash of their text; of rows equal in both, one is the first and the
others repeat it whole. An empty table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertide.llm.common import filter_bits, perhaps, staged, table
from ledgertide.llm.words import mix, slices

LENGTH = 100
GRAM = 48
FILTER_BITS = 1 << 26
SLICE = 1 << 18
HELD = 100_000  # pairs a task remembers at once to mark its own copies

_U = np.uint64
_BASE = 0xA0761D6478BD642F | 1
_BYTE = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)


def fingerprints(data: np.ndarray, size: int) -> np.ndarray:
    """Of each run of ``size`` bytes, by doubling: runs of 1, 2, 4 ... bytes, joined where ``size`` has the bit."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, power, width, done = None, _BYTE[data], 1, 0
    while done < size:
        if size & width:
            piece = power[done:done + n]
            out = piece.copy() if out is None else out * _U(pow(_BASE, width, 1 << 64)) + piece
            done += width
        if width * 2 <= size:
            power = power[:-width] * _U(pow(_BASE, width, 1 << 64)) + power[width:]
        width *= 2
    return mix(out, size)


def least_of_each(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of ``width`` neighbours from each place on, and the first place that has it."""
    place, done = np.arange(len(values), dtype=np.int32), 1
    while done < width:
        step = min(done, width - done)
        less = values[step:] < values[:-step]
        values, place = np.where(less, values[step:], values[:-step]), np.where(less, place[step:], place[:-step])
        done += step
    return values, place


class Runs:
    """Runs of windows of some texts: ``key`` (rank of the sampled position), ``first`` window, ``count`` of windows,
    ``at`` (sampled position), ``doc`` (which text) and ``begin`` (where it starts in ``data``)."""

    def __init__(self, texts: pa.Array, length: int, gram: int) -> None:
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, texts.offset * 4).astype(np.int64)
        size = int(offsets[-1] - offsets[0])
        self.data = np.frombuffer(texts.buffers()[2], np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        windows = max(0, size - length + 1)
        valid = np.ones(windows, bool)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            valid[max(a, b - length + 1):b] = False
        best, at = least_of_each(fingerprints(self.data, gram), length - gram + 1) if windows else (np.zeros(0, np.uint64), np.zeros(0, np.int32))
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
        self.first = np.flatnonzero(new)
        self.count = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], windows > 0)[:windows]) + 1 - self.first
        self.key, self.at = best[self.first], at[self.first].astype(np.int64)
        self.doc = np.searchsorted(offsets, self.first, "right") - 1
        self.begin = offsets[self.doc]
        self.length = length

    def keep(self, which: np.ndarray) -> None:
        for name in ("first", "count", "key", "at", "doc", "begin"):
            setattr(self, name, getattr(self, name)[which])

    def names(self) -> np.ndarray:
        """Fingerprints of the runs' whole texts and of where the sampled position lies in them."""
        powers = np.full(len(self.data) + 1, _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        inverse = np.full(len(self.data) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * powers[:-1], out=total[1:])
        text = (total[self.first + self.count + self.length - 1] - total[self.first]) * inverse[self.first]
        return mix(mix(text, 1) + (self.at - self.first).astype(np.uint64) * _U(1 << 20) + self.count.astype(np.uint64))


def filter_of(members: DataFrame, column: str, most: int) -> np.ndarray:
    """A bit filter with some 16 bits for each member, ``most`` bits at the most."""
    wanted = max(1, members.count()) * 16
    return filter_bits(members, column, min(most, max(1 << 16, 1 << (wanted - 1).bit_length())))


def sampled_ranks(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Round 1: ``key`` of the sampled positions whose rank is not unique."""
    def count(batches):
        for batch in batches:
            texts = batch.column("t")
            for a, b in slices(texts, SLICE):
                found, n = np.unique(Runs(texts[a:b], length, gram).key, return_counts=True)
                yield pa.RecordBatch.from_pydict({"key": found.view(np.int64), "n": n})

    counted = rows.select("t").mapInArrow(count, "key bigint, n bigint")
    return counted.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")


_POSITION = "a bigint, b bigint, id bigint, th bigint, start int, count int, first boolean"


class Firsts:
    """A task's first position of each pair; all others are marked at once. Bounded: beyond ``HELD`` pairs they are sent on."""

    def __init__(self) -> None:
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray, start: np.ndarray, count: np.ndarray, ids: pa.Array, th: pa.Array):
        none = ids.is_null().to_numpy(zero_copy_only=False)
        columns = (a, b, none[doc], ids.fill_null(0).to_numpy()[doc], th.to_numpy()[doc], start, count)
        self.waiting.append(np.stack([c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64) for c in columns]))
        self.size += len(a)
        if self.size >= 2 * HELD:
            yield from self.settle()
            if self.size > HELD:
                yield from self.flush()

    def settle(self):
        """Keeps the first of each pair and marks the rest."""
        rows = np.concatenate(self.waiting, 1)
        rows = rows[:, np.lexsort(rows[5::-1])]
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(0)
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (rows[2:6] != rows[2:6, head]).any(0)
        self.waiting = [rows[:, ~later]]
        self.size = self.waiting[0].shape[1]
        marks = rows[:, later]
        marks[0], marks[1] = mix((marks[3] ^ marks[4] ^ marks[5]).view(np.uint64)).view(np.int64), 0  # dealt out evenly, not by pair
        yield from self.batches(marks, False)

    def flush(self):
        if self.size:
            yield from self.settle()
            yield from self.batches(self.waiting[0], True)
        self.waiting, self.size = [], 0

    @staticmethod
    def batches(rows: np.ndarray, first: bool):
        for k in range(0, rows.shape[1], 20_000):
            a, b, none, id_, th, start, count = rows[:, k:k + 20_000]
            yield pa.RecordBatch.from_pydict({
                "a": a, "b": b, "id": pa.array(id_, mask=none.astype(bool)), "th": th, "start": start.astype(np.int32),
                "count": count.astype(np.int32), "first": np.full(len(a), first)})


def run_pairs(rows: DataFrame, repeated: np.ndarray, length: int, gram: int) -> DataFrame:
    """Round 2: positions of runs with the pair (rank of the sampled position, rank of the run's text)."""
    shared = rows.sparkSession.sparkContext.broadcast(repeated)

    def pairs(batches):
        firsts = Firsts()
        for batch in batches:
            texts = batch.column("t")
            for a, b in slices(texts, SLICE):
                runs = Runs(texts[a:b], length, gram)
                runs.keep(perhaps(shared.value, runs.key))
                if len(runs.key):
                    yield from firsts.add(runs.key, runs.names(), runs.doc, runs.first - runs.begin, runs.count,
                                          batch.column("id")[a:b], batch.column("th")[a:b])
        yield from firsts.flush()

    return rows.mapInArrow(pairs, _POSITION)


def byte_pairs(rows: DataFrame, several: np.ndarray, heads: np.ndarray, length: int, gram: int, half: int) -> DataFrame:
    """Round 3: the byte positions of first runs of sampled positions with several pairs, each with the pair of its ranks at
    ``half`` bytes, at i and at ``i + length - half``."""
    shared = rows.sparkSession.sparkContext.broadcast((several, heads))

    def pairs(batches):
        firsts = Firsts()
        for batch in batches:
            texts = batch.column("t")
            for x, y in slices(texts, SLICE):
                runs = Runs(texts[x:y], length, gram)
                runs.keep(perhaps(shared.value[0], runs.key))
                if not len(runs.key):
                    continue
                ids, th = batch.column("id")[x:y], batch.column("th")[x:y]
                lead = (ids.fill_null(-1).to_numpy()[runs.doc].view(np.uint64), th.to_numpy()[runs.doc].view(np.uint64))
                runs.keep(perhaps(shared.value[1], occurrence(runs.key, runs.names(), *lead, (runs.first - runs.begin).astype(np.uint64))))
                if not len(runs.key):
                    continue
                shift = np.arange(int(runs.count.sum())) - np.repeat(np.cumsum(runs.count) - runs.count, runs.count)
                i = np.repeat(runs.first, runs.count) + shift
                rank = fingerprints(runs.data, half)
                yield from firsts.add(rank[i], rank[i + length - half], np.repeat(runs.doc, runs.count), i - np.repeat(runs.begin, runs.count),
                                      np.ones(len(i), np.int32), ids, th)
        yield from firsts.flush()

    return rows.mapInArrow(pairs, _POSITION)


def occurrence(a: np.ndarray, b: np.ndarray, id_: np.ndarray, th: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One hash of a position and its pair."""
    out = a
    for k, part in enumerate((b, id_, th, start)):
        out = mix(out ^ (part * _U(0x9FB21C651E98DF25 + 2 * k)), k + 1)
    return out


def reranked(positions: DataFrame) -> DataFrame:
    """Positions sorted by pair: ``first`` stays only with the first position of each pair in the order of documents."""
    order = W.partitionBy("a", "b").orderBy(F.col("id").isNull(), "id", "th", "start")
    return positions.withColumn("first", F.col("first") & (F.rank().over(order) == 1))


def repeated_spans(rows: DataFrame, length: int, gram: int, half: int, filter_size: int) -> DataFrame:
    """``id, th, starts``: of each document (start, count) of the windows that repeat an earlier one."""
    keys = staged(sampled_ranks(rows, length, gram), "rank-sampled")
    repeated = filter_of(keys, "key", filter_size)
    runs = staged(reranked(run_pairs(rows, repeated, length, gram)), "rank-runs")
    heads = runs.where("first").groupBy("a").agg(F.count("*").alias("n"))
    several = staged(heads.where("n > 1").select("a"), "rank-several")
    many = filter_of(several, "a", filter_size)
    shared = rows.sparkSession.sparkContext.broadcast(many)

    def hashes(batches):
        for batch in batches:
            key = batch.column("a").to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(perhaps(shared.value, key)))
            got = [batch.column(c) for c in ("a", "b", "id", "th", "start")]
            got = [c.fill_null(-1).to_numpy().astype(np.int64).view(np.uint64) for c in got]
            yield pa.RecordBatch.from_pydict({"h": occurrence(*got).view(np.int64)})

    heads = staged(runs.where("first").select("a", "b", "id", "th", "start").mapInArrow(hashes, "h bigint"), "rank-heads")
    left = byte_pairs(rows, many, filter_of(heads, "h", filter_size), length, gram, half)
    marks = runs.where("NOT first").unionByName(reranked(left).where("NOT first"))
    return marks.groupBy("id", "th").agg(F.collect_set(F.struct("start", "count")).alias("starts"))


def cut_text(text: bytes, starts: list[tuple[int, int]], length: int) -> tuple[bytes, int]:
    """The bytes no repeated window covers, and the number of maximal runs removed."""
    change = np.zeros(len(text) + 1, np.int32)
    spans = np.array(starts, np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 0] + spans[:, 1] - 1 + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, filter_size: int = FILTER_BITS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (remaining bytes) of every document."""
    if not 0 < gram <= length:
        raise ValueError("a sampled position's rank must fit into the length")
    half = max(gram, (length * 16 + 24) // 25)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("t"))
    spans = staged(repeated_spans(rows, length, gram, half, filter_size), "rank-spans")
    pair = F.xxhash64("id", "th")
    context = docs.sparkSession.sparkContext
    equal = staged(rows.groupBy("id", "th").agg(F.count("*").alias("n")).where("n > 1").select(pair.alias("h")), "rank-equal")
    equal_bits = context.broadcast(filter_of(equal, "h", filter_size))
    touched_bits = context.broadcast(filter_of(spans.select(pair.alias("h")), "h", filter_size))

    @F.pandas_udf("boolean")
    def may_be_equal(h: pd.Series) -> pd.Series:
        return pd.Series(perhaps(equal_bits.value, h.to_numpy().view(np.uint64)))

    @F.pandas_udf("boolean")
    def may_be_touched(h: pd.Series) -> pd.Series:
        return pd.Series(perhaps(touched_bits.value, h.to_numpy().view(np.uint64)))

    # Equal rows give equal results: one of them is cut, and their number says how often the others come back.
    known = rows.withColumn("_equal", may_be_equal(pair)).withColumn("_touched", may_be_touched(pair))
    single = known.where("NOT _equal").withColumn("n", F.lit(1).cast("long"))
    grouped = known.where("_equal").groupBy("id", "th", "_touched").agg(F.first("t").alias("t"), F.count("*").alias("n"))
    every = single.select("id", "th", "_touched", "t", "n").unionByName(grouped.select("id", "th", "_touched", "t", "n"))
    none = F.lit(None).cast(spans.schema["starts"].dataType)
    straight = every.where("NOT _touched").select("id", "t", "n", none.alias("starts"))
    met = every.where("_touched").join(spans.select(F.col("id").alias("sid"), F.col("th").alias("sth"), "starts"),
                                       F.col("id").eqNullSafe(F.col("sid")) & (F.col("th") == F.col("sth")), "left")

    def cut(batches):
        for batch in batches:
            out = []
            for id_, text, n, starts in zip(batch.column("id").to_pylist(), batch.column("t"), batch.column("n").to_pylist(), batch.column("starts")):
                whole = text.as_py().encode()
                kept, runs = whole, 0
                if starts.is_valid:
                    pairs = starts.values
                    kept, runs = cut_text(whole, np.stack([pairs.field("start").to_numpy(), pairs.field("count").to_numpy()], 1), length)
                out.append((id_, len(whole), len(whole) - len(kept), runs, kept))
                again = (id_, len(whole), len(whole), 1, b"") if len(whole) >= length else (id_, len(whole), 0, 0, whole)
                out.extend([again] * (n - 1))
                if len(out) >= 1000:
                    yield result(out)
                    out = []
            yield result(out)

    def result(out):
        columns = list(zip(*out)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                                           pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.binary())],
                                          names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return straight.unionByName(met.select("id", "t", "n", "starts")).mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op13_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = """
WITH doc AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
piece AS (
    SELECT rid, unnest(range(0, len(h) // 2, 250)) AS base, len(h) // 2 AS n,
           unnest(list_transform(range(0, len(h) // 2, 250), lambda b: substr(h, 2 * b + 1, 698))) AS s FROM doc),
byte AS (
    SELECT rid, base + unnest(range(1, least(250, n - base) + 1)) AS i,
           unnest(list_transform(range(1, least(250, n - base) + 1), lambda i: substr(s, 2 * i - 1, 2))) AS x,
           unnest(list_transform(range(1, least(250, n - base) + 1),
                                 lambda i: CASE WHEN base + i + 99 <= n THEN md5(substr(s, 2 * i - 1, 200)) END)) AS p
    FROM piece),
rep AS (SELECT rid, i FROM (
    SELECT rid, i, row_number() OVER (PARTITION BY p ORDER BY rid, i) AS k FROM byte WHERE p IS NOT NULL) WHERE k > 1),
mark AS (
    SELECT b.rid, b.i, x, max(r.i) OVER (PARTITION BY b.rid ORDER BY b.i ROWS 99 PRECEDING) IS NOT NULL AS gone
    FROM byte b LEFT JOIN rep r ON b.rid = r.rid AND b.i = r.i),
step AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), false) AS opens FROM mark),
agg AS (
    SELECT rid, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
           coalesce(string_agg(x, '' ORDER BY i) FILTER (NOT gone), '') AS kept FROM step GROUP BY rid)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM doc LEFT JOIN agg USING (rid)
"""
