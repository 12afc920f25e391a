"""Repeated passages by prefix-partitioned suffix trees over words.

A passage of ``window`` words that also starts earlier (smaller doc_id, or earlier in the same document) is
removed. Suffixes of all documents are dealt into groups by a prefix, and a task builds the tree of each group top down to
depth ``window``: a node is split by the next words of its suffixes, suffixes alone in a node are dropped. Internal nodes at
that depth are the repeated windows; of a node's leaves the first stays, all others are marked. Runs of marked
windows are the maximal repeats.

* Anchors. The prefix that places a window is the smallest (by hash) of its ``gram``-word runs. Equal windows
  have the same anchor at the same offset, and neighbouring windows mostly share one, so text moves once per anchor and
  not once per window. A first pass counts anchors over all documents; where an anchor occurs once, no window around it
  can repeat, so its suffixes are leaves above the depth asked for and never leave their task.
* Variable-length prefixes. Anchors that occur more than ``group_limit`` times would make a group too large for memory: their
  windows are placed by the whole window, the longest prefix there is. Each task first combines its own
  occurrences, so that a passage of a third of all documents reaches the next stage once per task.

Which anchors repeat, and which are frequent, is told to the tasks by bit filters of fixed size: a false "perhaps" moves
a little more text and changes no result. Words and windows are compared by 64-bit hashes. Texts go to Python in small batches,
and touched documents are cut and written there; all others are only spaced by expressions.

Defined results: a null or empty text has no words. Null ids come last; rows with equal ids are ordered by a hash of
their text; of rows equal in both, one is the first and the others repeat it whole. Documents shorter
than a window are never touched. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertide.llm.common import (FILTER_BITS, SPACE_CLASS, filter_bits, perhaps, recorded, release, small_batches, staged, table,
                                   text_hash)
from ledgertide.llm.words import Words, grams, mix, slices, words

WINDOW = 20
GRAM = 8
GROUP_LIMIT = 4_000
TREE_ROWS = 4_000
EDGE = 4


def anchor_runs(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor hash, first window, number of windows, anchor position."""
    n = len(w.hashes)
    if n < window:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    g = grams(w.hashes, gram)
    count = n - window + 1
    best, at = g[:count].copy(), np.arange(count)
    for j in range(1, window - gram + 1):
        less = g[j:j + count] < best
        np.copyto(best, g[j:j + count], where=less)
        at[less] = np.flatnonzero(less) + j
    last_word = np.repeat(w.first[1:], np.diff(w.first))[:count]  # end of each window's document
    valid = np.arange(count) + window <= last_word
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    ends = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
    return best[first], first, ends - first, at[first]


def count_anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``anchor, n`` of the anchors that occur twice or more."""
    def count(batches):
        for batch in batches:
            texts = batch.column("t")
            for a, b in slices(texts):
                found, n = np.unique(anchor_runs(words(texts[a:b], False), window, gram)[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"anchor": found.view(np.int64), "n": n})

    counted = docs.select("t").mapInArrow(count, "anchor bigint, n bigint")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")


_SUFFIX = {"kind": pa.int8(), "key": pa.int64(), "id": pa.int64(), "th": pa.int64(), "start": pa.int32(), "count": pa.int32(),
           "at": pa.int32(), "body": pa.binary()}
_SUFFIX_DDL = "kind tinyint, key bigint, id bigint, th bigint, start int, count int, at int, body binary"
COLD, HOT, MARK = 0, 1, 2


def suffixes(docs: DataFrame, repeated: np.ndarray, hot: np.ndarray, window: int, gram: int) -> DataFrame:
    """What the trees need: text around repeated anchors, first occurrences per task of windows around frequent
    ones, and marks for the latter's other occurrences."""
    context = docs.sparkSession.sparkContext
    filters = context.broadcast((repeated, hot))

    def batch_of(**columns):
        n = len(columns["key"])
        return pa.RecordBatch.from_arrays([columns[k] if isinstance(columns.get(k), pa.Array) else pa.array(columns[k], t) if k in columns
                                           else pa.nulls(n, t) for k, t in _SUFFIX.items()], names=list(_SUFFIX))

    def deal(batches):
        maybe, frequent = filters.value
        firsts: dict[int, tuple] = {}
        for batch in batches:
            texts = batch.column("t")
            for a, b in slices(texts):
                w = words(texts[a:b], False)
                anchors, first, count, at = anchor_runs(w, window, gram)
                keep = perhaps(maybe, anchors)
                anchors, first, count, at = anchors[keep], first[keep], count[keep], at[keep]
                if not len(first):
                    continue
                doc = np.searchsorted(w.first, first, "right") - 1
                ids, th = batch.column("id").slice(a, b - a), batch.column("th").slice(a, b - a)
                begin = w.first[doc]
                much = perhaps(frequent, anchors)
                some = np.flatnonzero(~much)
                data = w.data.tobytes()
                bodies = [data[i:j] for i, j in zip(w.starts[first[some]].tolist(), w.ends[first[some] + count[some] + window - 2].tolist())]
                yield batch_of(kind=np.full(len(some), COLD, np.int8), key=anchors[some].view(np.int64), id=ids.take(pa.array(doc[some])),
                               th=th.take(pa.array(doc[some])), start=first[some] - begin[some], count=count[some],
                               at=at[some] - first[some], body=bodies)
                if not much.any():
                    continue
                whole = grams(w.hashes, window)
                id_list, th_list = ids.to_pylist(), th.to_pylist()
                marks = []
                for f, c, d in zip(first[much].tolist(), count[much].tolist(), doc[much].tolist()):
                    lead = (id_list[d] is None, id_list[d] or 0, th_list[d])
                    base = int(w.first[d])
                    for i in range(f, f + c):
                        key, mine = int(whole[i]), (*lead, i - base)
                        best = firsts.setdefault(key, mine)
                        if mine != best:
                            if mine < best:
                                firsts[key], best, mine = mine, mine, best
                            marks.append(mine)
                if marks:
                    yield batch_of(kind=np.full(len(marks), MARK, np.int8), key=[m[2] ^ m[3] for m in marks], id=[None if m[0] else m[1] for m in marks],
                                   th=[m[2] for m in marks], start=[m[3] for m in marks], count=[window] * len(marks))
        items = list(firsts.items())
        for k in range(0, len(items), 50_000):
            part = items[k:k + 50_000]
            yield batch_of(kind=np.full(len(part), HOT, np.int8), key=np.array([x for x, _ in part], np.uint64).view(np.int64),
                           id=[None if m[0] else m[1] for _, m in part], th=[m[2] for _, m in part], start=[m[3] for _, m in part],
                           count=[1] * len(part))

    return docs.mapInArrow(deal, _SUFFIX_DDL)


def deep_nodes(group: np.ndarray, symbols: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The tree of each group, built top down to depth ``window``. ``at`` points to each suffix's first word in
    ``symbols``. Returns the suffixes below internal nodes of that depth, and their nodes."""
    alive, node = np.arange(len(at)), group
    for depth in range(0, window, EDGE):
        width = min(EDGE, window - depth)
        label = grams(symbols, width)[at[alive] + depth]
        order = np.lexsort((label, node))
        alive, node, label = alive[order], node[order], label[order]
        new = np.ones(len(alive), bool)
        new[1:] = (node[1:] != node[:-1]) | (label[1:] != label[:-1])
        node = np.cumsum(new)
        several = np.bincount(node)[node] > 1
        alive, node = alive[several], node[several]
    return alive, node


def marks_of_trees(rows: pa.Table, window: int) -> pa.RecordBatch | None:
    """Marks (id, th, from, to) of whole groups of cold suffixes."""
    body = rows.column("body").combine_chunks()
    body = body.chunk(0) if isinstance(body, pa.ChunkedArray) else body
    w = words(body.cast(pa.string()) if body.type != pa.string() else body, False)
    count, start = rows.column("count").to_numpy(), rows.column("start").to_numpy()
    record = np.repeat(np.arange(len(count)), count)
    shift = np.arange(len(record)) - np.repeat(np.cumsum(count) - count, count)
    key, offset = rows.column("key").to_numpy()[record], rows.column("at").to_numpy()[record] - shift
    order = np.lexsort((offset, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (offset[order][1:] != offset[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    leaf, node = deep_nodes(group, w.hashes, w.first[record] + shift, window)
    return later_occurrences(rows, record[leaf], start[record[leaf]] + shift[leaf], node, window)


def later_occurrences(rows: pa.Table, record: np.ndarray, start: np.ndarray, node: np.ndarray, window: int) -> pa.RecordBatch | None:
    """Of each node's leaves all but the first, as runs of consecutive windows."""
    if not len(record):
        return None
    ids = rows.column("id")
    none = ids.is_null().to_numpy()[record]
    doc, th = ids.fill_null(0).to_numpy()[record], rows.column("th").to_numpy()[record]
    order = np.lexsort((start, th, doc, none, node))
    record, start, node, none, doc, th = (x[order] for x in (record, start, node, none, doc, th))
    new = np.ones(len(node), bool)
    new[1:] = node[1:] != node[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (start != start[head]) | (th != th[head]) | (doc != doc[head]) | (none != none[head])
    record, start = record[later], start[later]
    if not len(record):
        return None
    order = np.lexsort((start, record))
    record, start = record[order], start[order]
    new = np.ones(len(record), bool)
    new[1:] = (record[1:] != record[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(record)) - 1
    which = pa.array(record[first])
    return pa.RecordBatch.from_arrays(
        [ids.take(which).combine_chunks(), rows.column("th").take(which).combine_chunks(), pa.array(start[first].astype(np.int32)),
         pa.array((start[last] + window).astype(np.int32))], names=["id", "th", "from", "to"])


def grow_trees(dealt: DataFrame, window: int) -> DataFrame:
    """Marks ``id, th, from, to`` (words [from, to) repeat earlier ones) from suffixes dealt out by key."""
    def grow(batches):
        waiting: list[pa.RecordBatch] = []
        size = 0

        def marks(rows: pa.Table):
            kind = rows.column("kind").to_numpy()
            direct = rows.filter(pa.array(kind == MARK))
            if len(direct):
                start = direct.column("start").to_numpy()
                yield from pa.table([direct.column("id"), direct.column("th"), pa.array(start), pa.array(start + np.int32(window))],
                                    names=["id", "th", "from", "to"]).to_batches()
            cold = rows.filter(pa.array(kind == COLD))
            if len(cold):
                yield marks_of_trees(cold, window)
            firsts = rows.filter(pa.array(kind == HOT))
            if len(firsts):
                every = np.arange(len(firsts))
                yield later_occurrences(firsts, every, firsts.column("start").to_numpy(), firsts.column("key").to_numpy(), window)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, kind = batch.column("key").to_numpy(), batch.column("kind").to_numpy()
            # Whole groups only: what has the key of the batch's last row may go on in the next batch.
            tail = np.flatnonzero((key != key[-1]) | (kind != kind[-1]))
            cut = int(tail[-1]) + 1 if len(tail) else 0
            same = waiting and not cut and waiting[-1].column("key")[-1].as_py() == key[0]
            waiting.append(batch.slice(0, cut)) if cut else None
            size += cut
            if size >= TREE_ROWS and not same:
                yield from (m for m in marks(pa.Table.from_batches(waiting)) if m is not None)
                waiting, size = [], 0
            waiting.append(batch.slice(cut))
            size += batch.num_rows - cut
        if waiting:
            yield from (m for m in marks(pa.Table.from_batches(waiting)) if m is not None)

    parts = dealt.repartition("key").sortWithinPartitions("kind", "key")
    return parts.mapInArrow(grow, "id bigint, th bigint, from int, to int")


def cut_out(batches, window: int):
    """Rows of ``remove_repeats`` from ``id, t, spans, copy``."""
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans_, copy in zip(batch.column("t"), batch.column("spans").to_pylist(), batch.column("copy").to_pylist()):
            parts = (text.as_py() or "").encode().split()
            n = len(parts)
            if copy > 1 and n >= window:
                parts = []
            elif spans_:
                stay = np.ones(n, bool)
                for span in spans_:
                    stay[span["from"]:span["to"]] = False
                parts = [parts[i] for i in np.flatnonzero(stay)]
            n_words.append(n)
            n_removed.append(n - len(parts))
            kept.append(b" ".join(parts))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                          pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_limit: int = GROUP_LIMIT,
                   filter_size: int = FILTER_BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` (kept words joined by one space) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_hash(F.col("text")).alias("th"), F.col("text").alias("t"))
    pair = F.xxhash64("id", "th")
    with small_batches(docs.sparkSession):
        with recorded() as folders:
            anchors = staged(count_anchors(rows, window, gram), "repeat-anchors")
            repeated = filter_bits(anchors, "anchor", filter_size)
            hot = filter_bits(anchors.where(F.col("n") > group_limit), "anchor", filter_size >> 5)
            marks = grow_trees(suffixes(rows, repeated, hot, window, gram), window)
            spans = staged(marks.groupBy("id", "th").agg(F.collect_set(F.struct("from", "to")).alias("spans")), "repeat-spans")
            copies = staged(rows.select("id", "th").groupBy("id", "th").agg(F.count("*").alias("n")).where("n > 1").select("id", "th"), "repeat-rows")
            # Documents that surely have no mark and no copy under the same id go straight through.
            touched = filter_bits(spans.select(pair.alias("h")).unionByName(copies.select(pair.alias("h"))), "h", filter_size)
        shared = docs.sparkSession.sparkContext.broadcast(touched)

        @F.arrow_udf("boolean")
        def may_be_touched(h: pa.Array) -> pa.Array:
            return pa.array(perhaps(shared.value, h.to_numpy().view(np.uint64)))

        flagged = may_be_touched(pair)
        met = rows.where(flagged).join(spans.select(F.col("id").alias("sid"), F.col("th").alias("sth"), "spans"),
                                       F.col("id").eqNullSafe(F.col("sid")) & (F.col("th") == F.col("sth")), "left")
        met = met.withColumn("copy", F.row_number().over(W.partitionBy("id", "th").orderBy(F.lit(1)))).select("id", "t", "spans", "copy")
        met = staged(met.mapInArrow(lambda batches: cut_out(batches, window), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"),
                     "repeat-touched")
    release(docs.sparkSession, folders)
    kept = F.trim(F.regexp_replace(F.coalesce("t", F.lit("")), SPACE_CLASS, " "))
    straight = rows.where(~flagged).select(F.col("id").alias("doc_id"), kept.alias("kept_text"))
    spaces = F.length("kept_text") - F.length(F.replace("kept_text", F.lit(" "), F.lit("")))
    n_words = F.when(F.col("kept_text") == "", 0).otherwise(spaces + 1).cast("long")
    return straight.select("doc_id", n_words.alias("n_words"), F.lit(0).cast("long").alias("n_removed"), "kept_text").unionByName(met)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = """
WITH doc AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS rid, doc_id,
           coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
win AS (
    SELECT rid, unnest(range(1, len(w) - 18)) AS i,
           unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(list_slice(w, i, i + 19), ' '))) AS p
    FROM doc WHERE len(w) >= 20),
rep AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY p ORDER BY rid, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS j FROM rep),
word AS (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM doc),
kept AS (SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (rid, j) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (rid)
"""
