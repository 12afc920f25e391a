"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark's windows: each run of ``window`` consecutive words of an item, or the
whole item where it has fewer words. Patterns of one length share a search table. Scanning a document,
the table looks at a block of the last two words under the window; the shift table tells how far the
window may move on without passing an occurrence; where the shift is 0, the block's bucket names the
patterns that end so, and these are compared word by word.

The benchmark is cut into blocks of at most ``block_bytes`` of text, whatever its size. One block's tables
are small enough to send to every task; documents stay where they are and nothing of them is shuffled
while there is one block. With more blocks the documents are searched once per block and the
hits of a document are merged.

Defined results: a null or empty text has no words and no hits. A null or empty item has no windows. A null
item_id counts as the empty string in the id list. Repeated items or ids count once per id. Rows repeated
in the documents are reported once each. Empty tables give empty results, or rows without hits. Extra
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import arrow_batches, table

WINDOW = 13
BLOCK_BYTES = 8 << 20

_KEEP = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def item_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.encode().translate(_KEEP).split() if text else []


class SearchTable:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.block = min(2, length)
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        self.known: dict[tuple, set[str]] = {}

    def add(self, pattern: tuple[bytes, ...], item: str) -> None:
        if pattern in self.known:
            self.known[pattern].add(item)
            return
        self.known[pattern] = {item}
        for end in range(self.block, self.length + 1):
            key = pattern[end - 2:end] if self.block == 2 else pattern[end - 1]
            self.shift[key] = min(self.shift.get(key, self.length), self.length - end)
        last = pattern[-2:] if self.block == 2 else pattern[-1]
        self.buckets[last].append(pattern)

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of each occurrence, by start."""
        n, at, pair = len(words), self.length, self.block == 2
        most, shift = self.length - self.block + 1, self.shift.get
        while at <= n:
            key = (words[at - 2], words[at - 1]) if pair else words[at - 1]
            step = shift(key, most)
            if step:
                at += step
                continue
            start = at - self.length
            head = words[start]
            for pattern in self.buckets[key]:
                if pattern[0] == head and tuple(words[start:at]) == pattern:
                    yield start, self.known[pattern]
            at += 1


def search_tables(items: list[tuple[str, str | None]], window: int) -> list[SearchTable]:
    tables: dict[int, SearchTable] = {}
    for item, text in items:
        words = item_words(text)
        length = min(window, len(words))
        for i in range(len(words) - length + 1 if words else 0):
            tables.setdefault(length, SearchTable(length)).add(tuple(words[i:i + length]), item)
    return list(tables.values())


def hits(words: list[bytes], tables: list[SearchTable]) -> tuple[list[int], list[str]]:
    """Hit words as a flat list of [from, to) bounds, and the items that occur."""
    spans, items = [], set()
    for search in tables:
        for start, found in search.occurrences(words):
            spans.append((start, start + search.length))
            items |= found
    bounds: list[int] = []
    for start, end in sorted(spans):
        if bounds and start <= bounds[-1]:
            bounds[-1] = max(bounds[-1], end)
        else:
            bounds += [start, end]
    return bounds, sorted(items)


def benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark's items in blocks of at most ``block_bytes`` (one item at least), read as a stream."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").alias("t"))
    block, size = [], 0
    for row in rows.toLocalIterator(prefetchPartitions=True):
        have = len(row.t or "") * 4
        if block and size + have > block_bytes * 4:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += have
    if block:
        yield block


_FOUND = {"bounds": pa.list_(pa.int32()), "items": pa.list_(pa.string())}


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> DataFrame:
    """Per document: the carried columns (default doc_id), ``n_words``, ``hit_spans`` (bounds of the hit words,
    [from, to) pairs in one flat list) and ``item_ids`` (sorted). The text must be in column ``text``."""
    carry = carry or ["doc_id"]
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)], F.col("text").alias("t"))
    blocks = list(benchmark_blocks(benchmark, block_bytes))
    if len(blocks) > 1:  # a key to merge by: the rows are told apart before they are searched
        rows = rows.withColumn("key", F.monotonically_increasing_id())
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name != "t"}
    ddl = ", ".join(f"{n} {t}" for n, t in types.items()) + ", n_words bigint, bounds array<int>, items array<string>"

    def searched(block: list[tuple[str, str | None]]) -> DataFrame:
        items = spark.sparkContext.broadcast(block)

        def search(batches):
            tables = search_tables(items.value, window)
            for batch in batches:
                kept = batch.drop_columns(["t"]) if hasattr(batch, "drop_columns") else batch.select(names)
                counts, bounds, found = [], [], []
                for text in batch.column("t"):
                    words = item_words(text.as_py())
                    spans, ids = hits(words, tables)
                    counts.append(len(words))
                    bounds.append(spans)
                    found.append(ids)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(counts, pa.int64()), pa.array(bounds, _FOUND["bounds"]),
                     pa.array(found, _FOUND["items"])],
                    names=[*kept.schema.names, "n_words", "bounds", "items"])

        return rows.mapInArrow(search, ddl)

    out = searched(blocks[0] if blocks else [])
    for block in blocks[1:]:
        out = out.unionByName(searched(block))
    if len(blocks) > 1:
        first = [F.first(n).alias(n) for n in [*names, "n_words"]]
        out = (out.groupBy("key").agg(*first, F.flatten(F.collect_list("bounds")).alias("bounds"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
               .withColumn("bounds", merged_bounds(F.col("bounds"))))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], "n_words",
                      F.col("bounds").alias("hit_spans"), F.col("items").alias("item_ids"))


def merged_bounds(bounds: Column) -> Column:
    """A flat list of [from, to) pairs from several blocks as disjoint pairs in order."""
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), F.floor(F.size(bounds) / 2).cast("int") - 1),
                                     lambda i: F.array(F.get(bounds, i * 2), F.get(bounds, i * 2 + 1))))
    empty = F.array().cast("array<int>")
    joined = F.aggregate(
        pairs, empty,
        lambda acc, p: F.when((F.size(acc) > 0) & (F.get(p, F.lit(0)) <= F.element_at(acc, -1)),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.greatest(F.element_at(acc, -1), F.get(p, F.lit(1))))))
        .otherwise(F.concat(acc, p)))
    return F.when(F.size(bounds) == 0, empty).otherwise(joined)


def hit_words(spans: Column) -> Column:
    """Number of words within ``hit_spans``."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long"))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least a twentieth of the words is hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    found = found.withColumn("n_hit", hit_words(F.col("hit_spans")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: the documents that are not contaminated, with all their columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # one column, so that no name can clash
    found = find_contamination(docs.select(whole.alias("_doc"), "text"), benchmark, carry=["_doc"])
    return found.where(~is_contaminated(F.col("n_words"), hit_words(F.col("hit_spans")))).select("_doc.*")


OP10_SQL = """
WITH item AS (
    SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL),
pattern AS (
    SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2),
                                                      lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS p
    FROM (SELECT *, least(13, len(w)) AS k FROM item) WHERE k > 0),
doc AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents),
lengths AS (SELECT DISTINCT k FROM pattern),
win AS (
    SELECT rid, k, unnest(range(1, len(w) - k + 2)) AS i,
           unnest(list_transform(range(1, len(w) - k + 2),
                                 lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS p
    FROM doc, lengths WHERE len(w) >= k),
occurs AS (SELECT win.rid, win.i, win.k, pattern.item_id FROM win JOIN pattern USING (k, p)),
hit AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest(range(i, i + k)) AS j FROM occurs) GROUP BY rid),
items AS (SELECT rid, list_sort(list(DISTINCT item_id)) AS ids FROM occurs GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""
