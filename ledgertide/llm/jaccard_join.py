"""N-gram Jaccard self-join by filtering under several global token orders.

A document's set holds the distinct shingles of its words. If two sets have a Jaccard similarity of ``percent``, then
under any total order of all shingles the first ``n - ceil(percent * n) + 1`` shingles of both (their prefixes) share
one. So a pair is a candidate only if its prefixes meet under every one of several orders:

* the first order puts frequent shingles last, so that a passage that many documents share hardly ever stands in
  a prefix; its prefixes are dealt out by shingle, and rows that meet there are pairs;
* the prefixes under two further orders (hashes) are carried by the documents and intersected for each pair before
  anything is verified;
* what passes all orders is verified on the shingles of the whole texts.

Groups of copies. Equal sets are one set from the start, named by a 64-bit hash of its shingles, and each task
passes a set on once. Where sets meet under a shingle, each is first paired with the smallest one only; linked sets
become components. In a second round each set is paired with several others of its shingles, chosen by hash, that lie in other
components. In the last round all pairs across components are made, each with a side outside the shingle's largest component.
Both rounds leave out pairs whose sketches (parities of fixed size) differ in more bits than the similarity
lets the sets differ in members; that bound is exact, so that a group of near copies costs about its size and not its square, and no link between components is lost.

The first pass stores each set's name beside its text; the later ones pick the sets they need by name before they take words from any text.

Shingles under which exactly the same sets meet give the same pairs, so one of them is kept before any round.

Frequent shingles are counted over all documents (twice the prefix length of each), by slots of their hashes in a table of fixed size
per task, so that counting shuffles these tables and no shingles. Any choice of slots gives a valid order, so shingles that share a slot change
no result.

Each round's tables are deleted once its links are written.

Defined results: null or empty texts, and texts without words, have an empty set and link with nothing. Texts with fewer words than
a shingle have their whole word sequence as one. Null ids are never the smallest id of a component that has another.
Repeated rows are linked and reported each. An empty table gives an empty result. Extra columns are ignored, or kept
where whole documents are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertide.llm.common import (CLEAN_UP, FILTER_BITS, filter_bits, perhaps, recorded, release, set_for, settled, small_batches,
                                   staged, table, text_hash)
from ledgertide.llm.words import grams, mix, slices, words

SHINGLE = 3
PERCENT = 90
FREQUENT = 64
ORDERS = 3
CENTRES = 16
COUNT_SLOTS = 1 << 21
COUNT_BLOCK = 1 << 14
SKETCH = 12  # words of 64 bits: fewer tell long sets that are nearly similar enough from those that are no longer


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hashes grouped by text, and the bounds of each text's group."""
    w = words(texts, True)
    n = np.diff(w.first)
    text = w.text_of()
    g = grams(w.hashes, k)
    position = np.arange(len(g))
    inside = position + k <= w.first[1:][text[:len(g)]] if len(g) else np.zeros(0, bool)
    h, t = g[inside], text[:len(g)][inside]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.array([grams(w.hashes[w.first[i]:w.first[i + 1]], int(n[i]))[0] for i in short], np.uint64)
        h, t = np.concatenate([h, whole]), np.concatenate([t, short])
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    h, t = h[new], t[new]
    return h, np.searchsorted(t, np.arange(len(texts) + 1))


def set_names(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set that doesn't depend on the order of its members."""
    def total(x: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x, out=sums[1:])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    return mix(total(mix(h, 11)) ^ mix(total(mix(h, 12)), 13) + np.diff(bounds).astype(np.uint64), 14)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def prefixes(h: np.ndarray, bounds: np.ndarray, length: np.ndarray, seed: int, late: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The first ``length`` shingles of each set under an order: by ``late``, then by hash. Returns shingles and their set."""
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    key = mix(h, seed)
    order = np.lexsort((key, late, owner)) if late is not None else np.lexsort((key, owner))
    rank = np.arange(len(h)) - np.repeat(bounds[:-1], n)
    keep = rank < np.repeat(length, n)
    return h[order][keep], owner[keep]


def sketches(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each set the parity of its members per bit. Two sketches differ in at most as many bits as the sets in members."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    slot = (mix(h, 15) % np.uint64(64 * SKETCH)).astype(np.int64)
    out = np.zeros((len(bounds) - 1, SKETCH), np.uint64)
    np.bitwise_xor.at(out, (owner, slot >> 6), np.uint64(1) << (slot & 63).astype(np.uint64))
    return out


def can_link(n: np.ndarray, percent: int) -> np.ndarray:
    """Whether a set of n can be similar to a different set at all: at best one lacks a single member of the other."""
    return 100 * n >= percent * (n + 1)


def _fresh(names: np.ndarray, seen: set[int]) -> np.ndarray:
    """Mask of the sets this task hasn't passed on yet."""
    out = np.zeros(len(names), bool)
    for i, name in enumerate(names.tolist()):
        if name not in seen:
            seen.add(name)
            out[i] = True
    return out


def named_sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``id, th, n, s, t`` of every row: its set's size and name; the text only where a task meets a set that can link
    for the first time, so that later passes read no copies. ``docs`` has ``id, th, t``."""
    def read(batches):
        seen: set[int] = set()
        for batch in batches:
            for a, b in slices(batch.column("t")):
                texts = batch.column("t")[a:b]
                h, bounds = shingle_sets(texts, k)
                n, names = np.diff(bounds), set_names(h, bounds)
                keep = can_link(n, percent)
                keep[keep] = _fresh(names[keep], seen)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("th").slice(a, b - a), pa.array(n), pa.array(names.view(np.int64)),
                     texts.take(pa.array(np.arange(len(n)), mask=~keep))], names=["id", "th", "n", "s", "t"])

    return docs.mapInArrow(read, "id bigint, th bigint, n bigint, s bigint, t string")


def texts_once(batches, wanted: np.ndarray | None = None):
    """Names and texts, in slices, of the sets that this task meets for the first time; of those perhaps ``wanted`` if it is given."""
    seen: set[int] = set()
    for batch in batches:
        names = batch.column("s").to_numpy().view(np.uint64)
        keep = np.ones(len(names), bool) if wanted is None else perhaps(wanted, names)
        keep[keep] = _fresh(names[keep], seen)
        names, texts = names[keep], batch.column("t").filter(pa.array(keep))
        for a, b in slices(texts):
            yield names[a:b], texts[a:b]


def frequent_shingles(sets: DataFrame, k: int, percent: int, slots: int = COUNT_SLOTS) -> np.ndarray:
    """By slot of a shingle's hash, whether its shingles are most often near the front under the plain hash order. Each task counts in
    a table of fixed size; the tables are summed block by block, and one byte per slot reaches the driver."""
    block = min(COUNT_BLOCK, slots)

    def count(batches):
        counts = np.zeros(slots, np.uint32)
        for _, texts in texts_once(batches):
            h, bounds = shingle_sets(texts, k)
            front, _ = prefixes(h, bounds, 2 * prefix_length(np.diff(bounds), percent), 1, None)
            found, c = np.unique((front & np.uint64(slots - 1)).astype(np.int64), return_counts=True)
            counts[found] += c.astype(np.uint32)
        blocks = np.minimum(counts, 255).astype(np.uint8).reshape(-1, block)  # more in one task tells no more
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([blocks[i].tobytes() for i in used], pa.binary())],
                                         names=["block", "counts"])

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                sums.setdefault(i, np.zeros(block, np.uint64))
                sums[i] += np.frombuffer(counts.as_buffer(), np.uint8)
        # Quarters of powers of two are fine enough to choose by.
        levels = [(4 * np.log2(np.maximum(c, 1))).astype(np.uint8).tobytes() for c in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["block", "counts"])

    ddl = "block int, counts binary"
    summed = sets.select("s", "t").mapInArrow(count, ddl).repartition("block").mapInArrow(total, ddl)
    level = np.zeros((slots // block, block), np.uint8)
    with set_for(sets.sparkSession, CLEAN_UP, "true"):
        for row in summed.toArrow().to_pylist():
            level[row["block"]] = np.frombuffer(row["counts"], np.uint8)
    level = level.ravel()
    above = np.cumsum(np.bincount(level, minlength=256)[::-1])[::-1]  # slots at a level or higher
    least = int(np.argmax(above <= slots // 16))  # no more than the slots tell apart well
    return level >= max(least, int(4 * np.log2(FREQUENT)))


def meeting_rows(sets: DataFrame, late: np.ndarray, k: int, percent: int) -> DataFrame:
    """Where two or more sets meet in a prefix of the first order: ``token, s, n`` with the smallest set's ``ls, ln``."""
    shared = sets.sparkSession.sparkContext.broadcast(late)

    def deal(batches):
        late = shared.value
        for names, texts in texts_once(batches):
            h, bounds = shingle_sets(texts, k)
            n = np.diff(bounds)
            token, owner = prefixes(h, bounds, prefix_length(n, percent), 1, late[(h & np.uint64(len(late) - 1)).astype(np.int64)])
            yield pa.RecordBatch.from_pydict({"token": token.view(np.int64), "s": names[owner].view(np.int64), "n": n[owner].astype(np.int32)})

    def meet(batches):  # rows come sorted by (token, s): only the current token's first row is carried on
        token = s = n = None
        passed = False
        for batch in batches:
            if not batch.num_rows:
                continue
            t, x, m = (batch.column(c).to_numpy() for c in ("token", "s", "n"))
            if token is not None:
                t, x, m = np.append(token, t), np.append(s, x), np.append(n, m)
            keep = np.ones(len(t), bool)
            keep[1:] = (t[1:] != t[:-1]) | (x[1:] != x[:-1])
            t, x, m = t[keep], x[keep], m[keep]
            new = np.ones(len(t), bool)
            new[1:] = t[1:] != t[:-1]
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            several = np.bincount(group)[group] > 1
            if token is not None and passed:
                several[0] = False  # given out before
            yield pa.RecordBatch.from_pydict({"token": t[several], "s": x[several], "n": m[several],
                                              "ls": x[first[group]][several], "ln": m[first[group]][several]})
            # The carried row stands for its whole token; a repeated set right at the batch's edge is dropped as equal.
            f = first[-1]
            passed = bool(len(t) - f > 1) or (bool(passed) and f == 0 and token is not None)
            token, s, n = t[f:f + 1], x[f:f + 1], m[f:f + 1]

    dealt = sets.select("s", "t").mapInArrow(deal, "token bigint, s bigint, n int")
    # A set may be given out twice where a batch ends between its rows; what is made of the rows is distinct.
    return dealt.repartition("token").sortWithinPartitions("token", "s").mapInArrow(
        meet, "token bigint, s bigint, n int, ls bigint, ln int")


def once_per_group(rows: DataFrame) -> DataFrame:
    """Of shingles under which the same sets meet, one only: the others give the same pairs. Near copies meet under most of their prefixes. Sets
    of members are told apart by their number and sums of 31-bit pieces of two 64-bit hashes."""
    pieces = [piece for i in range(2) for h in [F.xxhash64("s", F.lit(i))] for piece in (h.bitwiseAND(0x7FFFFFFF), F.shiftrightunsigned(h, 33))]
    members = rows.groupBy("token").agg(F.count("*").alias("c"), *[F.sum(piece).alias(f"h{i}") for i, piece in enumerate(pieces)])
    kept = members.groupBy("c", *[f"h{i}" for i in range(len(pieces))]).agg(F.min("token").alias("token")).select("token")
    return rows.join(kept, "token", "left_semi")


def _of_each_set(sets: DataFrame, wanted: np.ndarray, columns, ddl: str) -> DataFrame:
    """One row per set that is perhaps wanted. ``columns(texts)`` gives its columns."""
    shared = sets.sparkSession.sparkContext.broadcast(wanted)

    def read(batches):
        for names, texts in texts_once(batches, shared.value):
            yield pa.RecordBatch.from_pydict({"s": names.view(np.int64), **columns(texts)})

    return sets.select("s", "t").mapInArrow(read, "s bigint, " + ddl).dropDuplicates(["s"])


def other_prefixes(sets: DataFrame, wanted: np.ndarray, k: int, percent: int) -> DataFrame:
    """``s``, the set's prefixes under the further orders, as 32-bit hashes, and its sketch."""
    def columns(texts):
        h, bounds = shingle_sets(texts, k)
        length = prefix_length(np.diff(bounds), percent)
        sketch = sketches(h, bounds).view(np.int64)
        out = {f"x{i}": sketch[:, i].copy() for i in range(SKETCH)}
        for seed in range(2, ORDERS + 1):
            token, owner = prefixes(h, bounds, length, seed, None)
            cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            out[f"p{seed}"] = pa.ListArray.from_arrays(pa.array(cuts), pa.array((token >> np.uint64(32)).astype(np.uint32).view(np.int32)))
        return out

    ddl = [*(f"x{i} bigint" for i in range(SKETCH)), *(f"p{i} array<int>" for i in range(2, ORDERS + 1))]
    return _of_each_set(sets, wanted, columns, ", ".join(ddl))


def verified(pairs: DataFrame, fronts: DataFrame, sets: DataFrame, k: int, percent: int, bits: int) -> DataFrame:
    """Of the pairs ``a, b`` those whose prefixes meet under all orders and whose similarity is high enough. Texts
    are fetched only for sets of pairs that passed all orders."""
    orders = range(2, ORDERS + 1)
    both = (pairs.join(fronts.select(F.col("s").alias("a"), *[F.col(f"p{i}").alias(f"a{i}") for i in orders]), "a")
            .join(fronts.select(F.col("s").alias("b"), *[F.col(f"p{i}").alias(f"b{i}") for i in orders]), "b"))
    for i in orders:
        both = both.where(F.arrays_overlap(f"a{i}", f"b{i}"))
    candidates = staged(both.select("a", "b"), "jaccard-candidates")
    wanted = filter_bits(candidates.select(F.explode(F.array("a", "b")).alias("s")), "s", bits)
    texts = staged(_of_each_set(sets, wanted, lambda t: {"t": t}, "t string"), "jaccard-sets")
    both = (candidates.join(texts.select(F.col("s").alias("a"), F.col("t").alias("ta")), "a")
            .join(texts.select(F.col("s").alias("b"), F.col("t").alias("tb")), "b"))

    def compare(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                (ha, ba), (hb, bb) = (shingle_sets(part.column(c), k) for c in ("ta", "tb"))
                na, nb = np.diff(ba), np.diff(bb)
                h = np.concatenate([ha, hb])
                owner = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                common = np.bincount(owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])], minlength=len(na))
                linked = 100 * common >= percent * (na + nb - common)
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(linked)) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(compare, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``s, comp``: for every node of the edges ``a, b`` the smallest node it is connected with. Large-star and
    small-star rounds, each a grouped minimum and a join, until nothing changes."""
    def grouped(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()

    def stars(pairs: DataFrame) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(grouped(both), "u").where("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "edges")
        small = large.join(grouped(large), "u")
        return small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct()

    spark = edges.sparkSession
    with recorded() as old:
        now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    mark = state(now)
    while mark[0]:
        with recorded() as new:
            now = settled(lambda: stars(now), "edges")
        release(spark, old)
        old = new
        before, mark = mark, state(now)
        if before == mark:
            break
    nodes = now.select(F.col("u").alias("s"), F.col("v").alias("comp"))
    return nodes.unionByName(now.select(F.col("v").alias("s"), F.col("v").alias("comp")).distinct())


def compatible(n: Column, m: Column, percent: int) -> Column:
    """Sizes that the similarity allows."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def near_enough(a, b, percent: int) -> Column:
    """Whether sizes and sketches leave room for the similarity: the sets differ in at least as many members as their
    sketches in bits. ``a`` and ``b`` give the columns of either side by name."""
    bits = sum((F.bit_count(a(f"x{i}").bitwiseXOR(b(f"x{i}"))) for i in range(1, SKETCH)), F.bit_count(a("x0").bitwiseXOR(b("x0"))))
    return compatible(a("n"), b("n"), percent) & (bits * (100 + percent) <= (a("n").cast("long") + b("n")) * (100 - percent))


def still_mixed(rows: DataFrame, links: DataFrame, fronts: DataFrame) -> DataFrame:
    """The meeting rows of shingles whose sets lie in several components so far, with ``comp`` and the set's sketch."""
    placed = rows.join(staged(components(links), "jaccard-components"), "s", "left").withColumn("comp", F.coalesce("comp", "s"))
    mixed = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("token")
    sketch = fronts.select("s", *[f"x{i}" for i in range(SKETCH)])
    return staged(placed.join(mixed, "token").select("token", "s", "n", "comp").join(sketch, "s"), "jaccard-mixed")


def to_centres(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of each row's set with its shingle's ``CENTRES`` sets that are the smallest under as many hashes,
    where components differ. Where near copies are only loosely linked, these pairs join nearly all of
    them, at a cost that grows with the rows; the minima are combined before the shuffle."""
    named = F.struct("s", "n", "comp", *[f"x{i}" for i in range(SKETCH)])
    centres = placed.groupBy("token").agg(*[
        F.min(F.struct(F.xxhash64("s", F.lit(i)).alias("h"), named.alias("row")))["row"].alias(f"c{i}") for i in range(CENTRES)])
    centres = centres.select("token", F.array_distinct(F.array(*[f"c{i}" for i in range(CENTRES)])).alias("centres"))
    apart = F.filter("centres", lambda x: (x["comp"] != F.col("comp")) & near_enough(lambda c: x[c], F.col, percent))
    return (placed.join(centres, "token").select("s", F.explode(F.transform(apart, lambda x: x["s"])).alias("c"))
            .select(F.least("s", "c").alias("a"), F.greatest("s", "c").alias("b")).distinct())


def across_components(placed: DataFrame, percent: int) -> DataFrame:
    """All pairs ``a, b`` that meet under a shingle, lie in different components and may be similar by their sketches.
    One side is outside the shingle's largest component."""
    sizes = placed.groupBy("token", "comp").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("c", "comp"))["comp"].alias("largest"))
    minor = placed.join(largest, "token").where("comp != largest").alias("minor")
    every = placed.alias("every")

    def one(c: str) -> Column:
        return F.col(f"every.{c}")

    def other(c: str) -> Column:
        return F.col(f"minor.{c}")

    met = ((one("token") == other("token")) & (one("comp") != other("comp"))
           & ((one("comp") == other("largest")) | (one("s") < other("s"))) & near_enough(one, other, percent))
    return every.join(minor, met).select(F.least(one("s"), other("s")).alias("a"), F.greatest(one("s"), other("s")).alias("b")).distinct()


def linked_sets(sets: DataFrame, k: int, percent: int, bits: int = FILTER_BITS) -> DataFrame:
    """``s, comp`` of the sets that are linked with another. ``sets`` has ``s, t``: names and texts of sets that can link, each at least once."""
    late = frequent_shingles(sets, k, percent)
    rows = settled(lambda: once_per_group(staged(meeting_rows(sets, late, k, percent), "jaccard-meeting")), "jaccard-meeting")
    fronts = staged(other_prefixes(sets, filter_bits(rows, "s", bits), k, percent), "jaccard-prefixes")

    def met(pairs: DataFrame) -> DataFrame:
        return verified(pairs, fronts, sets, k, percent, bits)

    stars = rows.where((F.col("s") != F.col("ls")) & compatible(F.col("n"), F.col("ln"), percent)).select(F.col("ls").alias("a"), F.col("s").alias("b")).distinct()
    links = settled(lambda: met(stars), "jaccard-links")
    # Second round: each set with several others that its shingles name.
    more = settled(lambda: met(to_centres(still_mixed(rows, links, fronts), percent)), "jaccard-links")
    links = links.unionByName(more)
    # Last round: shingles whose rows still lie in several components.
    more = settled(lambda: met(across_components(still_mixed(rows, links, fronts), percent)), "jaccard-links")
    return components(links.unionByName(more))


def classes(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``id, th, n, s, comp`` of every row; ``comp`` names its component (null for empty sets)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_hash(F.col("text")).alias("th"), F.col("text").alias("t"))
    with small_batches(docs.sparkSession):
        named = staged(named_sets(rows, shingle, percent), "jaccard-sets")
        linked = settled(lambda: linked_sets(named.where("t IS NOT NULL").select("s", "t"), shingle, percent), "jaccard-components")
    return named.select("id", "th", "n", "s").join(linked, "s", "left").withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "s")))


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: documents linked at ``percent`` similarity, directly or
    through others, have the smallest of their ids in common."""
    rows = settled(lambda: classes(docs, shingle, percent), "jaccard-classes")
    smallest = rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("component_id"))
    return rows.join(smallest, "comp", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id stays (ties: by a hash of the text,
    then any one of equal rows), with all columns; documents with empty sets all stay."""
    rows = settled(lambda: classes(docs, shingle, percent), "jaccard-classes")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    kept = rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min(order).alias("k")).select(
        F.col("k.id").alias("kept_id"), F.col("k.th").alias("kept_th"), F.lit(True).alias("single"))
    empty = rows.where("comp IS NULL").select(F.col("id").alias("kept_id"), F.col("th").alias("kept_th"), F.lit(False).alias("single")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"), text_hash(F.col("text")).alias("th"))
    met = whole.join(kept.unionByName(empty), F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("th") == F.col("kept_th")))
    numbered = met.withColumn("copy", F.row_number().over(W.partitionBy("id", "th").orderBy(F.lit(1))))
    return numbered.where(~F.col("single") | (F.col("copy") == 1)).select("doc.*")


OP4_SQL = """
WITH RECURSIVE doc AS (
    SELECT row_number() OVER () AS rid, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
sets AS (
    SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) END AS s
    FROM doc),
size AS (SELECT rid, doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
item AS MATERIALIZED (SELECT rid, hash(unnest(s)) AS x FROM sets),
common AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM item a JOIN item b ON a.x = b.x AND a.rid < b.rid GROUP BY 1, 2),
link AS MATERIALIZED (
    SELECT a, b FROM common JOIN size p ON p.rid = a JOIN size q ON q.rid = b WHERE 100 * c >= 90 * (p.n + q.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT rid AS a, rid AS b FROM size UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b)
SELECT size.doc_id, size.n AS n_shingles, min(other.doc_id) AS component_id
FROM size JOIN reach ON reach.a = size.rid JOIN size other ON other.rid = reach.b GROUP BY size.rid, size.doc_id, size.n
"""


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
