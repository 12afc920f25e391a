"""The prefix trie of conversations as balanced parentheses, built per shard.

1. Turns are range-sorted by conversation and turn. Each task numbers its turns and adds up hash terms; the totals with which a
   task ends are added to the tasks behind it, so no conversation needs to fit a task. The running sum up to a turn names its
   prefix by 128 bits. A rebuilt conversation takes a head from another one: its sums are shifted, not built anew.
2. Equal prefixes are one node: members, children and smallest member by aggregation with partial sums in the map tasks.
3. Where a node has one member, its subtree is a chain with one leaf and no saving. Paths down to the first such
   node, one for each conversation that is smallest member of a node, are range-sorted by their prefixes into shards.
   A shard writes its part of the trie as balanced parentheses. Excess minima of blocks and of pairs of blocks answer
   *findclose*, which delimits subtrees; the rank of leaf pairs counts leaves, a cumulative array adds up savings.
4. Shared spines (nodes on the first or last path of a shard, which neighbours may hold too) are merged by their names.

The member lists of nodes where many conversations end are sorted by range, packed into chunks, and
hashed chunk by chunk, so a list is never held whole.

Defined results: rows without conv_id belong to no conversation. A null turn comes first; equal turns follow role, then the MD5 of role
and text. Null role or text is empty. Repeated rows are turns of their own. Very long texts count by their length and hash
and are read once. An empty table gives an empty result. Extra columns are ignored, whatever their names. A task holds one shard's paths: at most
``spark.sql.shuffle.partitions`` shards share all distinct paths, each path being the shared part of one conversation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import staged, table

HEAD = 5  # a rebuilt conversation takes fewer than six turns of another one
FAMILY = 100
BLOCK = 64
CHUNK = 400  # ids in one piece of a member list

_U = np.uint64
_B1, _B2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def power(base: int, k: int) -> np.uint64:
    return _U(pow(base, k, 1 << 64))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, m`` (MD5 of role and text), ``len`` (code points of the text)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.md5(named.cast("binary")).alias("m"), F.length(text).cast("long").alias("len"))


_SCAN = "part int, conv bigint, ord bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, len bigint, carry boolean"


def prefix_sums(turns: DataFrame) -> DataFrame:
    """``conv, ord`` (from 1), ``p1, p2`` (sum up to the turn), ``q1, q2`` (sum before it), ``len``."""
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def scan(batches):
        part, conv, opening, n, sums = TaskContext.get().partitionId(), None, None, 0, [_U(0), _U(0)]
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            convs = batch.column("conv").to_numpy()
            opening = int(convs[0]) if opening is None else opening
            raw = np.frombuffer(bytes.fromhex("".join(batch.column("m").to_pylist())), ">u8").reshape(-1, 2).astype(np.uint64)
            new = np.ones(rows, bool)
            new[1:] = convs[1:] != convs[:-1]
            if conv == convs[0]:
                new[0] = False
            start = np.where(new, np.arange(rows), 0)
            start = np.maximum.accumulate(start)
            local = np.arange(rows) - start
            first_run = np.cumsum(new) == 0
            order = local + np.where(first_run, n, 0)
            out = {}
            for k, base in enumerate((_B1, _B2)):
                term = raw[:, k] | _U(1)
                step = power(base, n) if first_run.any() else _U(1)
                up = powers(base, int(local.max()) + 2)
                value = term * up[local] * np.where(first_run, step, _U(1)) * _U(base)
                total = np.cumsum(value)
                before = total - value
                offset = np.where(first_run, _U(0) - sums[k], before[start])
                out[k] = total - offset, before - offset
            conv, n = int(convs[-1]), int(order[-1]) + 1
            sums = [out[0][0][-1], out[1][0][-1]]
            yield batch_of(part, convs, order + 1, *(x.view(np.int64) for x in (out[0][0], out[1][0], out[0][1], out[1][1])),
                           batch.column("len").to_numpy(), np.zeros(rows, bool))
        if conv is not None:  # the task's first conversation, and what its last one brings into the next task
            zero = np.zeros(1, np.int64)
            yield batch_of(part, np.array([opening]), zero, zero, zero, zero, zero, zero, np.ones(1, bool))
            yield batch_of(part, np.array([conv]), np.array([n]), *(np.array([x], np.uint64).view(np.int64) for x in sums), zero, zero, zero,
                           np.ones(1, bool))

    def batch_of(part, conv, order, p1, p2, q1, q2, length, carry):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), part, np.int32)), *map(pa.array, (conv, order, p1, p2, q1, q2, length, carry))],
                                          names=["part", "conv", "ord", "p1", "p2", "q1", "q2", "len", "carry"])

    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("m")]
    dealt = turns.repartitionByRange(parts, *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    scanned = staged(dealt.mapInArrow(scan, _SCAN), "trie-scan")
    ends: dict[int, list] = {}
    for row in scanned.where("carry").collect():  # two rows for each task, whatever the conversations
        ends.setdefault(row.part, [None, None])[row.ord > 0] = row
    carried: dict[int, tuple] = {}
    conv, n, sums = None, 0, (0, 0)
    for part in sorted(ends):
        opening, closing = ends[part]
        whole = opening.conv == closing.conv
        if conv == opening.conv:
            carried[part] = (conv, n, sums)
        if whole and part in carried:
            sums = tuple((had + more * pow(base, n, 1 << 64)) % (1 << 64) for had, more, base in zip(sums, (closing.p1, closing.p2), (_B1, _B2)))
            n += closing.ord
        else:
            conv, n, sums = closing.conv, closing.ord, (closing.p1 % (1 << 64), closing.p2 % (1 << 64))

    def add(batches):
        for batch in batches:
            part, convs = batch.column("part").to_numpy(), batch.column("conv").to_numpy()
            order = batch.column("ord").to_numpy().copy()
            out = {c: batch.column(c).to_numpy().view(np.uint64).copy() for c in ("p1", "p2", "q1", "q2")}
            for k in np.unique(part).tolist():
                if k in carried:
                    conv, n, sums = carried[k]
                    rows = (part == k) & (convs == conv)
                    order[rows] += n
                    for c in out:
                        i = int(c[1]) - 1
                        out[c][rows] = _U(sums[i]) + out[c][rows] * power((_B1, _B2)[i], n)
            yield pa.RecordBatch.from_pydict({"conv": convs, "ord": order, **{c: v.view(np.int64) for c, v in out.items()}, "len": batch.column("len")})

    plain = scanned.where("NOT carry")
    return plain.mapInArrow(add, "conv bigint, ord bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, len bigint")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv, d, k1, k2`` (name of the prefix of d turns), ``u1, u2`` (of d - 1 turns), ``len, ends`` of rebuilt conversations; d = 0 is the root."""
    sums = staged(prefix_sums(turns_of(conversations)), "trie-sums")
    head = F.sort_array(F.collect_list(F.when(F.col("ord") <= HEAD, F.struct("ord", "p1", "p2", "len"))))
    convs = staged(sums.groupBy("conv").agg(F.max("ord").alias("n"), head.alias("head")), "trie-convs")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    other = convs.select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    info = convs.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).withColumn("h", h).join(other, "base", "left")
    m = F.least(F.col("h"), F.size(F.coalesce("base_head", F.array().cast(convs.schema["head"].dataType))))
    info = staged(info.withColumn("m", m).withColumn("d", F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "trie-info")

    def at(column: str, place: str, part: str):
        return F.coalesce(F.try_element_at(column, F.col(place))[part], F.lit(0).cast("long"))

    inner = info.where("m > 0").select("conv", F.col("d").alias("all"), F.posexplode(F.slice("base_head", 1, F.col("m"))).alias("i", "t"), "base_head")
    heads = inner.select("conv", (F.col("i") + 1).cast("long").alias("d"), F.col("t.p1").alias("k1"), F.col("t.p2").alias("k2"),
                         *[F.when(F.col("i") > 0, F.try_element_at("base_head", F.col("i"))[p]).otherwise(F.lit(0)).alias(u) for p, u in (("p1", "u1"), ("p2", "u2"))],
                         F.col("t.len").alias("len"), (F.col("i") + 1 == F.col("all")).alias("ends"))
    zero = F.lit(0).cast("long")
    roots = info.select("conv", zero.alias("d"), *[zero.alias(c) for c in ("k1", "k2", "u1", "u2", "len")], (F.col("d") == 0).alias("ends"))
    shift = info.where("n > h").select("conv", "h", "m", F.col("d").alias("all"), *[F.when(F.col("h") > 0, at("head", "h", p)).otherwise(zero).alias("o" + p) for p in ("p1", "p2")],
                                       *[F.when(F.col("m") > 0, at("base_head", "m", p)).otherwise(zero).alias("b" + p) for p in ("p1", "p2")])
    own = sums.join(shift, "conv").where("ord > h")

    def move(batches):
        for batch in batches:
            col = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            back = (col["h"] - col["m"]).astype(np.int64)
            d = col["ord"] - col["h"] + col["m"]
            out = {"conv": col["conv"], "d": d}
            for i, base in ((1, _B1), (2, _B2)):
                inverse = np.array([pow(base, -k, 1 << 64) for k in range(HEAD + 1)], np.uint64)[back]
                had, new = col[f"op{i}"].view(np.uint64), col[f"bp{i}"].view(np.uint64)
                for name, c in ((f"k{i}", f"p{i}"), (f"u{i}", f"q{i}")):
                    out[name] = (new + (col[c].view(np.uint64) - had) * inverse).view(np.int64)
            yield pa.RecordBatch.from_pydict({**{c: out[c] for c in ("conv", "d", "k1", "k2", "u1", "u2")}, "len": col["len"], "ends": d == col["all"]})

    moved = own.select("conv", "ord", "p1", "p2", "q1", "q2", "len", "h", "m", "all", "op1", "op2", "bp1", "bp2").mapInArrow(
        move, "conv bigint, d bigint, k1 bigint, k2 bigint, u1 bigint, u2 bigint, len bigint, ends boolean")
    return staged(roots.unionByName(heads).unionByName(moved), "trie-prefixes")


def member_hashes(ends: DataFrame) -> DataFrame:
    """``d, k1, k2, sha``: SHA-256 of the sorted, comma-joined conversations that end at a node."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["k1", "k2", "d"]

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([batch.column(c).to_numpy() for c in key], 1)
            ids = batch.column("conv").to_numpy()
            new = np.ones(len(ids), bool)
            new[1:] = (k[1:] != k[:-1]).any(1)
            starts = np.flatnonzero(new).tolist()
            cuts = [(i, min(i + CHUNK, b)) for a, b in zip(starts, starts[1:] + [len(ids)]) for i in range(a, b, CHUNK)]
            at = [i for i, _ in cuts]
            yield pa.RecordBatch.from_pydict({"k1": k[at, 0], "k2": k[at, 1], "d": k[at, 2], "first": ids[at],
                                              "ids": [",".join(map(str, ids[i:j].tolist())) for i, j in cuts]})

    def digest(batches):
        now, hasher = None, None
        for batch in batches:
            out = []
            for k1, k2, d, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "d", "ids"))):
                if (d, k1, k2) == now:
                    hasher.update(b",")
                else:
                    if now is not None:
                        out.append((*now, hasher.hexdigest()))
                    now, hasher = (d, k1, k2), hashlib.sha256()
                hasher.update(ids.encode())
            yield rows_of(out)
        if now is not None:
            yield rows_of([(*now, hasher.hexdigest())])

    def rows_of(out):
        d, k1, k2, sha = zip(*out) if out else ((),) * 4
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sha, pa.string())],
                                          names=["d", "k1", "k2", "sha"])

    dealt = ends.select(*key, "conv").repartitionByRange(parts, *key, "conv").sortWithinPartitions(*key, "conv")
    packed = dealt.mapInArrow(pack, "k1 bigint, k2 bigint, d bigint, first bigint, ids string")
    return packed.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(digest, "d bigint, k1 bigint, k2 bigint, sha string")


class Parentheses:
    """Balanced parentheses (+1 opens, -1 closes) with the least excess of blocks and, as a tree above them, of pairs of blocks."""

    def __init__(self, steps: np.ndarray) -> None:
        self.excess = np.cumsum(steps)
        blocks = max(1, -(-len(steps) // BLOCK))
        self.leaves = 1 << (blocks - 1).bit_length()
        padded = np.full(self.leaves * BLOCK, np.iinfo(np.int64).max)
        padded[:len(steps)] = self.excess
        self.padded = padded
        self.least = np.full(2 * self.leaves, np.iinfo(np.int64).max)
        self.least[self.leaves:] = padded.reshape(-1, BLOCK).min(1)
        for i in range(self.leaves - 1, 0, -1):
            self.least[i] = min(self.least[2 * i], self.least[2 * i + 1])

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Of each opening place, the place that closes it: the next with an excess lower by one than there."""
        goal = self.excess[opens] - 1
        close = self._in_block(opens + 1, goal)
        left = np.flatnonzero(close < 0)
        node = opens[left] // BLOCK + self.leaves
        climbing = np.ones(len(left), bool)
        while climbing.any():  # up, until a right sibling reaches the goal
            sibling = node + 1
            found = climbing & (node % 2 == 0) & (self.least[np.minimum(sibling, len(self.least) - 1)] <= goal[left])
            node = np.where(found, sibling, np.where(climbing, node // 2, node))
            climbing &= ~found
        while (node < self.leaves).any():  # down, to the first block that does
            inner = node < self.leaves
            child = np.where(inner, 2 * node, node)
            node = np.where(inner & (self.least[child] > goal[left]), child + 1, child)
        close[left] = self._in_block((node - self.leaves) * BLOCK, goal[left])
        return close

    def _in_block(self, start: np.ndarray, goal: np.ndarray) -> np.ndarray:
        found = np.full(len(start), -1, np.int64)
        stop = (start + BLOCK - 1) // BLOCK * BLOCK
        stop = np.where(start % BLOCK == 0, np.where(start > 0, start + BLOCK, BLOCK), stop)
        open_, place = np.arange(len(start)), start.astype(np.int64).copy()
        while len(open_):
            open_ = open_[place[open_] < np.minimum(stop[open_], len(self.padded))]
            hit = self.padded[place[open_]] == goal[open_]
            found[open_[hit]] = place[open_[hit]]
            open_ = open_[~hit]
            place[open_] += 1
        return found


def shard_sums(paths: list) -> dict[str, list]:
    """One shard's part of the trie from its sorted paths, each a list of (depth, name, name, saving, leaf): of each node the leaves and
    savings below it; ``spine`` where a neighbouring shard may hold the node too. The root comes last, as depth 0."""
    steps, opens, names, saved, leaf, spine = [], [], [], [], [], []
    stack: list[int] = []
    for i, path in enumerate(paths):
        same = 0
        while same < min(len(stack), len(path)) and names[stack[same]] == path[same][:3]:
            same += 1
        steps.extend([-1] * (len(stack) - same))
        del stack[same:]
        for step in path[same:]:
            stack.append(len(names))
            names.append(step[:3])
            opens.append(len(steps))
            steps.append(1)
            saved.append(0)
            leaf.append(0)
            spine.append(i == 0)
        for node, step in zip(stack, path):
            saved[node] += step[3] or 0
            leaf[node] |= bool(step[4])
    for node in stack:
        spine[node] = True
    steps.extend([-1] * len(stack))
    steps, at = np.array(steps, np.int64), np.array(opens, np.int64)
    close = Parentheses(steps).findclose(at) if len(at) else at
    pairs, values = np.zeros(len(steps) + 1, np.int64), np.zeros(len(steps) + 1, np.int64)
    np.add.at(pairs, at + 1, np.array(leaf, np.int64))
    np.add.at(values, at + 1, np.array(saved, np.int64))
    rank, total = np.cumsum(pairs), np.cumsum(values)
    return {"d": [n[0] for n in names] + [0], "k1": [n[1] for n in names] + [0], "k2": [n[2] for n in names] + [0],
            "leaves": [*(rank[close + 1] - rank[at]).tolist(), int(rank[-1])], "saved": [*(total[close + 1] - total[at]).tolist(), int(total[-1])],
            "spine": [*map(bool, spine), True]}


def trie_sums(paths: DataFrame) -> DataFrame:
    """``d, k1, k2, leaves, saved`` of the nodes on the paths and of the root."""
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def build(batches):
        held = []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held.append([(e["d"], e["k1"], e["k2"], e["saved"], e["leaf"]) for e in path])
        if held:
            yield pa.RecordBatch.from_pydict(shard_sums(held), schema=pa.schema([
                ("d", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("spine", pa.bool_())]))

    order = F.transform("path", lambda e: F.struct(e["k1"], e["k2"]))
    dealt = paths.select("path", order.alias("o")).repartitionByRange(parts, "o").sortWithinPartitions("o").select("path")
    sums = staged(dealt.mapInArrow(build, "d bigint, k1 bigint, k2 bigint, leaves bigint, saved bigint, spine boolean"), "trie-shards")
    merged = sums.where("spine").groupBy("d", "k1", "k2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return sums.where("NOT spine").drop("spine").unionByName(merged)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie's nodes: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    key = ["d", "k1", "k2"]
    rows = rebuilt(conversations)
    nodes = staged(rows.groupBy(*key).agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.min("u1").alias("u1"), F.min("u2").alias("u2"), F.min("len").alias("len"),
        F.max("ends").alias("ends")), "trie-nodes")
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(F.count("*").alias("children"))
    nodes = staged(nodes.join(children, key, "left").withColumn("children", F.coalesce("children", F.lit(0).cast("long"))), "trie-known")
    owners = nodes.groupBy("conv").agg(F.coalesce(F.min(F.when(F.col("n") == 1, F.col("d"))), F.max("d")).alias("reach"))
    saved = (F.col("n") - 1) * F.col("len")
    owned = nodes.select("conv", "d", saved.alias("saved"), ((F.col("n") == 1) | (F.col("children") == 0)).alias("leaf"))
    steps = rows.where("d > 0").select("conv", *key).join(owners, "conv").where("d <= reach").join(owned, ["conv", "d"], "left")
    paths = steps.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*key, "saved", "leaf"))).alias("path"))
    sums = trie_sums(paths)
    hashes = member_hashes(rows.where("ends").select(*key, "conv"))
    shared = nodes.where("n > 1 OR d = 0").join(sums, key, "left")
    one = F.lit(1).cast("long")
    every = shared.select(*nodes.columns, F.when((F.col("children") == 0), one).otherwise(F.coalesce("leaves", one)).alias("leaves"),
                          F.coalesce("saved", saved).alias("saved")).unionByName(
        nodes.where("n = 1 AND d > 0").select("*", one.alias("leaves"), F.lit(0).cast("long").alias("saved")))
    quiet = every.where("NOT ends").withColumn("sha", F.sha2(F.lit(""), 256))
    every = quiet.unionByName(every.where("ends").join(hashes, key))
    # A chain's inner nodes have their own conversation above them; the others look their parent up.
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv").alias("parent"))
    out = every.join(parents, ["d", "u1", "u2"], "left")
    return out.select(F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                      F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.col("sha").alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP11_SQL = """
WITH own AS (
    SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
           ORDER BY turn NULLS FIRST, coalesce(role, ''),
                    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS ts
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
    SELECT c, ts, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST(c AS VARCHAR), ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, b: xor(xor(a, b) >> 1, 3988292384::BIGINT * (xor(a, b) & 1))), 4294967295::BIGINT) % 6 AS h FROM own),
built AS (
    SELECT a.c, list_concat(list_slice(coalesce(b.ts, []), 1, a.h), list_slice(a.ts, a.h + 1, len(a.ts))) AS ts
    FROM crc a LEFT JOIN own b ON b.c = a.c - a.c % 100),
pre AS (SELECT c, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS d, ts FROM built),
row_ AS (SELECT c, d, d = n AS ends, list_slice(ts, 1, d) AS k, list_slice(ts, 1, d - 1) AS u FROM pre),
node AS (
    SELECT d, k, any_value(u) AS u, min(c) AS c, count(*) AS n, list(c ORDER BY c) FILTER (ends) AS m,
           (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(any_value(k)[d].t) END AS own
    FROM row_ GROUP BY d, k),
kid AS (SELECT d - 1 AS d, u AS k, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1, 2),
full_ AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kid USING (d, k)),
up AS (SELECT unnest(range(0, d + 1)) AS a, k, own, kids FROM full_),
below AS (SELECT a AS d, list_slice(k, 1, a) AS k, sum(own) AS saved, count(*) FILTER (kids = 0) AS leaves FROM up GROUP BY 1, 2)
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, p.c AS parent_conv_id, f.n AS n_convs, CAST(f.kids AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(array_to_string(f.m, ','), '')) AS ends_sha256
FROM full_ f JOIN below USING (d, k) LEFT JOIN node p ON p.d = f.d - 1 AND p.k = f.u
"""
