"""Slots of the pipeline's shards against a brute-force training order."""

import collections
import hashlib

import corpus_pipeline
from ledgertide.llm import mixing
from ledgertide.llm.common import staged


def brute_positions(docs, weights=(1, 2, 3), passes=3):
    """Training position of each copy: ``(doc_id, position)``."""
    by = collections.defaultdict(list)
    for doc_id, text, source in docs:
        by[source].append((hashlib.md5(str(doc_id).encode()).hexdigest()[:15], doc_id, len(text.split())))
    size = {s: sum(x[2] for x in rows) for s, rows in by.items()}
    weight = {s: weights[i % 3] for i, s in enumerate(sorted(by))}
    target, left, total = {}, set(by), float(sum(size.values()))
    while left:
        level = total / sum(weight[s] for s in left)
        full = {s for s in left if passes * size[s] <= level * weight[s]}
        for s in full or left:
            target[s] = float(passes * size[s]) if full else level * weight[s]
            total -= target[s]
        left -= full or left
    out = []
    for s, rows in by.items():
        a, b = mixing.SCHEDULES[weight[s] - 1][0], mixing.SCHEDULES[weight[s] - 1][2]
        begins = 0
        for _, doc_id, n in sorted(rows):
            for e in range(passes):
                if begins + e * size[s] + n / 2 <= target[s]:
                    y, lo, hi = min(1.0, (begins + e * size[s]) / target[s]), 0.0, 1.0
                    for _ in range(60):
                        t = (lo + hi) / 2
                        lo, hi = (t, hi) if a * t + (b - a) * t * t / 2 < y else (lo, t)
                    out.append((doc_id, lo))
            begins += n
    return out


def test_slots_follow_the_training_order(spark):
    sources = ["heavy"] * 40 + ["late"] * 260 + ["seldom"] * 20
    docs = [(i, f"w{i} " * (5 + i * 7 % 11), s, f"x{i}") for i, s in enumerate(sources)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, source string, extra string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = staged(corpus_pipeline.mixed(spark, rows, ""), "test-mixed")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(mixed.inputFiles()) > 1
    got = corpus_pipeline.sharded(spark, mixed, "").collect()
    want = brute_positions([d[:3] for d in docs])
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(d for d, _ in want)
    assert all(r.extra == f"x{r.doc_id}" for r in got)
    copies = collections.defaultdict(list)
    for doc_id, at in sorted(want, key=lambda x: x[1]):
        copies[doc_id].append(at)
    shards = collections.defaultdict(list)
    for r in got:
        shards[r.shard].append((r.slot, r.doc_id))
    taken = collections.Counter()
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    for slots in shards.values():
        slots.sort()
        assert [s for s, _ in slots] == list(range(len(slots)))
        seen, last = collections.Counter(), 0.0
        for _, doc_id in slots:  # of the copies a shard holds, some assignment of passes must rise with the slots
            at = next(p for p in copies[doc_id][seen[doc_id]:] if p >= last - 1e-9)
            seen[doc_id] = copies[doc_id].index(at) + 1
            taken[doc_id] += 1
            last = max(last, at)
    assert max(taken.values()) == 3


def test_another_schedule_gives_other_slots(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "a b c", "abc"[i % 3]) for i in range(240)], "doc_id long, text string, source string")
    place = lambda name: {(r.doc_id, r.shard, r.slot) for r in corpus_pipeline.sharded(
        spark, staged(corpus_pipeline.mixed(spark, rows, ""), name), "").collect()}
    one = place("test-one")
    monkeypatch.setattr(mixing, "SCHEDULES", mixing.SCHEDULES[::-1])
    assert one != place("test-other")
