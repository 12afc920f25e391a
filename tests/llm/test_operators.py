"""Each operator on small untidy tables against a brute-force version."""

import collections
import hashlib
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgertide.llm import (decontaminate, jaccard_join, language, mixing, quality_rules, sharding, site_style,
                            substring_dedup, token_counts, warc)
from ledgertide.llm.common import new_folder, recorded

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, n_words string"


def make_docs():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 6)))
    prose = lambda n: [word() for _ in range(n)]
    base, passage, texts = prose(120), prose(30), [None, "", " \t\n ", "one", "One  TWO", "two words"]
    texts += [" ".join(base)] * 3 + [" ".join(base).upper()]
    for i in range(8):
        near = list(base)
        near[i * 7] = word()
        texts.append("\n".join(near))
    texts += [" ".join(prose(40) + passage + prose(30)) for _ in range(6)]
    texts += [" ".join(passage[:20] * 5), "x " * 300, "line a b c\nline a b c\n\nline d\r\nline a b c", "## $$ a|b <c> " * 12]
    texts += [" ".join(prose(rnd.randint(1, 200))) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, None, 1, "x") for i, t in enumerate(texts)]
    return rows + [(None, texts[12], None, "s1", 3, 2, None), (5, texts[5], "en", "s1", 9, 1, "x"), (5, texts[14], None, None, None, None, None)]


BENCH = [(1, " ".join("abc abd abe bcd".split())), (2, None), (3, ""), (None, "two words"), (4, "one")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs(), DOCS).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_sharding_balances_and_numbers(docs, empty):
    got = sharding.shard(docs, shards=5, virtual_nodes=8, cells=64).collect()
    rows = make_docs()
    assert order((r.doc_id, r.size, r.text_crc32) for r in got) == order(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(5)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    loose = sharding.shard(docs, shards=5, virtual_nodes=64, epsilon=10.0, cells=64)
    assert loose.where("home != shard").count() == 0
    assert sharding.shard(empty, shards=5).count() == 0


def brute_components(rows, k, percent):
    sets = []
    for r in rows:
        w = [x.lower() for x in (r[1] or "").encode().split()]
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    return [(r[0], len(sets[i]), min([x for x in least[find(i)] if x is not None], default=None)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("k,percent", [(3, 90), (2, 60)])
def test_jaccard_components(docs, empty, k, percent):
    assert order(jaccard_join.jaccard_components(docs, k, percent).collect()) == order(brute_components(make_docs(), k, percent))
    if k == 3:
        assert jaccard_join.jaccard_components(empty).count() == 0


def test_one_of_each_group(docs):
    kept = jaccard_join.one_of_each_group(docs.where("coalesce(doc_id, -1) != 5 OR source IS NOT NULL"), 3, 90)
    assert kept.columns == docs.columns
    want = {c for _, n, c in brute_components([r for r in make_docs() if r[0] != 5 or r[3]], 3, 90) if n}
    assert sorted(r.doc_id for r in kept.collect() if (r.text or "").strip()) == sorted(want)


def test_mixing(docs, empty, spark):
    got = mixing.mix(docs).collect()
    rows = make_docs()
    assert order((r.doc_id, r["size"]) for r in got) == order((r[0], len((r[1] or "").encode().split())) for r in rows)
    assert order(got) == order(mixing.mix(docs.repartition(7)).collect())
    assert all(r.taken <= 3 * r["size"] and all(0 <= p <= 1 for p in r.positions) for r in got)
    sources = mixing.mix(docs, carry=["source"]).collect()
    assert abs(sum({r.source: r.target for r in sources}.values()) - sum(r["size"] for r in got)) < 1e-6
    largest = max(r["size"] for r in got)
    by, target = collections.defaultdict(int), {}
    for r in sources:
        by[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(by[x] - target[x]) <= largest / 2 + 1 for x in by)
    assert mixing.mix(empty).count() == 0
    demand = spark.range(11).select(mixing.inverse_demand(F.col("id") / 10, F.array(*map(F.lit, [1.5, 1.0, 0.5]))).alias("t"), (F.col("id") / 10).alias("y"))
    assert all(abs((1.5 * r.t - 0.5 * r.t * r.t) - r.y) < 1e-9 for r in demand.collect())  # the integral of 1.5 - t


def test_another_schedule_gives_other_positions(docs):
    """Positions follow the schedule; what a document counts doesn't."""
    def taken(schedules):
        return {r.place: (r.copies, r.positions) for r in mixing.mix(docs.withColumn("place", F.xxhash64(*docs.columns)), schedules=schedules,
                                                                     carry=["place"]).collect()}

    flat, early = taken([[1.0, 1.0, 1.0]]), taken([[2.0, 1.0, 0.0]])
    assert {k: v[0] for k, v in flat.items()} == {k: v[0] for k, v in early.items()}
    assert any(v[1] != early[k][1] for k, v in flat.items())
    assert all(b <= a + 1e-12 for k, v in flat.items() for a, b in zip(v[1], early[k][1]))  # early demand stands earlier


def test_a_passage_that_thousands_share_links_nothing(spark):
    """Two thirds of each text are one passage: no pair is similar enough, and no shingle's group is paired out."""
    common = " ".join(f"same{i}" for i in range(20))
    rows = [(i, common + " " + " ".join(f"own{i}x{j}" for j in range(10))) for i in range(3000)]
    docs = spark.createDataFrame([*rows, (9000, rows[7][1])], "doc_id long, text string")
    got = jaccard_join.jaccard_components(docs).where("doc_id != component_id").collect()
    assert [(r.doc_id, r.component_id) for r in got] == [(9000, 7)]


def test_pairs_meet_once_per_group_of_shingles(spark):
    """Of shingles under which the same sets meet one is left, and no pair of sets is lost."""
    rnd = random.Random(3)
    groups = {t: set(range(12)) - set(rnd.sample(range(12), t % 4)) for t in range(40)} | {50: {20, 21}, 51: {20, 21}, 52: {21, 22}}
    rows = spark.createDataFrame([(t, x) for t, g in groups.items() for x in g], "token long, s long").repartition(3)

    def left(df):
        out = collections.defaultdict(set)
        for r in df.collect():
            out[r.token].add(r.s)
        return out

    def pairs(gs):
        return {(a, b) for g in gs.values() for a in g for b in g if a < b}

    once = left(jaccard_join.once_per_group(rows))
    assert len(once) == len({frozenset(g) for g in groups.values()}) and pairs(once) == pairs(groups)


def test_settings_and_staged_tables_last_no_longer_than_needed(spark, docs):
    batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with recorded() as folders, recorded() as inner:
        jaccard_join.jaccard_components(docs, 3, 90)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batches and folders == inner
    left = [f for f in folders if os.path.exists(f)]
    assert len(folders) > 5 and len(left) == 1 and "jaccard-classes" in left[0]


def brute_removal(rows, n):
    placed = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = {}, []
    for r in placed:
        w = (r[1] or "").encode().split()
        gone = set()
        for i in range(len(w) - n + 1):
            if seen.setdefault(tuple(w[i:i + n]), (id(r), i)) != (id(r), i):
                gone.update(range(i, i + n))
        out.append((r[0], len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("limit", [4000, 2])
def test_substring_removal(spark, empty, limit, monkeypatch):
    monkeypatch.setattr(substring_dedup, "TREE_ROWS", 10)
    rows = [r for r in make_docs() if not (r[0] == 5 and r[3] is None)]  # rows of one id and other texts have an order of their own
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert order(substring_dedup.remove_repeats(docs, group_limit=limit).collect()) == order(brute_removal(rows, 20))
    if limit == 2:
        assert substring_dedup.remove_repeats(empty).count() == 0


def test_substring_removal_holds_few_texts(spark, docs, monkeypatch):
    """Python is given texts in small batches only, and what is returned sorts none and keeps one staged table."""
    asked, stage = [], substring_dedup.staged

    def watched(df, name):
        asked.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return stage(df, name)

    monkeypatch.setattr(substring_dedup, "staged", watched)
    with recorded() as folders:
        got = substring_dedup.remove_repeats(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert max(asked) <= 1000 and "Window" not in plan and "MapInArrow" not in plan
    assert [f for f in folders if os.path.isdir(f.removeprefix("file:"))] == folders[-1:]
    assert got.where("n_removed > 0").count() > 0


def test_quality(docs, empty, spark):
    stats = {(r["_id"], r["_n"], r["_chars"], r["_symbols"], r["_dup"], r["_repeat"]) for r in
             quality_rules.text_statistics(docs, [F.col("doc_id").alias("_id")]).collect()}
    want = set()
    for r in make_docs():
        t = r[1] or ""
        w = t.encode().split()
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        want.add((r[0], len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)))
    assert stats == want
    rnd = random.Random(1)
    rows = [(i, " ".join(("w%d###" if i % 3 == 0 else "w%d") % rnd.randint(0, 10**6) for _ in range(40)), "en", "s", 1, 1, "x") for i in range(240)]
    many = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), None) for i in range(0, 180)] + [(None, 1, 0), (7, None, 1), (999, 1, 0)], "doc_id long, quality int, toxic int")
    kept = quality_rules.good_documents(many, labels)
    assert kept.columns == many.columns and sorted(r.doc_id for r in kept.collect()) == [i for i in range(240) if i % 3]  # 180.. held out
    assert quality_rules.good_documents(empty, labels).count() == 0
    assert quality_rules.good_documents(many, labels.limit(0)).count() == 240


def test_token_counts(docs, empty):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    size = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    got = token_counts.count_tokens(docs, path, chunk_chars=100, overlap=10).collect()
    assert order(got) == order((r[0], len((r[1] or "").encode()), size(r[1])) for r in make_docs())
    assert token_counts.count_tokens(empty, path).count() == 0
    counter = token_counts.PieceCounter(path)
    assert counter.counts(["ab", "7" * 5000, "ab"])[0] == counter.counts(["ab"])[0] and list(counter.memo) == ["ab"]
    counter, rnd = token_counts.PieceCounter(path), random.Random(2)
    odd = ["<|endoftext|>", "<|endof", "   ", "\n\n \n", "a" * 90, " " * 70, "'ll", "!?" * 20, "漢字", "\x1c", "😀", "word ", "é"]
    for _ in range(150):
        text = "".join(rnd.choice(odd) for _ in range(rnd.randint(1, 60)))
        chunk = rnd.randint(15, 120)
        assert token_counts.count_spliced(counter, text, chunk, rnd.randint(1, chunk // 2)) == size(text)


@pytest.mark.parametrize("block_bytes", [1 << 20, 4])
def test_decontamination(docs, empty, spark, block_bytes):
    rows = make_docs()
    bench = spark.createDataFrame(BENCH + [(9, " ".join(rows[20][1].split()[3:22]))], "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench, block_bytes=block_bytes).withColumn("hit", decontaminate.hit_words(F.col("hit_spans")))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    want = []
    for r in rows:
        w, hit, items = split(r[1]), set(), set()
        for item in bench.collect():
            p = split(item.text)
            k = min(13, len(p))
            for j in range(len(p) - k + 1 if p else 0):
                for i in range(len(w) - k + 1):
                    if w[i:i + k] == p[j:j + k]:
                        hit.update(range(i, i + k))
                        items.add("" if item.item_id is None else str(item.item_id))
        want.append((r[0], len(w), len(hit), sorted(items)))
    assert order((r.doc_id, r.n_words, r.hit, r.item_ids) for r in got.collect()) == order(want)
    assert decontaminate.find_contamination(empty, bench).count() == 0
    assert decontaminate.find_contamination(docs, bench.limit(0)).where("size(item_ids) > 0").count() == 0


PAGE = ('<html lang="{lang}"><head><title>T</title><script>var a="</p>";</script></head><body><header>Site</header><nav><a href=x>Menu {i}</a></nav>'
        '<div class="ad">Buy {i}</div><article><h1>A &amp; B</h1><p><b>{body}<br>more<p>x&lt;y<div class="comments">C</div></article><footer>&copy;</footer>')


def make_pages():
    rows = [(i, f"https://a.example.org/{i}", PAGE.format(lang="en", i=i, body=f"text {i}")) for i in range(12)]
    rows += [(20 + i, "http://b.example.com/x", f"<div id=top>Same on all</div><div><p>Story {i}</div>") for i in range(10)]
    return rows + [(40, None, None), (41, "", ""), (42, "no address", "<p>loose < text"), (3, "https://a.example.org/3", rows[3][2]), (None, "x", rows[4][2]),
                   (50, "y", rows[4][2])]


def test_main_text(spark):
    pages = spark.createDataFrame([(*r, 1) for r in make_pages()], "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in site_style.extract_main_text(pages).collect()}
    assert got[0] == "A & B\ntext 0 more\nx<y" and got[3].startswith("A & B\ntext 3")
    assert got[23] == "Story 3" and got[40] == got[41] == "" and got[42] == "loose < text"
    assert site_style.extract_main_text(pages.limit(0)).count() == 0


def test_warc_round_trip(spark):
    rows = make_pages()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    records = warc.read_archives(warc.write_archives(pages, new_folder(spark, "warc")), split_bytes=300).collect()
    last = {}
    for page_id, _, body in rows:
        last[body or ""] = max([x for x in (last.get(body or ""), page_id) if x is not None], default=None)
    want = [(f"<urn:page:{'' if p is None else p}>", len((b or "").encode()), warc.payload_digest((b or "").encode()),
             "response" if last[b or ""] == p else "revisit", None if last[b or ""] == p else f"<urn:page:{last[b or '']}>") for p, _, b in rows]
    assert order((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records) == order(want)
    assert all(hashlib.sha1(r.payload).digest() and warc.payload_digest(bytes(r.payload)) == r.payload_digest for r in records if r.payload is not None)
    assert warc.read_archives(warc.write_archives(pages.limit(0), new_folder(spark, "warc"))).count() == 0


def test_warc_ranges_are_read_by_many_tasks(spark):
    pages = spark.range(64).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(cast(id AS string), 256), 40) AS html").coalesce(1)
    manifest = warc.write_archives(pages, new_folder(spark, "warc"))
    n_bytes = manifest.agg(F.sum("n_bytes")).first()[0]
    read = warc.read_archives(manifest, split_bytes=n_bytes // 12 + 1)
    assert read.rdd.getNumPartitions() == 12
    assert sum(1 for r in read.select(F.spark_partition_id().alias("p")).distinct().collect()) > 8
    assert sorted(r.record_id for r in read.collect()) == sorted(f"<urn:page:{i}>" for i in range(64))


def test_language_on_held_out_text(spark):
    rnd = random.Random(3)
    parts = {"aa": ["tha", "ing", "er"], "bb": ["oui", "eau", "que"]}
    say = lambda lang, n: " ".join("".join(rnd.choice(parts[lang]) for _ in range(3)) for _ in range(n))
    docs = spark.createDataFrame([(i, say(x, 40), x) for i, x in enumerate(["aa", "bb"] * 20)] + [(99, None, "aa"), (98, "x", None)], "doc_id long, text string, lang string")
    rows = [(i, f"http://{x}.example.org/", f'<html lang="{x}"><body><p>{say(x, 30)}') for i, x in enumerate(["aa", "bb"] * 15)]
    rows += [(60, "http://aa.example.org/", "<p></p>"), (61, None, None), (62, "http://bb.example.org/q", f"<html lang=aa><p>{say('bb', 30)}")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in language.identify(pages, docs).collect()}
    assert all(got[i].language == x for i, x in enumerate(["aa", "bb"] * 15))
    assert got[60].language == "aa" and got[61].language in ("aa", "bb") and got[62].language == "bb" and len(got) == len(rows)
    assert language.identify(pages, docs.limit(0)).where("language IS NOT NULL").count() == 0
    assert language.identify(pages.limit(0), docs).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "mixing", "sharding"]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and {r.doc_id for r in out} <= {r[0] for r in make_docs()} and sorted(r.slot for r in out if r.shard == out[0].shard)[0] == 0
