"""Prefix trie, token alignment and prefix doubling on untidy tables against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from ledgertide.llm import prefix_trie, suffix_array, token_alignment

tokenizer_files = pytest.importorskip("public_tokenizers")

TURNS = "conv_id long, turn long, role string, text string, n_convs int, d string, part string"


def brute_trie(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            m = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by[conv].append((turn is not None, turn or 0, role, m, text))
    own = {c: [(r, x) for *_, r, _, x in sorted(t)] for c, t in by.items()}
    nodes, ends, kids = collections.defaultdict(list), collections.defaultdict(list), collections.Counter()
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
        ends[path].append(c)
    for path in nodes:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = collections.Counter(), collections.Counter()
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += kids[path] == 0
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1]) if path else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p], sha(ends[p])) for p, m in nodes.items())


def talks(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 205, -7, -100, 301]:
        for k in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([k, k, None]), rng.choice(["user", "assistant", None]), rng.choice(["", None, "aé", "b" * 7, "same", f"own {c}"])))
    rows += [(c, k, "user", f"copy {k}") for c in range(400, 450) for k in range(7)]  # a group of copies
    rows += [(17, k // 2, "user", "tie" if k % 3 else None) for k in range(300)]  # one long conversation, ties and repeated rows
    rows += [(None, 1, "user", "nobody's")] * 3 + [rows[0]] * 2
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", ["3", "17"])
def test_prefix_trie(spark, parts):
    rows = talks(2)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TURNS).repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = prefix_trie.prefix_trie(df).collect()
        assert prefix_trie.prefix_trie(df.where("false")).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == brute_trie(rows)


def test_findclose_of_random_parentheses():
    rng = random.Random(1)
    for size in (1, 2, 40, 700):
        steps, depth, opened, want = [], 0, [], {}
        while len(steps) < size or depth:
            if len(steps) < size and (not depth or rng.random() < 0.55):
                opened.append(len(steps))
                steps.append(1)
                depth += 1
            else:
                want[opened.pop()] = len(steps)
                steps.append(-1)
                depth -= 1
        at = np.array(sorted(want))
        assert prefix_trie.Parentheses(np.array(steps)).findclose(at).tolist() == [want[i] for i in at]


def brute_bytes(docs, length):
    order = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), []
    for id_, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            piece = data[i:i + length]
            if piece in seen:
                gone[i:i + length] = True
            seen.add(piece)
        runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((-1 if id_ is None else id_, len(data), int(gone.sum()), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("length,gram,bits", [(100, 48, 1 << 20), (100, 48, 1 << 10), (24, 8, 1 << 20), (5, 5, 1 << 20)])
def test_repeated_bytes(spark, length, gram, bits, monkeypatch):
    monkeypatch.setattr(suffix_array, "HELD", 60 if bits == 1 << 10 else 100_000)
    rng = random.Random(9)
    prose = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, whole = prose(130), prose(400)
    texts = [None, "", "short", whole, whole, whole[:399], whole[7:], "a" * 500, "a" * 260, "ab" * 150, passage[:99], passage[:100]]
    texts += [prose(rng.randrange(80)) + passage[rng.randrange(20):] + prose(rng.randrange(120)) for _ in range(25)]
    texts += [prose(60_000)]  # very long
    docs = list(enumerate(texts)) + [(None, whole), (7, texts[7]), (3, whole), (3, whole)]  # null id, repeated rows
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, start int, th string").repartition(5)
    got = suffix_array.remove_repeated_bytes(df, length, gram, bits).collect()
    want = brute_bytes(docs, length)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert suffix_array.remove_repeated_bytes(df.where("false"), length, gram).collect() == []


def brute_alignment(docs, path_a, path_b):
    first, second = token_alignment.ByteTokenizer(path_a), token_alignment.PieceTokenizer(path_b)
    rows, links = [], []
    for id_, text in docs:
        a = first.model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.model.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(first.bytes[t] for t in a) != whole or b"".join(second.bytes[t] for t in b) != whole:
            rows.append((id_, 0, 0, 0, 0, ""))
            links.append([])
            continue
        groups, mine, ga, gb, i, j, ea, eb = [], [], [], [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if ea <= eb and i < len(a):
                ga.append(a[i])
                ea += len(first.bytes[a[i]])
                i += 1
            else:
                gb.append(b[j])
                eb += len(second.bytes[b[j]])
                j += 1
            if ea == eb:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                mine += [(x, y) for x in ga for y in gb]
                ga, gb = [], []
        rows.append((id_, len(a), len(b), len(groups), len(mine), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(mine)
    count = collections.Counter(p for mine in links for p in set(mine))
    best = collections.Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return sorted((-1 if r[0] is None else r[0], *r[1:5], sum(count[p] == best[p[0]] for p in mine), sum(count[p] for p in mine), r[5])
                  for r, mine in zip(rows, links))


@pytest.mark.parametrize("hot", [1 << 17, 5, 0])
def test_alignment(spark, hot):
    path_a, path_b = tokenizer_files.path("byte_bpe_50k.json"), tokenizer_files.path("piece_bpe_32k.model")
    texts = [None, "", " ", "one", "The quick  brown\n\tfox", "naïve Ünïcode 漢字 🙂 é", "<s> </s> <|endoftext|> <0x41>", "a▁b", "12345 67-89",
             "word " * 3000, "same words here", "same words here", "x" * 4000]
    docs = [*enumerate(texts), (None, "same words here"), (3, "one")]
    df = spark.createDataFrame([(i, t, "p", 1) for i, t in docs], "doc_id long, text string, pairs string, row int").repartition(3)
    got = token_alignment.aligned(df, path_a, path_b, hot).collect()
    want = brute_alignment(docs, path_a, path_b)
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == want
    got = token_alignment.aligned(df, path_a, path_b, hot, tokenizer_files.path("byte_bpe_50k.tiktoken")).collect()
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == want
    assert token_alignment.aligned(df.where("false"), path_a, path_b, hot).collect() == []


def test_groups_of_arrays():
    """Groups, links and digest of id arrays, tokens without bytes and wide groups among them."""
    rng = random.Random(8)
    names = token_alignment.id_names(30)
    for _ in range(200):
        size = [0, 1, *(rng.randrange(1, 5) for _ in range(28))]
        a, b, total = [], [], rng.randrange(1, 40)
        for ids in (a, b):
            while (left := total - sum(size[t] for t in ids)) > 0:
                ids += [t] if size[t := rng.randrange(30)] <= left else []
            ids += [0] * rng.randrange(2)
        ends = [[sum(size[t] for t in ids[:i + 1]) for i in range(len(ids))] for ids in (a, b)]
        cuts = [[max(i for i, e in enumerate(own) if e == end) + 1 for end in sorted(set(ends[0]) & set(ends[1]))] for own in ends]
        parts = [(a[i:x], b[j:y]) for i, j, x, y in zip([0, *cuts[0]], [0, *cuts[1]], *cuts)]
        got = token_alignment.sliced_groups(*(np.array(e) for e in ends))
        assert [c.tolist() for c in got] == cuts
        ids = np.array(a), np.array(b)
        assert token_alignment.linked_pairs(*ids, got).tolist() == [x << 32 | y for p, q in parts for x in p for y in q]
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in parts)
        assert token_alignment.groups_digest(*ids, got, names) == hashlib.sha256(written.encode()).hexdigest()


def test_ranks_give_the_ids_of_the_tokenizers_file():
    path, ranks = tokenizer_files.path("byte_bpe_50k.json"), tokenizer_files.path("byte_bpe_50k.tiktoken")
    rng = random.Random(6)
    kinds = [(32, 127), (0, 0x250), (0x250, 0xD7FF), (0xE000, 0x10FFFF), (9, 33)]
    texts = ["".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(1, 60))) for _ in range(4000)]
    texts += ["<|endoftext|> x", "a  \n\n b'll  c", " " * 300, "x" * 5000]
    assert token_alignment.ByteTokenizer(path, ranks).encode(texts) == token_alignment.ByteTokenizer(path).encode(texts)
    with pytest.raises(ValueError):
        token_alignment.ByteTokenizer(path, tokenizer_files.path("byte_bpe_multi_50k.tiktoken"))


def test_sharding_stage_keeps_columns_of_the_new_ones_names(spark):
    rows = [(i, f"text {i}", "s", i, -i, "old", 7) for i in range(60)] + [(None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int, slot long, size string, document_size int")
    got = corpus_pipeline.sharded(spark, corpus_pipeline.mixed(spark, df, ""), "").collect()
    assert all((r.document_shard, r.document_slot, r.document_document_size, r.document_size) == ((r.doc_id, -r.doc_id, "old", 7) if r.doc_id is not None else (None,) * 4)
               for r in got) and {r.shard for r in got} <= set(range(24)) and got
    assert corpus_pipeline.sharded(spark, corpus_pipeline.mixed(spark, df.where("false"), ""), "").collect() == []
