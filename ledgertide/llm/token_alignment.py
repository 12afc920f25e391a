"""Alignment of two tokenizers over the same bytes.

Both token sequences of a text are lists of cumulative byte ends. A dictionary from end to index is built for each;
the keys both have, sorted, are the boundaries where both tokens end, and cut the two id lists into groups. Each group links
every token of one list in it with every token of the other.

A pair's count is the number of documents that hold it linked. Each document is encoded once; its distinct pairs and how
often it holds each are kept as two packed arrays in a staged row. Counts are summed per batch, then by Spark. The
``HOT_PAIRS`` pairs that most documents hold (a fixed number, some megabytes) and the highest count of each id of the first
tokenizer (at most its vocabulary) are sent to the tasks, which settle those pairs in place; all other pairs are settled by a join on the pair.
Both ways give the same numbers, and the second one moves few rows.

Defined results: a null or empty text, and one whose joined token bytes are not space and text, has no tokens: zeros, and an empty
``groups_sha256``. Very long texts are encoded whole, alone in their slice. Repeated rows count as documents of their own. Of equal highest counts
all are best. An empty table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import staged, table
from ledgertide.llm.token_counts import PIECE_PATTERN

HOT_PAIRS = 1 << 17
SLICE_CHARS = 1 << 18
_SPACE = "▁"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class ByteTokenizer:
    """A byte-level BPE, special strings read as plain text. The tokenizers file gives the vocabulary; with ``ranks``, the same vocabulary as
    ranks, texts are encoded by the tiktoken library, which gives the same ids in a third of the time."""

    def __init__(self, path: str, ranks: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        if "ByteLevel(add_prefix_space=False" not in str(self.model.pre_tokenizer) or self.model.normalizer:
            raise ValueError(f"{path} is no byte-level tokenizer without normaliser and prefix space")
        letters = byte_letters()
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.quick = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            if any(self.bytes[rank] != token for token, rank in table.items()):
                raise ValueError(f"{ranks} is not the vocabulary of {path}")
            self.quick = tiktoken.Encoding("ranks", pat_str=PIECE_PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of space and text."""
        texts = [" " + t for t in texts]
        if self.quick:
            return [self.quick.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


class PieceTokenizer:
    """A sentencepiece model that puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode()
                      for i, p in ((i, self.model.id_to_piece(i)) for i in range(self.model.vocab_size()))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def sliced_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of the groups in a and in b: places after which both sequences end at the same byte."""
    at_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1)))
    common = list(filter(at_b.__contains__, at_a))  # keys come in the order of the bytes
    return tuple(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (at_a, at_b))


def linked_pairs(a: np.ndarray, b: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Every token of a with every token of b of the same group, as ``a * 2^32 + b``."""
    n_a, n_b = (np.diff(c, prepend=0) for c in cuts)
    width = np.repeat(n_b, n_a)  # each token of a meets all of b in its group
    first = np.repeat(np.cumsum(n_b) - n_b, n_a)
    shift = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
    return (np.repeat(a, width) << 32) | b[np.repeat(first, width) + shift]


def id_names(n: int) -> np.ndarray:
    """Ids below n as they are written inside a group, at the end of its first half, and at its end."""
    return np.array([[f"{i}{mark}" for i in range(n)] for mark in ",|;"], object)


def groups_digest(a: np.ndarray, b: np.ndarray, cuts: tuple[np.ndarray, np.ndarray], names: np.ndarray) -> str:
    ends_a, ends_b = cuts
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[ends_a - 1], last_b[ends_b - 1] = 1, 2
    out = np.empty(len(a) + len(b), object)  # the tokens of a group's a, then those of its b
    out[np.arange(len(a)) + np.repeat(np.append(0, ends_b[:-1]), np.diff(ends_a, prepend=0))] = names[last_a, a]
    out[np.arange(len(b)) + np.repeat(ends_a, np.diff(ends_b, prepend=0))] = names[last_b, b]
    return hashlib.sha256("".join(out.tolist())[:-1].encode()).hexdigest()


_ROW = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
        "pairs": pa.binary(), "times": pa.binary()}


def encoded(docs: DataFrame, path_a: str, path_b: str, ranks_a: str | None = None) -> DataFrame:
    """One row per document: token, group and link numbers, the digest, and the distinct pairs packed (8 bytes a pair, 4 bytes a number)."""
    def encode(batches):
        first, second = ByteTokenizer(path_a, ranks_a), PieceTokenizer(path_b)
        bytes_a, bytes_b = np.array(first.bytes, object), np.array(second.bytes, object)
        size_a, size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (first, second))
        names = id_names(max(len(size_a), len(size_b)))

        def rows(ids, texts):
            known = [t for t in texts if t]
            encodings = zip(first.encode(known), second.encode(known))
            for id_, text in zip(ids, texts):
                if not text:
                    yield (id_, 0, 0, 0, 0, "", b"", b"")
                    continue
                a, b = (np.array(x, np.int64) for x in next(encodings))
                whole = b" " + text.encode()
                if b"".join(bytes_b[b].tolist()) != whole or b"".join(bytes_a[a].tolist()) != whole:
                    yield (id_, 0, 0, 0, 0, "", b"", b"")
                    continue
                cuts = sliced_groups(np.cumsum(size_a[a]), np.cumsum(size_b[b]))
                pairs, times = np.unique(linked_pairs(a, b, cuts), return_counts=True)
                yield (id_, len(a), len(b), len(cuts[0]), int(times.sum()), groups_digest(a, b, cuts, names), pairs.tobytes(), times.astype(np.int32).tobytes())

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * len(_ROW), _ROW.values())], names=list(_ROW))

        for batch in batches:
            ids, texts, held, size = [], [], [], 0
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("t")):
                text = text.as_py()
                ids.append(id_)
                texts.append(text)
                size += len(text or "")
                if size >= SLICE_CHARS:
                    yield batch_of(list(rows(ids, texts)))
                    ids, texts, size = [], [], 0
            yield batch_of(list(rows(ids, texts)))

    ddl = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, times binary"
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t")).mapInArrow(encode, ddl)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n``: the number of documents that hold a pair."""
    def count(batches):
        for batch in batches:
            all_ = np.frombuffer(b"".join(batch.column("pairs").to_pylist()), np.int64)
            pairs, n = np.unique(all_, return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": pairs, "n": n})

    return rows.select("pairs").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def aligned(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS, ranks_a: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    rows = staged(encoded(docs, path_a, path_b, ranks_a).withColumn("row", F.monotonically_increasing_id()), "align-rows")
    counts = staged(pair_counts(rows), "align-counts")
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("n")).toArrow()  # at most one row for each id
    top = counts.orderBy(F.desc("n"), "pair").limit(hot_pairs).toArrow()
    highest = np.zeros(int(max(best["a"].to_pylist(), default=0)) + 1, np.int64)
    highest[best["a"].to_numpy()] = best["n"].to_numpy()
    order = np.argsort(top["pair"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast((top["pair"].to_numpy()[order], top["n"].to_numpy()[order], highest))

    def settle(batches, cold: bool):
        hot, n, most = shared.value
        for batch in batches:
            packed, times = batch.column("pairs").to_pylist(), batch.column("times").to_pylist()
            pair, time = np.frombuffer(b"".join(packed), np.int64), np.frombuffer(b"".join(times), np.int32).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), [len(p) // 8 for p in packed])
            at = np.minimum(np.searchsorted(hot, pair), max(0, len(hot) - 1))
            known = hot[at] == pair if len(hot) else np.zeros(len(pair), bool)
            if cold:
                left = ~known
                yield pa.RecordBatch.from_pydict({"row": batch.column("row").to_numpy()[row[left]], "pair": pair[left], "times": time[left],
                                                  "best": most[pair[left] >> 32]})
                continue
            row, pair, time, count = row[known], pair[known], time[known], n[at[known]] if len(hot) else time[known]
            sums, bests = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, row, time * count)
            np.add.at(bests, row, np.where(count == most[pair >> 32], time, 0))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(sums), pa.array(bests)], names=[*carried, "hot_sum", "hot_best"])

    carried = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    settled = rows.mapInArrow(lambda b: settle(b, False), "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                              "groups_sha256 string, hot_sum bigint, hot_best bigint")
    rest = rows.select("row", "pairs", "times").mapInArrow(lambda b: settle(b, True), "row bigint, pair bigint, times bigint, best bigint")
    rest = rest.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("rest_sum"), F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("rest_best"))
    zero = F.lit(0).cast("long")
    return settled.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("hot_best") + F.coalesce("rest_best", zero)).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("rest_sum", zero)).alias("count_sum"), "groups_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return aligned(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), ranks_a=path("byte_bpe_50k.tiktoken"))
