"""Token counts with a byte-level BPE tokenizer; huge documents by overlapping chunks that are spliced
where both tokenisations provably agree.

A byte-level BPE tokenizer first cuts a text into pieces by a pattern, then merges bytes inside each piece. The
pattern looks ahead by one character at most and never back, and special strings are cut out first. So:

* every piece that ends at least ``len(longest special string)`` characters before a chunk's end, in a chunk
  that begins at a true boundary, is a piece of the whole text;
* where two chunks both have a piece boundary at the same place, and the first one's is true, everything the
  second chunk says from there on (up to its own end margin) is true.

A document above ``chunk_chars`` is cut into chunks that overlap by ``overlap`` characters. Each chunk is encoded
into pieces with offsets and token counts; neighbours are spliced at the last common true boundary of their overlap.
Without one (a piece longer than the overlap), the left chunk is widened to the right, doubling each time, until it
meets the next chunk or passes over it. Memory holds one pair of chunks besides the text.

The token count of a piece is what the tokenizer library returns for it, remembered per worker in a table of bounded size.
Pieces come from the published pattern for texts of characters below U+0530, where it was compared with the library
on every code point, and from the library's own pre-tokenizer for all other texts.

Defined results: null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import table

CHUNK_CHARS = 1 << 15
OVERLAP = 256
TOKEN_LIMIT = 512
MEMO = 400_000
MEMO_CHARS = 64  # longer pieces hardly recur; with both bounds the memory of a worker is bounded in bytes

# Fixed value: the published pattern of this family of byte-level tokenizers.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PieceCounter:
    """Pieces of a text and the number of tokens of each, as the tokenizer library gives them."""

    def __init__(self, path: str, memo: int = MEMO) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        plain = all(not (a.lstrip or a.rstrip or a.single_word or a.normalized) for a in added)
        if "ByteLevel(add_prefix_space=False" not in str(self.tokenizer.pre_tokenizer) or self.tokenizer.normalizer or not plain:
            raise ValueError(f"{path} is no byte-level tokenizer without normaliser and prefix space")
        self.specials = {a.content for a in added}
        self.margin = max([1, *map(len, self.specials)])
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if added else None
        self.pattern = regex.compile(PIECE_PATTERN)
        self.beyond = regex.compile(r"[^\x00-ԯ]")
        self.memo: dict[str, int] = {}
        self.most = memo

    def pieces(self, text: str) -> list[str]:
        if self.special and any(s in text for s in self.specials):
            return [p for part in self.special.split(text) if part
                    for p in ([part] if part in self.specials else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if self.beyond.search(text):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def counts(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece; short pieces are remembered."""
        if len(self.memo) > self.most:
            self.memo.clear()
        here: dict[str, int] = {}
        new = [p for p in dict.fromkeys(pieces) if p not in self.memo]
        for piece, encoded in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            (self.memo if len(piece) <= MEMO_CHARS else here)[piece] = len(encoded)
        return [self.memo[p] if p in self.memo else here[p] for p in pieces]


def chunk_pieces(counter: PieceCounter, text: str, start: int, end: int) -> tuple[list[int], list[int]]:
    """Piece boundaries (absolute, the start included) of a chunk, and tokens up to each of them."""
    pieces = counter.pieces(text[start:end])
    bounds = list(accumulate(map(len, pieces), initial=start))
    return bounds, list(accumulate(counter.counts(pieces), initial=0))


def count_spliced(counter: PieceCounter, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP) -> int:
    """Tokens of a text by overlapping chunks."""
    n, total = len(text), 0
    start, end = 0, min(chunk, len(text))
    bounds, tokens = chunk_pieces(counter, text, start, end)
    true_from = 0  # index of the boundary from which the current chunk is known to be right
    while end < n:
        next_start, next_end = max(start + 1, end - overlap), min(n, end - overlap + chunk)
        after, after_tokens = chunk_pieces(counter, text, next_start, next_end)
        widen, at = overlap, None
        while True:
            last = bisect_left(bounds, end - counter.margin + 1) if end < n else len(bounds)
            common = set(after)
            at = next((i for i in range(last - 1, true_from - 1, -1) if bounds[i] in common and bounds[i] > next_start), None)
            if at is not None or end >= next_end:
                break
            widen *= 2
            end = min(n, end + widen)
            known = bounds[true_from]
            more, more_tokens = chunk_pieces(counter, text, known, end)
            total += tokens[true_from] - tokens[0]
            bounds, tokens, true_from = more, more_tokens, 0
        if at is None:  # the widened chunk has passed over its neighbour
            start = bounds[true_from]
            continue
        total += tokens[at] - tokens[0]
        j = bisect_left(after, bounds[at])
        start, end = next_start, next_end
        bounds, tokens, true_from = after[j:], after_tokens[j:], 0
    return total + tokens[-1] - tokens[0]


def count_tokens(docs: DataFrame, tokenizer_path: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP,
                 carry: list[str] | None = None) -> DataFrame:
    """The carried columns (default doc_id), ``n_bytes`` and ``n_tokens`` of every text. The tokenizer file must be
    readable at the same path on every executor."""
    carry = carry or ["doc_id"]
    names = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)],
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.col("text").alias("t"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "t") + ", n_tokens bigint"

    def count(batches):
        counter = PieceCounter(tokenizer_path)
        for batch in batches:
            out = []
            texts = batch.column("t")
            for i in range(len(texts)):
                text = texts[i].as_py()
                if not text:
                    out.append(0)
                elif len(text) > chunk_chars:
                    out.append(count_spliced(counter, text, chunk_chars, overlap))
                else:
                    out.append(sum(counter.counts(counter.pieces(text))))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in [*names, "n_bytes"]), pa.array(out, pa.int64())],
                                             names=[*names, "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(count, ddl)
    return counted.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], "n_bytes", "n_tokens")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
