"""From raw documents to training shards: quality rules, near copies, contamination, mixing, sharding.

``STAGES`` holds the stages in order. Each takes the documents its predecessor kept, as written and read again,
and all but the last return documents with the columns they came with. ``run`` applies them to a dataset's documents.

Each stage judges every row of its input, nulls, empty texts and repeated rows included, as its operator's
docstring states; an empty table passes through all stages; further columns of the documents stay with them, and the
last stage returns them beside its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import is_table, recorded, release, row_keys, staged, table
from ledgertide.llm.decontaminate import without_contaminated
from ledgertide.llm.jaccard_join import one_of_each_group
from ledgertide.llm.mixing import mixed_documents
from ledgertide.llm.quality_rules import good_documents
from ledgertide.llm.sharding import shard, written_order

NEW = ["size", "text_crc32", "home", "shard", "slot"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more; the smallest id stays."""
    return one_of_each_group(docs, shingle=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth or more of their words inside benchmark windows."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its shard and its slot there, in training order: slots follow the order in which the mix was
    written. A column of the documents that has the name of a new one comes back with ``document_`` before it. Shards are
    found for row keys alone; the documents meet them once."""
    docs = docs if is_table(docs) else staged(docs, "shard-documents")
    taken = {c.lower() for c in docs.columns}
    names = {}
    for c in docs.columns:
        names[c] = c
        while names[c].lower() in NEW or (names[c] != c and names[c].lower() in taken):
            names[c] = "document_" + names[c]
    order = ["__part", "__file", "__row"]
    found = shard(written_order(docs), carry=["__file", "__row"], order=order)
    whole = docs.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]).alias("__columns"), *row_keys(docs))
    return found.join(whole, ["__file", "__row"]).select("__columns.*", *NEW)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: dict[str, list[str]] = {}  # by dataset: what the stage before has staged and its result still reads


def tidy(stage: Stage, first: bool = False) -> Stage:
    """The stage, which deletes what the stage before it staged: that one's result is written by now, or its documents
    could not be read. The first stage follows none; what the last stage of an earlier run staged may still be wanted."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = _left.pop(sf_dir, [])
        release(spark, [] if first else before)
        with recorded() as folders:
            out = stage(spark, docs, sf_dir)
        _left[sf_dir] = folders
        return out
    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", tidy(quality, first=True)),
    ("n-gram Jaccard join", tidy(near_copies)),
    ("benchmark decontamination", tidy(decontaminated)),
    ("mixing", tidy(mixed)),
    ("sharding", tidy(sharded)),
]

# The first stage learns its rules from labels by repeated covering, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
