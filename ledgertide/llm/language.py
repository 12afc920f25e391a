"""Language of web pages by Bayesian fusion of evidence.

Four kinds of evidence are combined per page: the likelihood of its main text under byte-trigram models that grouped
counts over all labelled documents give; the likelihood of the declared markup language; that of the address's top-level
suffix; and a prior of the host, smoothed towards its domain's, which is smoothed towards the whole corpus.
The tables for the last three are grouped sums of the text posteriors over all pages; a page's own share is
taken out before its host's prior is used, so no page votes for itself.

Trigrams overlap, so their log-likelihood is scaled to at most ``evidence`` independent trigrams. The number of
languages and trigram buckets is fixed by the labels and a parameter; the model is a table of that size.

Defined results: a page without text, declared language and address gets the corpus prior. Documents with null text or language
are not learned from. Without labelled documents the language is null. Repeated rows count each. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import staged, table
from ledgertide.llm.site_style import host_of, main_text, read_page

BUCKETS = 1 << 14
EVIDENCE = 40.0
STRENGTH = 5.0
_DECLARED = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([a-zA-Z]{2,3})""", re.I)


def trigram_buckets(text: bytes, buckets: int) -> np.ndarray:
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    return (((data[:-2] * 65599 + data[1:-1]) * 65599 + data[2:]) * np.uint32(2654435761) >> np.uint32(8)).astype(np.int64) % buckets


def trigram_model(docs: DataFrame, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probability of each bucket, counted over all documents with text and language."""
    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                found = np.bincount(trigram_buckets(text.as_py().lower().encode(), buckets), minlength=buckets)
                sums[lang] = sums[lang] + found if lang in sums else found
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bucket": at.astype(np.int32), "n": found[at]})

    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counted = rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counted.column("lang").to_pylist()))
    out = np.full((len(langs), buckets), 0.5)
    if langs:
        out[np.searchsorted(langs, counted.column("lang").to_pylist()), counted.column("bucket").to_numpy()] += counted.column("n").to_numpy()
    return langs, np.log(out / out.sum(axis=1, keepdims=True)) if langs else out


def page_evidence(pages: DataFrame, langs: list[str], model: np.ndarray, evidence: float) -> DataFrame:
    """Per page: ``page_id, host, declared`` and ``ll``, the scaled log-likelihood of its text per language."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def read(batches):
        table_, buckets = shared.value, shared.value.shape[1]
        for batch in batches:
            declared, scores = [], []
            for source in batch.column("html"):
                html = source.as_py() or ""
                found = _DECLARED.search(html)
                declared.append(found.group(1).lower() if found else None)
                at = trigram_buckets(main_text(read_page(html), {}).lower().encode("utf-8", "replace"), buckets)
                total = table_[:, at].sum(axis=1) * min(1.0, evidence / max(1, len(at)))
                scores.append((total - total.max()).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), pa.array(declared, pa.string()),
                                              pa.array(scores, pa.list_(pa.float64()))], names=["page_id", "host", "declared", "ll"])

    kind = dict(pages.dtypes)["page_id"]
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), "html")
    return rows.mapInArrow(read, f"page_id {kind}, host string, declared string, ll array<double>")


def _softmax(log: Column) -> Column:
    weights = F.transform(log, lambda x: F.exp(x - F.array_max(log)))
    return F.get(F.transform(F.array(weights), lambda w: F.transform(w, lambda x: x / F.aggregate(w, F.lit(0.0), lambda a, b: a + b))), F.lit(0))


def identify(pages: DataFrame, docs: DataFrame, buckets: int = BUCKETS, evidence: float = EVIDENCE,
             strength: float = STRENGTH) -> DataFrame:
    """``page_id, host, declared, text_language, language, probability`` of every page."""
    langs, model = trigram_model(docs, buckets)
    if not langs:
        return pages.select("page_id", host_of(F.col("url")).alias("host"), *[
            F.lit(None).cast(t).alias(c) for c, t in (("declared", "string"), ("text_language", "string"), ("language", "string"), ("probability", "double"))])
    n = len(langs)
    rows = staged(page_evidence(pages, langs, model, evidence), "language-evidence")
    domain = F.concat_ws(".", F.slice(F.split("host", r"\."), F.greatest(F.size(F.split("host", r"\.")) - 2, F.lit(1)), 3))
    rows = rows.withColumns({"post": _softmax(F.col("ll")), "domain": domain, "suffix": F.substring_index("host", ".", -1)})

    def sums(*keys: str) -> DataFrame:
        """Posterior mass per language and key."""
        return rows.groupBy(*keys).agg(F.array(*[F.sum(F.get("post", F.lit(i))) for i in range(n)]).alias("mass"))

    def total(mass: Column) -> Column:
        return F.aggregate(mass, F.lit(0.0), lambda a, x: a + x)

    everything = F.broadcast(rows.groupBy().agg(F.array(*[F.coalesce(F.sum(F.get("post", F.lit(i))), F.lit(0.0)) for i in range(n)]).alias("all_mass")))
    hosts = sums("host", "domain").withColumnRenamed("mass", "host_mass")
    domains = hosts.groupBy("domain").agg(F.array(*[F.sum(F.get("host_mass", F.lit(i))) for i in range(n)]).alias("domain_mass"))
    hosts = hosts.join(domains, "domain").drop("domain")

    def likelihood(key: str, name: str) -> DataFrame:
        """Share of each language's mass that has this key: P(key | language), smoothed by one half."""
        per = sums(key).where(F.col(key).isNotNull()).crossJoin(everything)
        log = F.transform("mass", lambda x, i: F.ln((x + 0.5) / (F.get("all_mass", i) + 1.0)))
        return per.select(F.col(key), log.alias(name))

    fused = (rows.join(hosts, "host").join(likelihood("declared", "declared_log"), "declared", "left")
             .join(likelihood("suffix", "suffix_log"), "suffix", "left").crossJoin(everything))

    def prior(i: Column, own: Column) -> Column:
        top = (F.get("all_mass", i) - own + 1.0) / (total(F.col("all_mass")) - 1 + n)
        middle = (F.get("domain_mass", i) - own + strength * top) / (total(F.col("domain_mass")) - 1 + strength)
        return (F.get("host_mass", i) - own + strength * middle) / (total(F.col("host_mass")) - 1 + strength)

    none = F.array(*[F.lit(0.0)] * n)
    score = F.transform("post", lambda own, i: F.get("ll", i) + F.ln(F.greatest(prior(i, own), F.lit(1e-9)))
                        + F.get(F.coalesce("declared_log", none), i) + F.get(F.coalesce("suffix_log", none), i))
    names = F.array(*map(F.lit, langs))

    def best(column: str) -> Column:
        return F.get(names, (F.array_position(column, F.array_max(column)) - 1).cast("int"))

    # Sums of doubles may differ in the last places from run to run: rounding settles ties the same way.
    fused = fused.withColumn("score", F.transform(score, lambda x: F.round(x, 6)))
    fused = fused.withColumn("final", _softmax(F.col("score")))
    return fused.select("page_id", "host", "declared", best("ll").alias("text_language"), best("score").alias("language"),
                        F.round(F.array_max("final"), 6).alias("probability"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
