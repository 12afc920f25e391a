"""Quality rules as a learned decision list, in DataFrame operations alone.

Statistics of each text come from array expressions in one scan. Labelled rows are cut into bins at quantiles of
each statistic; sequential covering then grows a rule by adding the threshold that gains most on the growing fold,
prunes it to the prefix of conditions that is best on the pruning fold, keeps it if its precision there is high
enough, removes the rows it covers, and goes on. Each step is one grouped count over the labelled rows that are left; the
driver sees the counts per (fold, statistic, bin, label), a number of rows fixed by parameters. The list is applied as one
ordered CASE expression: the first rule that fires rejects, otherwise the text is kept.

Defined results: a null or empty text has no words, fails the base rule and is rejected. Labels of unknown
documents and null labels are ignored; without labels there are no rules and only the base rule rejects. Repeated rows
are judged each and repeated labels count each. Extra columns are ignored, or kept where whole documents are returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import SPACE_CLASS, WORD_CLASS, staged, table

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
BINS = 24
MAX_RULES = 10
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVER = 5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words lying in windows that occur twice or more."""
    n = F.size(words)

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))

    def covered(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        repeated = F.filter(ordered, lambda s, i: ((i > 0) & (F.get(ordered, F.greatest(i - 1, F.lit(0)))["h"] == s["h"]))
                            | ((i < last) & (F.get(ordered, F.least(i + 1, last))["h"] == s["h"])))
        return _bound(F.array_sort(F.transform(repeated, lambda s: s["i"])), lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.when(k == 0, F.lit(window)).otherwise(
                F.least(F.lit(window), p - F.get(at, F.greatest(k - 1, F.lit(0)))))),
            F.lit(0).cast("long"), lambda a, x: a + x))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            _bound(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered))

    return F.when(n < window + 1, F.lit(0).cast("long")).otherwise(_bound(hashes(words), count))


def text_statistics(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """The kept columns and the statistics of ``text``: counts, and the shares the rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CLASS))
    rows = docs.select(*keep, text.alias("_t"), F.array_remove(F.split(text, SPACE_CLASS), "").alias("_w"), lines.alias("_l"))
    names = [c for c in rows.columns if c not in ("_t", "_w", "_l")]
    t, w = F.col("_t"), F.col("_w")
    length = F.char_length(t)
    rows = rows.select(
        *[F.col(f"`{c}`") for c in names],
        F.size(w).cast("long").alias("_n"), F.size(F.array_distinct(w)).alias("_distinct"),
        _without(t, " \t\n\x0b\x0c\r").cast("long").alias("_chars"),
        (length - _without(t, "#*$%&|<>")).cast("long").alias("_symbols"),
        (length - _without(t, _UPPER)).alias("_upper"), (length - _without(t, "!?")).alias("_calls"),
        (length - _without(t, "0123456789")).alias("_digits"), (length - _without(t, ".")).alias("_stops"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("_dup"), F.size("_l").alias("_lines"),
        repeated_words(w).alias("_repeat"))
    per_word = F.greatest(F.col("_n"), F.lit(1))
    per_char = F.greatest(F.col("_chars"), F.lit(1))
    return rows.withColumns({
        "_f_words": F.col("_n").cast("double"), "_f_word_length": F.col("_chars") / per_word,
        "_f_symbols": F.col("_symbols") / per_word, "_f_upper": F.col("_upper") / per_char,
        "_f_calls": F.col("_calls") / per_word, "_f_digits": F.col("_digits") / per_char,
        "_f_stops": F.col("_stops") / per_word, "_f_distinct": F.col("_distinct") / per_word,
        "_f_dup_lines": F.col("_dup") / F.greatest(F.col("_lines"), F.lit(1)), "_f_repeat": F.col("_repeat") / per_word,
    })


FEATURES = ["_f_words", "_f_word_length", "_f_symbols", "_f_upper", "_f_calls", "_f_digits", "_f_stops", "_f_distinct",
            "_f_dup_lines", "_f_repeat"]


def base_failed() -> Column:
    return (F.col("_n") < MIN_WORDS) | (F.col("_repeat") * 100 > F.col("_n") * MAX_REPEAT_PERCENT)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        col = F.col(self.feature)
        return col > self.threshold if self.above else col <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature[3:]} {'>' if self.above else '<='} {self.threshold:.4g}"


Rule = tuple[Condition, ...]


def rule_column(rule: Rule) -> Column:
    out = rule[0].column()
    for condition in rule[1:]:
        out = out & condition.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered expression: True keeps."""
    out = F.when(F.lit(False), F.lit(True))
    for rule in rules:
        out = out.when(rule_column(rule), F.lit(False))
    return out.otherwise(F.lit(True))


def learn_rules(labelled: DataFrame, bins: int = BINS, max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS,
                min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> list[Rule]:
    """``labelled`` has the statistics, ``bad`` (0/1) and ``fold`` (0, 1 grow; 2 prune)."""
    quantiles = [F.percentile_approx(f, [i / bins for i in range(1, bins)], 1000).alias(f) for f in FEATURES]
    # Quantiles of either label, so that a rare kind of bad text gets thresholds of its own.
    cuts = {f: set() for f in FEATURES}
    for row in labelled.groupBy("bad").agg(*quantiles).collect():
        for f in FEATURES:
            cuts[f] |= set(row[f] or [])
    # Thresholds lie midway between neighbouring quantiles, clear of the values on both sides.
    edges = {f: [(a + b) / 2 for a, b in pairwise(sorted(v))] for f, v in cuts.items()}
    if not any(edges.values()):
        return []

    def bin_of(f: str) -> Column:
        value = F.col(f)
        return F.size(F.filter(F.array(*map(F.lit, edges[f])), lambda edge: edge < value))

    binned = F.explode(F.array(*[F.struct(F.lit(k).alias("f"), bin_of(f).alias("b"))
                                 for k, f in enumerate(FEATURES) if edges[f]]))

    def counts(rows: DataFrame) -> dict:
        got = rows.select((F.col("fold") == 2).alias("p"), "bad", binned.alias("x")).groupBy("p", "bad", "x.f", "x.b").count().collect()
        table_: dict = {}
        for r in got:
            table_.setdefault((r["f"], r["p"]), {}).setdefault(r["b"], [0, 0])[r["bad"]] += r["count"]
        return table_

    def options(table_: dict):
        """Each condition with [good, bad] on the growing and the pruning fold."""
        for k, f in enumerate(FEATURES):
            for i, edge in enumerate(edges[f]):
                for above in (False, True):
                    sums = [[sum(v[y] for b, v in table_.get((k, p), {}).items() if (b > i) == above) for y in (0, 1)]
                            for p in (False, True)]
                    yield Condition(f, above, edge), sums[0], sums[1]

    rules: list[Rule] = []
    left = labelled
    while len(rules) < max_rules:
        rows, grown = left, []
        while len(grown) < max_conditions:
            table_ = counts(rows)
            totals = [sum(v[y] for v in next(iter([t for (_, p), t in table_.items() if not p]), {}).values()) for y in (0, 1)]
            if totals[1] < min_cover or (grown and totals[0] == 0):
                break
            have = totals[1] / sum(totals)

            def gain(option) -> float:
                good, bad = option[1]
                return bad * ((bad + 1) / (good + bad + 2) - have) if bad >= min_cover else -1.0

            best = max(options(table_), key=gain)
            if gain(best) <= 0:
                break
            grown.append(best)
            rows = rows.where(best[0].column())
        if not grown:
            break

        def worth(n: int) -> float:
            good, bad = grown[n - 1][2]
            return (bad - good) / (good + bad + 1)

        size = max(range(1, len(grown) + 1), key=lambda n: (worth(n), -n))
        good, bad = grown[size - 1][2]
        rule = tuple(g[0] for g in grown[:size])
        if bad + good == 0 or bad / (bad + good) < min_precision:
            break
        rules.append(rule)
        left = left.where(~rule_column(rule))
    return rules


def learned_rules(statistics: DataFrame, labels: DataFrame, doc_id: str) -> list[Rule]:
    """Rules from the statistics of labelled documents that pass the base rule."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_label_id"), (1 - F.col("quality")).cast("int").alias("bad"))
    rows = statistics.where(~base_failed()).join(known, F.col(doc_id) == F.col("_label_id"))
    return learn_rules(staged(rows.select(*FEATURES, "bad", (F.abs(F.xxhash64("_label_id")) % 3).alias("fold")), "quality-labelled"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = staged(text_statistics(table(spark, sf_dir, "documents"), [F.col("doc_id").alias("_id")]), "quality")
    rules = learned_rules(statistics, table(spark, sf_dir, "labels"), "_id")
    return statistics.select(
        F.col("_id").alias("doc_id"), F.col("_n").alias("n_words"), F.col("_chars").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"), F.col("_dup").alias("n_dup_lines"), F.col("_repeat").alias("n_repeat_words"),
        base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: documents that the rules keep, with all their columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    # Written once: the rules read its narrow columns, and the filter doesn't compute the statistics again.
    judged = staged(text_statistics(docs, [whole]), "quality")
    rules = learned_rules(judged.withColumn("_id", F.col("_doc.doc_id")), labels, "_id")
    return judged.where(~base_failed() & verdict(rules)).select("_doc.*")
