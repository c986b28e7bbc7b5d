"""Quality rules learned as decision lists, in DataFrame functions only.

Statistics of each text are DataFrame expressions. From the labelled texts a list of rules is learned by sequential
covering: a rule is a conjunction of thresholds on the statistics, grown one threshold at a time by the gain in
information on two thirds of the labelled texts, pruned from its end while that makes it no worse on the other third,
and added to the list if it is precise enough there; the texts it covers are then set aside and the next rule is
learned. The list becomes one ordered conditional expression: the first rule that covers a text names the reason for
which the text is rejected, and a text that no rule covers is kept.

Thresholds are the quantiles of a statistic over all labelled texts. Each step of the search is one aggregation over the
stored statistics of the labelled texts, whose result has one row whatever their number.

Cases: a null text has no words; labels that are null or name no text are not used; without labels of both kinds
the list is empty and the fixed limits alone decide; a repeated id joins each of its labels; very long texts are handled
within one row; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OTHER_ID, OTHER_ROW, ROW, id_remainder, stored

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
QUANTILES = 16
MAX_RULES = 8
MAX_TERMS = 4
MIN_PRECISION = 0.97
SEPARATORS = "[ \\t-\\r]+"

# The statistics that rules may test, all per text.
FEATURES = ("n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "digit_rate", "bang_rate",
            "bar_rate", "mean_line_words", "distinct_rate")


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_upper, n_digits,
    n_bangs, n_bars, n_lines, n_distinct of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(*keep, text.alias("text"))
    df = df.select(*keep, "text", F.array_remove(F.split("text", SEPARATORS), "").alias("_words"),
                   F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("_lines"))
    # one hash for each word; a window is the hash of its words' hashes
    df = df.withColumn("_word_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_words")
    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_word_hashes", i, WINDOW)))
    df = df.withColumn("_windows", F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    # most texts repeat no window; the others are sorted
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.when(repeats, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_ordered", ordered)
    m = F.size("_ordered")

    def repeated(x: Column, at: Column) -> Column:
        before = (at > 0) & (F.get("_ordered", at - 1)["h"] == x["h"])
        after = (at < m - 1) & (F.get("_ordered", at + 1)["h"] == x["h"])
        return before | after

    starts = F.array_sort(F.transform(F.filter("_ordered", repeated), lambda x: x["i"]))
    df = df.withColumn("_starts", F.when(repeats, starts))
    covered = F.aggregate("_starts", F.struct(F.lit(0).cast("long").alias("total"), F.lit(-WINDOW).alias("last")),
                          lambda acc, i: F.struct((acc["total"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("total"), i.alias("last")),
                          lambda acc: acc["total"])
    return df.select(
        *keep, n.cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_bangs"),
        F.regexp_count("text", F.lit("[|]")).cast("long").alias("n_bars"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_word_hashes")).cast("long").alias("n_distinct"))


def features() -> dict[str, Column]:
    """The statistics that rules may test, from the counts."""
    rate = lambda top, of: F.when(F.col(of) > 0, F.col(top) / F.col(of)).otherwise(F.lit(0.0))
    return {"n_words": F.col("n_words").cast("double"), "mean_word": rate("word_chars", "n_words"), "symbol_rate": rate("n_symbols", "n_words"),
            "dup_line_rate": rate("n_dup_lines", "n_lines"), "repeat_rate": rate("n_repeat_words", "n_words"), "upper_rate": rate("n_upper", "word_chars"),
            "digit_rate": rate("n_digits", "word_chars"), "bang_rate": rate("n_bangs", "n_words"), "bar_rate": rate("n_bars", "n_words"),
            "mean_line_words": rate("n_words", "n_lines"), "distinct_rate": rate("n_distinct", "n_words")}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Term, ...]


def covers(rule: Rule) -> Column:
    out = F.lit(True)
    for term in rule:
        out = out & term.column()
    return out


def reason(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional expression: the text of the first rule that covers a row, or null."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(covers(rule), F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def _gain(bad: float, good: float, bad0: float, good0: float) -> float:
    """Information gain of narrowing (bad0, good0) to (bad, good), as in FOIL."""
    if not bad:
        return -math.inf
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def learn(labelled: DataFrame) -> list[Rule]:
    """Rules for rejection from rows with the features, `bad` (boolean) and `grow` (boolean: grow on it, else prune)."""
    def tally(columns: list[Column], part: Column, rules: list[Rule]) -> list[tuple[float, float]]:
        """(bad, good) rows under each condition, among the rows of `part` that no rule covers."""
        rows = labelled.where(part & reason(rules).isNull())
        one = rows.agg(*(F.count_if(c & (F.col("bad") == want)) for c in columns for want in (True, False))).first()
        return list(zip(one[::2], one[1::2]))

    steps = [k / QUANTILES for k in range(1, QUANTILES)] + [0.98, 0.99, 0.995]
    by_feature = labelled.agg(*(F.percentile_approx(f, F.array(*map(F.lit, steps)), 10000) for f in FEATURES)).first()
    terms = [Term(f, above, float(t)) for f, ts in zip(FEATURES, by_feature) for t in sorted(set(ts or [])) for above in (True, False)]
    grow, prune, rules = F.col("grow"), ~F.col("grow"), []
    if not terms:
        return rules
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        bad0, good0 = tally([F.lit(True)], grow, rules)[0]
        while bad0 and good0 and len(rule) < MAX_TERMS:
            found = tally([covers((*rule, t)) for t in terms], grow, rules)
            best = max(range(len(terms)), key=lambda k: _gain(*found[k], bad0, good0))
            if _gain(*found[best], bad0, good0) <= 0:
                break
            rule = (*rule, terms[best])
            bad0, good0 = found[best]
        if not rule:
            break
        value = lambda bad, good: (bad - good) / (bad + good) if bad + good else -1.0
        pruned = tally([covers(rule[:k]) for k in range(1, len(rule) + 1)], prune, rules)
        best = max(range(len(rule)), key=lambda k: (value(*pruned[k]), -k))
        bad, good = pruned[best]
        if not bad or bad / (bad + good) < MIN_PRECISION:
            break
        rules.append(rule[:best + 1])
    return rules


def judge(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` (doc_id first) and the statistics of each text with base_failed, reason (of the learned rule
    that rejects it, or null) and kept. labels: doc_id and quality (1 good, 0 bad)."""
    counts = stored(statistics(docs, keep), "statistics")
    rows = counts.select("*", *(c.alias(f) for f, c in features().items() if f != "n_words"))
    labels = labels.where("quality in (0, 1)").select(F.col("doc_id").alias(OTHER_ID), (F.col("quality") == 0).alias("bad"))
    sample = rows.where(~base_failed()).join(labels, F.col("doc_id") == F.col(OTHER_ID))
    sample = stored(sample.select(*FEATURES, "bad", (id_remainder("doc_id", 3) != 0).alias("grow")), "labelled")
    judged = rows.withColumn("base_failed", base_failed()).withColumn("reason", reason(learn(sample)))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("reason").isNull())


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with all their columns. Rows are told apart by id and text."""
    keyed = docs.withColumn(ROW, F.xxhash64("doc_id", "text"))
    kept = judge(keyed.select("doc_id", ROW, "text"), labels, ("doc_id", ROW)).where("kept").select(F.col("doc_id").alias(OTHER_ID), F.col(ROW).alias(OTHER_ROW))
    return keyed.join(kept, keyed["doc_id"].eqNullSafe(kept[OTHER_ID]) & (keyed[ROW] == kept[OTHER_ROW]), "left_semi").drop(ROW)
