"""Quality rules whose cutoffs carry a guarantee: few good documents are rejected in any stratum.

Every document gets a score for each rule (a share between 0 and 1, high is bad). For each
stratum and rule, cutoffs of a fixed grid are tested on the labelled good documents: a cutoff
is *certified* if the exact binomial test rejects "the false-rejection rate is above the
budget", at a level divided by the number of tests (Bonferroni over strata, rules and
cutoffs), so all certified cutoffs hold at once with probability ``1 - delta``. Of the
certified cutoffs the one is taken that separates bad from good best; without one the rule is
off in that stratum. The budget ``alpha`` of a stratum is shared by its rules.

Only counts by (stratum, rule, cutoff, quality) reach the driver: their number is fixed by the
parameters, not by the data.

Defined results: null text counts as empty and is rejected (fewer than 10 words); a null or
unknown stratum value counts as "other"; repeated rows give one row each, and repeated labels
of one id count once (the worst); labels with null values are ignored; without labels only
the base rule decides; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, add_columns, map_texts, stored, table, texts

STRATA = ("en", "de", "fr", "es")
RULES = ("symbols", "shouting", "exclamation", "repeated_lines", "repeated_words")
#: The least cutoff lets a stray symbol in a short text pass, whatever the labels say.
CUTOFFS = tuple(i / 40 for i in range(1, 40))
#: False rejections allowed in a stratum, chance that any bound fails, and good documents that one bad document is worth.
ALPHA, DELTA, COST = 0.05, 0.05, 10.0
SYMBOLS = "#*$%&|<>"
BASE = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
MEASURED = BASE + ", n_upper bigint, n_exclaim bigint, n_lines bigint"
WINDOW = 5
_UPPER = bytes(range(65, 91))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five that occur at least twice, the first occurrence included."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, total = 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            total += start + WINDOW - max(start, covered)
            covered = start + WINDOW
    return total


def measure(doc_id: int | None, text: str) -> tuple:
    raw = text.encode()
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        doc_id,
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(raw) - len(raw.translate(None, _UPPER)),
        text.count("!"),
        len(lines),
    )


def scores() -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.least(F.lit(1.0), F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    return {
        "symbols": share("n_symbols", "word_chars"),
        "shouting": share("n_upper", "word_chars"),
        "exclamation": share("n_exclaim", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
    }


def binomial_below(k: int, n: int, rate: float) -> float:
    """P(X <= k) of a binomial X, exactly: the regularised incomplete beta function by continued fraction."""
    if k >= n:
        return 1.0
    return _beta(1 - rate, n - k, k + 1)


def _beta(x: float, a: float, b: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1 - front * _fraction(1 - x, b, a) / b
    return front * _fraction(x, a, b) / a


def _fraction(x: float, a: float, b: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    value = d
    for m in range(1, 5000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + term * d or tiny)
            c = 1 + term / c or tiny
            value *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return value


def choose(counts: dict[tuple[str, str, int, int], int], strata: tuple[str, ...], rules: tuple[str, ...] = RULES, cutoffs: tuple[float, ...] = CUTOFFS, alpha: float = ALPHA, delta: float = DELTA) -> dict[tuple[str, str], float]:
    """The cutoff of each (stratum, rule) that has a certified one.

    ``counts[stratum, rule, level, quality]``: labelled documents whose score exceeds exactly ``level`` cutoffs.
    """
    level_of_test, budget = delta / (len(strata) * len(rules) * len(cutoffs)), alpha / len(rules)
    chosen = {}
    for stratum in strata:
        for rule in rules:
            good, bad = ([counts.get((stratum, rule, level, q), 0) for level in range(len(cutoffs) + 1)] for q in (1, 0))
            best = 0.0
            for i, cutoff in reversed(list(enumerate(cutoffs))):
                lost, caught = sum(good[i + 1 :]), sum(bad[i + 1 :])
                if binomial_below(lost, sum(good), budget) > level_of_test:
                    continue
                gain = caught / max(1, sum(bad)) - COST * lost / max(1, sum(good))
                if gain > best:
                    best, chosen[stratum, rule] = gain, cutoff
    return chosen


def measured(df: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts of each document with its stratum."""
    known = F.when(F.col(stratum).isin(*STRATA), F.col(stratum)).otherwise("other")
    return map_texts(texts(df, also={"stratum": known}), measure, MEASURED + ", stratum string", carried=1)


def labelled_counts(rows: DataFrame, labels: DataFrame) -> dict[tuple[str, str, int, int], int]:
    quality = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    quality = quality.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    passed = {rule: sum(((score > cutoff).cast("int") for cutoff in CUTOFFS), F.lit(0)) for rule, score in scores().items()}
    levels = [F.struct(F.lit(rule).alias("rule"), level.alias("level")) for rule, level in passed.items()]
    counted = rows.where(~base_failed()).join(quality, "doc_id").select("stratum", "quality", F.explode(F.array(*levels)).alias("x"))
    counted = counted.groupBy("stratum", "x.rule", "x.level", "quality").count()
    return {(r["stratum"], r["rule"], r["level"], r["quality"]): r["count"] for r in counted.collect()}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def verdicts(rows: DataFrame, cutoffs: dict[tuple[str, str], float]) -> DataFrame:
    """Add ``base_failed``, the failed rules, and ``kept``."""
    failed = []
    for rule, score in scores().items():
        over = [(F.col("stratum") == stratum) & (score > cutoff) for (stratum, r), cutoff in cutoffs.items() if r == rule]
        for test in over:
            failed.append(F.when(test, F.lit(rule)))
    names = F.filter(F.array(*failed), lambda x: x.isNotNull()) if failed else F.array().cast("array<string>")
    rows = rows.withColumn("base_failed", base_failed()).withColumn("failed_rules", names)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts, failed rules and verdict of every document."""
    rows = stored(measured(docs, stratum), "quality")
    return verdicts(rows, choose(labelled_counts(rows, labels), (*STRATA, "other")))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that pass, with all their columns. The cutoffs come first; then each row is judged where it is."""
    cutoffs = choose(labelled_counts(stored(measured(docs, stratum), "quality"), labels), (*STRATA, "other"))
    known = F.when(F.col(stratum).isin(*STRATA), F.col(stratum)).otherwise("other")
    rows, names = add_columns(docs, lambda text: measure(None, text)[1:], MEASURED.split(", ", 1)[1])
    counts = F.struct(*[F.col(made).alias(name) for name, made in names.items()], known.alias("stratum"))
    packed = rows.select(F.struct(*docs.columns).alias("document"), counts.alias("counts")).select("document", "counts.*")
    return verdicts(packed, cutoffs).where("kept").select("document.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(*[c.split()[0] for c in BASE.split(", ")], "base_failed", "kept")
