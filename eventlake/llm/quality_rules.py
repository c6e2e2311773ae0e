"""Quality rules whose cutoffs carry a guarantee against rejecting good documents.

Every rule is a statistic of the text that is large for junk. In each stratum (language) the labelled
rows are the holdout: a cutoff qualifies if an exact binomial test shows that it rejects fewer good
documents than the rule's share of the allowed risk. The level is divided by the number of (stratum,
rule) pairs; within a pair cutoffs are tested from the laxest on and the first failure ends the
sequence, so they need no further division. All bounds hold together. Of the qualified cutoffs the
one worth most is used, the middle one of equals.
"""

from __future__ import annotations

import math
from itertools import islice, takewhile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from eventlake.llm.common import beside, on_texts, prepare_python, quoted, stored
from eventlake.operators.joins import checked_broadcast

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
RISK = 0.05               # of good documents in a stratum may be rejected, over all rules together
CONFIDENCE = 0.95
LOSS = 30                 # a good document lost weighs as much as so many poor ones caught
LEAST_WORDS, MOST_REPEATED = 10, 20   # base rule: fewer words, or more per cent in repeated windows
STEPS = 64                # cutoffs a rule chooses from
# Rules: a share between 0 and 1; cutoffs are k / STEPS.
RULES = ["symbols", "capitals", "dup_lines", "echoes", "marks"]
STATISTICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              + ", ".join(f"{r}_step int" for r in RULES))


def repeated_words(words: list) -> int:
    """Words inside a window of WINDOW words that occurs twice or more in the list."""
    n = len(words)
    if n <= WINDOW:
        return 0
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)

    def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]

    two = paired(ids[:-1], ids[1:])
    four = paired(two[:-2], two[2:])
    five = paired(four[:-1], ids[4:])
    again = np.flatnonzero(np.bincount(five)[five] > 1)
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, again, 1)
    np.add.at(marks, again + WINDOW, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple:
    """Counts of the base rules, then every rule's share as a step from 0 to STEPS."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n, chars = len(words), len(text) - sum(data.count(c) for c in SPACES_EACH)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    echoes = sum(a == b for a, b in zip(words, islice(words, 1, None)))
    letters = len(data.translate(None, NOT_LETTERS))
    shares = (symbols / max(chars, 1), len(data.translate(None, NOT_CAPITALS)) / max(letters, 1),
              dup_lines / max(len(lines), 1), echoes / max(n, 1), min(1.0, text.count("!") / max(n, 1)))
    return (n, chars, symbols, dup_lines, repeated, *(min(STEPS, math.ceil(s * STEPS)) for s in shares))


SPACES_EACH = [bytes([b]) for b in SPACES]
NOT_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)
NOT_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC3))


def chance_of_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), exactly by its terms."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    log_terms = (math.lgamma(n + 1) - np.array([math.lgamma(a + 1) + math.lgamma(n - a + 1) for a in i])
                 + i * math.log(p) + (n - i) * math.log1p(-p))
    top = log_terms.max()
    return float(min(1.0, math.exp(top) * np.exp(log_terms - top).sum()))


def _choose(level: float):
    """Cutoffs of one stratum from its counts per (rule, step)."""
    def run(counts: pd.DataFrame) -> pd.DataFrame:
        chosen = {}
        for rule, rows in counts.groupby("rule"):
            good, bad = np.zeros(STEPS + 1), np.zeros(STEPS + 1)
            good[rows["step"]], bad[rows["step"]] = rows["good"], rows["bad"]
            # a cutoff c rejects steps above c
            lost, gained = good.sum() - np.cumsum(good), bad.sum() - np.cumsum(bad)
            n, worth = int(good.sum()), gained - LOSS * lost
            sure = list(takewhile(lambda cut: n and chance_of_at_most(int(lost[cut]), n, RISK / len(RULES)) <= level,
                                  range(STEPS - 1, -1, -1)))
            best = max((worth[cut] for cut in sure), default=0)
            if best > 0:
                equal = [cut for cut in sure if worth[cut] == best]
                chosen[rule] = equal[len(equal) // 2]
        out = {"stratum": [counts["stratum"].iloc[0]]} | {f"{r}_cut": pd.array([chosen.get(r)], dtype="Int64") for r in RULES}
        return pd.DataFrame(out)

    return run


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str) -> DataFrame:
    """(stratum, one cutoff per rule or null) from all labelled rows of ``measured``.

    Labels other than 0 and 1 and contradicting ones are left out. A stratum without labels, or with
    too few good documents to prove anything, has no cutoffs, so nothing is rejected by them there.
    """
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("quality")).where("low = quality").drop("low")
    steps = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"{r}_step").alias("step")) for r in RULES]))
    counts = measured.join(marked, "doc_id").select(F.coalesce(quoted(stratum), F.lit("")).alias("stratum"), "quality", steps.alias("s"))
    counts = stored(counts.groupBy("stratum", "s.rule", "s.step").agg(
        F.sum(F.col("quality").cast("long")).alias("good"), F.sum((1 - F.col("quality")).cast("long")).alias("bad")))
    strata = counts.select("stratum").distinct().count()
    level = (1 - CONFIDENCE) / max(1, strata * len(RULES))
    schema = "stratum string, " + ", ".join(f"{r}_cut int" for r in RULES)
    return counts.groupBy("stratum").applyInPandas(_choose(level), schema)


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics of every whole text; null texts count as empty."""
    prepare_python(docs.sparkSession)
    found = on_texts(lambda texts: [statistics(t) for t in texts], STATISTICS)
    names = [part.split()[0] for part in STATISTICS.split(", ")]
    return beside(docs, found(F.col("text")), names)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """(doc_id, statistics, base_failed, failed_rules, kept), one row per document.

    ``base_failed``: fewer than LEAST_WORDS words, or over MOST_REPEATED per cent of them in repeated
    windows. ``failed_rules`` lists the rules above their stratum's cutoff. Null strata are one
    stratum, repeated rows stay repeated, an empty table gives an empty result, and columns other
    than doc_id, text and the stratum are not read.
    """
    measured = stored(measure(docs.select("doc_id", "text", quoted(stratum).cast("string").alias("stratum"))).drop("text"))
    cuts = checked_broadcast(stored(cutoffs(measured, labels, "stratum")).withColumnRenamed("stratum", "stratum_"))
    joined = measured.join(cuts, F.coalesce("stratum", F.lit("")) == F.col("stratum_"), "left")
    failed = F.array_compact(F.array(*[F.when(F.col(f"{r}_step") > F.col(f"{r}_cut"), F.lit(r)) for r in RULES]))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), failed.alias("failed_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
