"""Quality rules with risk-controlled cutoffs.

Rules compare a feature of the text with a cutoff: a multiple of a floor that is fixed in
advance. The multiples form a nested family from very lenient to the floors themselves. The
labelled good documents of a stratum, none of which has shaped the family, are its holdout:
level by level, each by an exact binomial (Clopper-Pearson) upper bound on the share of
good documents that the rules reject, the stratum gets stricter until a level fails.

Over strata the confidence is shared out: every stratum that is not through with its
levels tests with delta divided by the number of such strata. One that has passed its last
level hands its share to the others, which then test their level again (a sequentially
rejective graph: levels in a row, the last one linked to the other strata). So with
probability 1 - delta no stratum loses more than alpha of its good documents, whatever the
sizes of the strata. A stratum that cannot certify any level keeps its rules off; all tests
are listed with their counts and bounds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.session import materialize as materialize

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_distinct", "n_top", "n_letters", "n_upper", "n_chars")
FEATURES = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS + EXTRA])

# rule: (numerator, denominator, side, the cutoff is never tighter than this)
RULES = {
    "symbols": ("n_symbols", "n_words", "high", 0.05),
    "duplicate_lines": ("n_dup_lines", "n_lines", "high", 0.3),
    "repeated_words": ("n_repeat_words", "n_words", "high", 0.2),
    "long_words": ("word_chars", "n_words", "high", 6.5),
    "short_words": ("word_chars", "n_words", "low", 4.0),
    "few_distinct": ("n_distinct", "n_words", "low", 0.4),
    "top_word": ("n_top", "n_words", "high", 0.2),
    "few_letters": ("n_letters", "n_chars", "low", 0.7),
    "capitals": ("n_upper", "n_letters", "high", 0.3),
}
# lenient to strict: how many times the floor a cutoff is
MULTIPLES = (8.0, 4.0, 2.0, 1.5, 1.25, 1.0)

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
NOT_ASCII = bytes(range(128, 256))
LETTERS = UPPER + bytes(range(97, 123))


def text_features(text: str | None) -> tuple[int, ...]:
    """COUNTS and EXTRA of one text; all zero for a null or empty one.

    Words are runs without ASCII white space. Letters are A-Z, a-z and every character
    outside ASCII; capitals are A-Z.
    """
    if not text:
        return (0,) * (len(COUNTS) + len(EXTRA))
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    repeated = 0
    if n >= 3:
        pair = codes[:-2] * len(ids) + codes[1:-1]
        if len(ids) > 2_000_000:
            pair = np.unique(pair, return_inverse=True)[1]
        _, inverse, times = np.unique(pair * len(ids) + codes[2:], return_inverse=True, return_counts=True)
        hit = times[inverse] > 1
        mark = np.zeros(n, bool)
        for shift in range(3):
            mark[shift : n - 2 + shift] |= hit
        repeated = int(mark.sum())
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    white = len(raw) - len(raw.translate(None, WHITE))
    outside = len(text) - len(raw.translate(None, NOT_ASCII))
    return (
        n, len(text) - white, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated,
        len(lines), len(ids), int(np.bincount(codes).max()) if n else 0,
        len(raw) - len(raw.translate(None, LETTERS)) + outside, len(raw) - len(raw.translate(None, UPPER)),
        len(text) - white,
    )


@F.pandas_udf(FEATURES)
def _features(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_features(t) for t in text], columns=FEATURES.names)


def with_features(docs: DataFrame, text_col: str = "text", out: str = "features") -> DataFrame:
    """``docs`` with a struct of counts over each whole text (all zero for null and empty)."""
    return docs.withColumn(out, _features(F.col(text_col)))


def base_failed(f: str = "features") -> Column:
    """Too few words, or more than half of them in repeated three-word windows."""
    return (F.col(f"{f}.n_words") < 50) | (100 * F.col(f"{f}.n_repeat_words") > 50 * F.col(f"{f}.n_words"))


def upper_bound(k: int, n: int, delta: float) -> float:
    """Exact binomial (Clopper-Pearson) upper bound: the rate p with P(X <= k; n, p) = delta."""
    if n == 0 or k >= n:
        return 1.0
    # far below k the terms fall at least like a geometric series and no longer count
    least = max(0, k - 100 - int(12 * math.sqrt(k + 1)) - 4000)
    terms = [(i, math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)) for i in range(least, k + 1)]

    def below(p: float) -> float:
        logs = [t + i * math.log(p) + (n - i) * math.log1p(-p) for i, t in terms]
        top = max(logs)
        return math.exp(top) * sum(math.exp(x - top) for x in logs)

    low, high = k / n, 1.0
    for _ in range(100):
        mid = (low + high) / 2
        if mid in (0.0, 1.0):
            break
        low, high = (mid, high) if below(mid) > delta else (low, mid)
    return high


@dataclass
class Rules:
    """Cutoffs per stratum (None: rules off) and what certified them."""

    cutoffs: dict[str | None, dict[str, float] | None] = field(default_factory=dict)
    certificates: list[dict] = field(default_factory=list)

    def report(self) -> list[tuple[str | None, float | None, int, int, float]]:
        """Per stratum: multiple of the floors (None: off), holdout, rejected and bound of the test that settled it."""
        out = []
        for s in self.cutoffs:
            own = [c for c in self.certificates if c["stratum"] == s]
            last = ([c for c in own if c["ok"]] or own)[-1]
            out.append((s, last["level"] if last["ok"] else None, last["holdout"], last["rejected"], last["bound"]))
        return out

    def rejects(self, stratum: Column, f: str = "features") -> Column:
        """True where a rule of the row's stratum is broken."""
        hit = F.lit(False)
        for name, cut in self.cutoffs.items():
            if cut is None:
                continue
            hit = hit | (stratum.eqNullSafe(F.lit(name)) & _breaks(cut, f))
        return hit


def settled(rules: Rules, stratum: Column) -> list[Column]:
    """Columns (rule_level, holdout, bound): what certified the rules of a row's stratum; a null level: rules off."""
    level, rows, bound = F.lit(None).cast("double"), F.lit(0).cast("long"), F.lit(1.0)
    for s, times, n, _, limit in rules.report():
        own = stratum.eqNullSafe(F.lit(s))
        level = F.when(own, F.lit(times).cast("double")).otherwise(level)
        rows, bound = F.when(own, F.lit(n).cast("long")).otherwise(rows), F.when(own, F.lit(limit)).otherwise(bound)
    return [level.alias("rule_level"), rows.alias("holdout"), bound.alias("bound")]


def _multiple(times: float) -> dict[str, float]:
    return {rule: floor * times if side == "high" else floor / times for rule, (_, _, side, floor) in RULES.items()}


def _breaks(cut: dict[str, float], f: str) -> Column:
    """True where a rule is broken."""
    broken = F.lit(False)
    for rule, (over, under, side, _) in RULES.items():
        value = F.col(f"{f}.{over}") / F.greatest(F.col(f"{f}.{under}"), F.lit(1))
        broken = broken | (value > cut[rule] if side == "high" else value < cut[rule])
    return broken


def fit_rules(
    rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang", label_col: str = "quality",
    f: str = "features", alpha: float = 0.01, delta: float = 0.05,
) -> Rules:
    """Choose cutoffs per stratum on labelled good documents (label 1) that pass the base checks.

    ``rows`` holds id, stratum and features; columns of any other name stay out of the way. All
    labelled documents are tested by Spark; the driver gets counts per stratum. Ids labelled both ways or null are left out; a
    null stratum is one of its own; rows that repeat count as often as they stand there. The
    length of a text plays no part here. Strata without any good label keep all rules off, and
    so do all strata of an empty table. Which strata exist is a matter of the labels' table.
    """
    marks = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y"))
    sure = marks.groupBy("i").agg(F.min("y").alias("low"), F.max("y").alias("high"), F.count("y").alias("n"), F.count(F.lit(1)).alias("m"))
    sure = sure.where("low = 1 AND high = 1 AND n = m").select("i")
    good = rows.where(~base_failed(f)).select(F.col(id_col).alias("i"), F.col(stratum_col).alias("s"), F.col(f).alias("f"))
    counts = [F.sum(_breaks(_multiple(m), "f").cast("long")).alias(f"r{k}") for k, m in enumerate(MULTIPLES)]
    found = good.join(sure, "i").groupBy("s").agg(F.count(F.lit(1)).alias("n"), *counts).collect()
    found = sorted(found, key=lambda r: (r["s"] is None, r["s"]))
    return certify({r["s"]: (r["n"], [r[f"r{k}"] for k in range(len(MULTIPLES))]) for r in found}, alpha, delta)


def certify(values: dict[str | None, tuple[int, list[int]]], alpha: float, delta: float) -> Rules:
    """The strictest level of each stratum that its holdout certifies, by the shared-out confidence.

    ``values`` has the size of each holdout and how many of it every level rejects.
    """
    rules = Rules(dict.fromkeys(values))
    level = dict.fromkeys(values, 0)
    tried: dict[str | None, float] = {}
    moved = True
    while moved:
        moved = False
        left = [s for s in values if level[s] < len(MULTIPLES)]
        each = delta / max(1, len(left))
        for s in left:
            while level[s] < len(MULTIPLES) and tried.get(s, 0.0) < each:
                at = level[s]
                k, n = values[s][1][at], values[s][0]
                bound = upper_bound(k, n, each)
                ok = bound <= alpha
                rules.certificates.append(
                    {"stratum": s, "level": MULTIPLES[at], "rejected": k, "holdout": n, "share": each, "bound": bound, "ok": ok}
                )
                if not ok:
                    tried[s] = each
                    break
                rules.cutoffs[s] = _multiple(MULTIPLES[at])
                level[s], moved = at + 1, True
                tried.pop(s, None)
    return rules
