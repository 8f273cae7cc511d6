"""Quality rules: a decision list learned by sequential covering, written as
ordered Spark conditional expressions (DataFrame functions only).

Statistics are built-in expressions over the whole text of every document.  The
list is learned from labelled statistics: each round grows one conjunction of
thresholds by FOIL gain on two thirds of the labelled rows, prunes its last
conditions on the other third, and keeps it if its precision there holds;
covered rows leave, the next round starts.  All counts come from one histogram
(statistic, threshold bin) per step, so the driver sees at most
``len(FEATURES) * (BINS + 2)`` rows, however many are labelled.

Learning reads at most about ``max_labelled`` labelled documents that are in the
table, chosen by the hash of their id (the documented bound); a rare class keeps
up to half of the bound, and rows count by the inverse of their class's share, so
precision is that of all labelled documents.  The list is applied to all.

Nulls: null text counts as an empty text, a null id is kept and matches no
label, null labels are left out.  Empty text has zero words and fails the base
check.  Repeated rows each get their (equal) result; a document labelled twice
counts as low quality if any label says so.  No usable label: an empty list.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import SPACE, class_sample, col, fresh, materialize, present_labels, release, text_or_empty

MAX_LABELLED = 20_000
MAX_RULES = 8
MAX_CONDITIONS = 3
BINS = 24
MIN_PRECISION = 0.97
MIN_COVER = 5

#: Statistics that conditions may test, over the counts.  None of them drifts
#: with the length of a text or with its language (a share of distinct words or a
#: mean word length would: long or German clean texts were then rejected).
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the text.

    Windows are sorted by hash inside the row; equal neighbours are repeats;
    the union of [start, start + 3) over their starts is summed in order."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.transform(starts, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    ordered = F.sort_array(windows)

    def repeated(s: Column) -> Column:
        same = F.filter(F.transform(s, lambda x, k: F.struct(x["i"].alias("i"), ((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])).alias("r"))), lambda y: y["r"])
        return F.sort_array(F.transform(same, lambda y: y["i"]))

    def covered(p: Column) -> Column:
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(p, zero, lambda a, x: F.struct((x + 3).alias("end"), (a["n"] + (x + 3 - F.greatest(a["end"], x))).cast("long").alias("n")), lambda a: a["n"])

    # transform over a one-element array binds the sorted windows once
    once = F.transform(F.array(ordered), lambda s: covered(repeated(s)))
    return F.when(F.size(words) >= 4, F.get(once, F.lit(0))).otherwise(F.lit(0).cast("long"))


def with_counts(df: DataFrame, text_col: str, names: dict[str, str]) -> DataFrame:
    """``df`` plus the count columns, named by ``names`` (count -> column).

    The counts leave a generator as one struct: no filter or projection above is
    pushed below it, where each of its references would count (and split the
    text) again, inside the per-word functions too."""
    text, words, lines = fresh([*df.columns, *names.values()], "text", "words", "lines")
    out = df.withColumn(text, text_or_empty(text_col))
    out = out.withColumns({
        words: F.array_remove(F.split(F.col(text), f"{SPACE}+"), ""),
        lines: F.filter(F.split(F.col(text), "\n", -1), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")) != ""),
    })
    c = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.col(text)) - F.regexp_count(F.col(text), F.lit(SPACE)),
        "n_symbols": F.regexp_count(F.col(text), F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(F.col(words)),
        "n_lines": F.size(lines),
        "n_upper": F.regexp_count(F.col(text), F.lit("[A-Z]")),
    }
    counts = F.struct(*(c[k].cast("long").alias(names[k]) for k in COUNTS))
    return out.select(*map(col, df.columns), F.inline(F.array(counts)))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def expr(self) -> Column:
        x = F.expr(FEATURES[self.feature])
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.expr()
    return out


def labelled_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", quality_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Counts of the labelled documents learned from: (counts..., low, prune)."""
    known = labels.select(col(label_id).cast("long").alias("i"), col(quality_col).cast("int").alias("q")).where("i is not null and q in (0, 1)")
    known = known.groupBy("i").agg((F.min("q") == 0).alias("low"))
    known = present_labels(docs.select(col(id_col).cast("long").alias("i")), known)
    # about max_labelled rows of 17 bytes at most: a proven bound for the broadcast
    chosen = class_sample(known, "low", [F.col("i")], max_labelled, "rules")
    text = docs.select(col(id_col).cast("long").alias("i"), col(text_col).alias("t")).join(F.broadcast(chosen), "i")
    out = with_counts(text, "t", {k: k for k in COUNTS})
    return out.select(*COUNTS, "low", (F.pmod(F.xxhash64("i", F.lit("prune")), F.lit(3)) == 0).alias("prune"), "weight")


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Midpoints between neighbouring quantiles of either class."""
    q = [k / BINS for k in range(BINS + 1)]
    got = rows.groupBy("low").agg(*(F.percentile_approx(F.expr(x), q, 2000).alias(n) for n, x in FEATURES.items())).collect()
    seen = {n: sorted({float(v) for r in got for v in (r[n] or [])}) for n in FEATURES}
    return {n: [(a + b) / 2 for a, b in zip(v, v[1:])] for n, v in seen.items()}


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[list[float]]]:
    """Per feature, [low, good] weights of rows by the number of cuts below."""
    def below(n: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[n])), lambda t: t < F.expr(FEATURES[n])))

    bins = F.explode(F.array(*(F.struct(F.lit(n).alias("f"), below(n).alias("b")) for n in FEATURES if cuts[n]))).alias("x")
    got = rows.select(bins, "low", "weight").groupBy("x.f", "x.b", "low").agg(F.sum("weight").alias("n")).collect()
    out = {n: [[0.0, 0.0] for _ in range(len(cuts[n]) + 1)] for n in FEATURES}
    for r in got:
        out[r["f"]][r["b"]][0 if r["low"] else 1] += r["n"]
    return out


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[float, Condition | None, float, float]:
    """The condition of highest FOIL gain, ties by statistic and threshold."""
    best, hist = (0.0, None, 0, 0), _histogram(rows, cuts)
    for n, h in hist.items():
        p0, n0 = sum(x[0] for x in h), sum(x[1] for x in h)
        if not p0 or not cuts[n]:
            continue
        base, p, m = math.log2(p0 / (p0 + n0)), 0, 0
        for k, t in enumerate(cuts[n]):  # bins 0..k have x <= t
            p, m = p + h[k][0], m + h[k][1]
            for above, (a, b) in ((False, (p, m)), (True, (p0 - p, n0 - m))):
                if a > 1e-9 and (gain := a * (math.log2(a / (a + b)) - base)) > best[0] + 1e-9:
                    best = (gain, Condition(n, above, t), a, b)
    return best


def learn(rows: DataFrame, max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS, min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> list[Rule]:
    """Sequential covering over ``labelled_counts`` rows; rules reject."""
    rows = materialize(rows if "weight" in rows.columns else rows.withColumn("weight", F.lit(1.0)))
    cuts, rules = _thresholds(rows), []
    left = rows
    while len(rules) < max_rules and any(cuts.values()):
        grow, rule = left.where("not prune"), ()
        while len(rule) < max_conditions:
            _, c, p, n = _best(grow, cuts)
            if c is None:
                break
            rule, grow = (*rule, c), grow.where(c.expr())
            if n <= 1e-9:
                break
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        got = left.where("prune").agg(*(
            f.alias(f"{name}{i}")
            for i, x in enumerate(prefixes)
            for name, f in (
                ("p", F.sum(F.when(_holds(x) & F.col("low"), F.col("weight")))),
                ("n", F.sum(F.when(_holds(x) & ~F.col("low"), F.col("weight")))),
                ("rows", F.count_if(_holds(x) & F.col("low"))),
            )
        )).first()
        held = [(got[f"p{i}"] or 0.0, got[f"n{i}"] or 0.0, got[f"rows{i}"]) for i in range(len(prefixes))]
        fit = [((p - n) / (p + n), -i) for i, (p, n, r) in enumerate(held) if r >= min_cover and p >= min_precision * (p + n)]
        if not fit:
            break
        i = -max(fit)[1]
        rules.append(prefixes[i])
        left = left.where(~_holds(prefixes[i]))
    release(rows)
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: number of the first rule that
    holds, else null."""
    out = F.lit(None).cast("int")
    for k, r in reversed(list(enumerate(rules))):
        out = F.when(_holds(r), F.lit(k)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def score_documents(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, rule (first that rejects)."""
    base = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("t"))
    out = with_counts(base, "t", {k: k for k in COUNTS})
    out = out.withColumn("base_failed", base_failed()).withColumn("rule", rule_number(rules))
    return out.select("doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither the base check nor a rule rejects."""
    inner = docs.select(F.struct(*map(col, docs.columns)).alias("__row"), col(text_col).alias("t"))
    out = with_counts(inner, "t", {k: k for k in COUNTS})
    # explode holds the verdict: a filter on it is not pushed below the counts,
    # where each of its references would count again
    good = F.explode(F.array(~base_failed() & rule_number(rules).isNull())).alias("good")
    return out.select("__row", good).where("good").select("__row.*")


def learn_from(docs: DataFrame, labels: DataFrame, **params) -> list[Rule]:
    return learn(labelled_counts(docs, labels, **params))
