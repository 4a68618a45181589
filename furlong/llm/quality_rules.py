"""Quality rules combined by weak supervision.

Every rule reads a few exact counts of the whole text and votes 1 (good),
-1 (bad) or 0 (abstains).  Expectation-maximisation estimates, for each
rule, how often it casts each vote on good and on bad documents, and the
share of good ones; the verdict is the posterior probability of "good", not
an all-must-pass filter.

Scale: the counts are column expressions on one row (no explode, no
shuffle of texts).  The only aggregate is the number of documents per vote
pattern: at most ``3 ** rules`` rows whatever the input, combined map-side.
Each EM step is an aggregate over that small table, and hands the next one
its ``2 * rules + 1`` numbers as literals.  No Python runs on executors.

Defined results: null and empty texts have no words, all counts 0, fail the
base rule and are not kept; an empty table gives an empty result; repeated
rows are judged alike; columns named like a result column are replaced.
Windows are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import SPACE, staged, text_or_empty, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _paired(a: str, by: int) -> Column:
    """Each hash of array ``a`` hashed with the one ``by`` places on: hashes of
    sequences twice as long (the last ones run over the end)."""
    return F.transform(a, lambda x, i: F.xxhash64(x, F.get(F.col(a), i + by)))


def _repeat_words(windows: Column, n_windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more in the array."""
    def covered(pairs: Column) -> Column:
        seen = lambda p, i: (  # noqa: E731  next to an equal hash in sorted order
            ((i > 0) & (F.get(pairs, i - 1)["h"] == p["h"]))
            | ((i < F.size(pairs) - 1) & (F.get(pairs, i + 1)["h"] == p["h"])))
        return F.sort_array(F.transform(F.filter(pairs, seen), lambda p: p["i"]))

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # let-binding by a one-element array, so that the sorts run once
    at = F.element_at(F.transform(F.array(pairs), covered), 1)
    total = F.element_at(F.transform(F.array(at), lambda p: F.aggregate(
        p, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, x: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n"), x.alias("last")),
        lambda acc: acc["n"])), 1)
    return F.when(n_windows <= F.size(F.array_distinct(windows)), F.lit(0).cast("long")).otherwise(total)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, the shares the rules read, and ``base_failed``."""
    t = text_or_empty(text)
    d = docs.withColumn("_q_words", words(text))
    d = d.withColumn("_q_1", F.transform("_q_words", lambda w: F.xxhash64(w)))
    for n in (1, 2, 4):  # each level is a column of its own, so none is computed twice
        d = d.withColumn(f"_q_{2 * n}", _paired(f"_q_{n}", n))
    d = d.withColumn("_q_win", F.slice("_q_8", F.lit(1), F.greatest(F.size("_q_8") - (WINDOW - 1), F.lit(0))))
    d = d.withColumn("_q_lines", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    d = d.withColumns({
        "n_words": F.size("_q_words").cast("long"),
        "word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("_q_win"), F.size("_q_win")),
        "_q_n_lines": F.size("_q_lines").cast("long"),
        "_q_kinds": F.size(F.array_distinct("_q_1")).cast("long"),
        "_q_upper": F.regexp_count(t, F.lit("[A-Z][A-Z]")).cast("long"),
        "_q_runs": F.regexp_count(t, F.lit("[#*$%&|<>]+")).cast("long"),
        "_q_marks": F.regexp_count(t, F.lit("[!?]")).cast("long"),
    }).drop("_q_words", "_q_1", "_q_2", "_q_4", "_q_8", "_q_win", "_q_lines")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _vote(value: Column, good_to: float, bad_from: float) -> Column:
    """-1 from ``bad_from`` on, 1 up to ``good_to``, else 0 (abstains)."""
    return F.when(value >= bad_from, -1).when(value <= good_to, 1).otherwise(0).cast("byte")


def rules() -> dict[str, Column]:
    """The rules: name -> vote.  A rule abstains where its measure says little.
    Each kind of fault is seen by two rules or more: EM learns a rule's
    accuracy from rules that agree with it."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    mean, kinds = F.col("word_chars") / n, F.col("_q_kinds") / n
    return {
        "symbols": _vote(F.col("n_symbols") / n, 0.05, 0.2),
        "symbol_words": _vote(F.col("_q_runs") / n, 0.05, 0.2),
        "capitals": _vote(F.col("_q_upper") / n, 0.2, 0.8),
        "exclamations": _vote(F.col("_q_marks") / n, 0.1, 0.3),
        "duplicate_lines": _vote(F.col("n_dup_lines") / F.greatest(F.col("_q_n_lines"), F.lit(1)), 0.1, 0.4),
        "repeated_windows": _vote(F.col("n_repeat_words") / n, 0.1, 0.25),
        "vocabulary": F.when(kinds < F.when(n < 400, 0.2).otherwise(0.02), -1)
                       .when((n < 400) & (kinds > 0.3), 1).otherwise(0).cast("byte"),
        "word_length": F.when((mean < 2) | (mean > 15), -1).when((mean >= 3) & (mean <= 10), 1)
                        .otherwise(0).cast("byte"),
    }


def _posterior(model: dict, names: list[str]) -> Column:
    """P(good | votes) as a column of the vote columns.

    The log ratios stand in one array literal looked up by vote: the generated
    code is then the same in every EM step and is compiled once."""
    table = [model["log_prior_odds"] * (r == names[0]) + model["log_ratio"].get((r, v), 0.0)
             for r in names for v in (-1, 0, 1)]
    table = "array(" + ", ".join(f"{float(x)!r}D" for x in table) + ")"
    odds = " + ".join(f"get({table}, int(`_v_{r}`) + {3 * k + 1})" for k, r in enumerate(names))
    return F.expr(f"1D / (1D + exp(-({odds})))")


def fit(votes: DataFrame, names: list[str], steps: int = 30, prior: float = 0.05,
        tolerance: float = 1e-4) -> dict:
    """EM over ``votes`` (columns ``_v_<rule>``).  Starts from "bad if any
    rule says bad" at 99 % confidence.  A rule has one accuracy on good and
    one on bad documents, both over the votes it casts; an abstention says
    nothing.  The accuracies have a Beta prior worth ``prior`` of the rows (99.8
    % right on good documents, 30 % on bad ones, since each kind of fault is
    seen by few rules), which keeps two rules that always agree from being
    taken for the whole truth.  A vote for a class never counts against it.
    Returns the log prior odds and the log likelihood ratio of every vote."""
    keys = [f"_v_{r}" for r in names]
    patterns = staged(votes.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_n")).coalesce(1),
                      "patterns")
    sums = [F.expr("sum(_n)").alias("all"), F.expr("sum(_n * _w)").alias("good")]
    for r in names:
        for v in (-1, 1):
            sums += [F.expr(f"sum(if(`_v_{r}` = {v}, _n * _w, 0D))").alias(f"g_{r}_{v}"),
                     F.expr(f"sum(if(`_v_{r}` = {v}, _n * (1D - _w), 0D))").alias(f"b_{r}_{v}")]
    weight = F.when(F.least(*keys) < 0, F.lit(0.01)).otherwise(F.lit(0.99))
    model = {"log_prior_odds": 0.0, "log_ratio": {(r, v): 0.0 for r in names for v in (-1, 1)}}
    for _ in range(steps):
        s = patterns.withColumn("_w", weight).agg(*sums).first()
        if not s["all"]:
            return model
        k, ratio = prior * s["all"] + 1.0, {}
        for r in names:
            good = {v: s[f"g_{r}_{v}"] + k * (0.002 if v < 0 else 0.998) for v in (-1, 1)}
            bad = {v: s[f"b_{r}_{v}"] + k * (0.3 if v < 0 else 0.7) for v in (-1, 1)}
            for v in (-1, 1):
                x = log(good[v] / (good[-1] + good[1])) - log(bad[v] / (bad[-1] + bad[1]))
                ratio[r, v] = max(x, 0.0) if v > 0 else min(x, 0.0)
        moved = max(abs(ratio[x] - model["log_ratio"][x]) for x in ratio)
        model = {"log_prior_odds": log((s["good"] + 1.0) / (s["all"] - s["good"] + 1.0)), "log_ratio": ratio}
        weight = _posterior(model, names)
        if moved < tolerance:
            break
    return model


def judge(docs: DataFrame, text: str = "text", threshold: float = 0.5, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with the base counts, ``base_failed``,
    ``posterior`` (probability of good quality) and ``kept``.  Writes the
    counts once to the shared folder (an action) and fits on all rows that
    pass the base rule."""
    table, names = rules(), list(rules())
    d = with_counts(docs.select(*keep, F.col(text).alias("_q_text")), "_q_text").drop("_q_text")
    d = staged(d.withColumns({f"_v_{r}": v for r, v in table.items()}), "rules")
    model = fit(d.where(~F.col("base_failed")), names)
    p = _posterior(model, names)
    return d.select(*[c for c in keep if c not in COUNTS], *COUNTS, "base_failed",
                    F.when(F.col("base_failed"), 0.0).otherwise(p).alias("posterior"),
                    (~F.col("base_failed") & (p >= threshold)).alias("kept"))
