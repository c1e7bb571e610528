"""Quality rules: statistics of a text, and a decision list learned from labels.

Everything on the way from text to verdict is DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stored, table

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once for each row, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more in the text, each word counted once.

    The windows' hashes are folded from pairs, fours and eights. Only a text with a repeated
    hash sorts them; the covered words are then the sum of the steps between repeated
    windows, eight at most each.
    """
    last = WINDOW_WORDS

    def pairs(h: Column, by: int) -> Column:
        n = F.greatest(F.size(h) - by, F.lit(0))
        return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(by + 1), n),
                          lambda a, b: F.xxhash64(a, b))

    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = _let(ordered, lambda s: F.transform(F.filter(
            F.transform(s, lambda x, i: F.struct(
                x["i"].alias("i"),
                (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
            lambda x: x["twice"]), lambda x: x["i"]))
        return _let(F.array_sort(repeated), lambda p: F.aggregate(
            F.transform(p, lambda at, i: F.least(
                F.lit(last), F.coalesce(F.get(p, i + 1) - at, F.lit(last)))),
            F.lit(0), lambda a, b: a + b))

    def of_hashes(h: Column) -> Column:
        return _let(pairs(h, 1), lambda two: _let(pairs(two, 2), lambda four: _let(
            pairs(four, 4), lambda w: F.when(
                F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0)))))

    return F.when(F.size(words) > last, _let(
        F.transform(words, lambda w: F.xxhash64(w)), of_hashes)).otherwise(F.lit(0))


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars,
    n_upper, n_marks, n_lines. A null text counts as empty; an empty text has zeros."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    split = split.select(
        "doc_id", "text", F.array_remove(F.split("text", SPACE + "+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.length(
            F.translate(x, " \t\x0b\x0c\r\n", "")) > 0).alias("lines"))
    return split.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("[!?]")).cast("long").alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def features() -> dict[str, Column]:
    """What the conditions compare, each by its name."""
    return {
        "symbols_per_char": _ratio("n_symbols", "word_chars"),
        "upper_per_char": _ratio("n_upper", "word_chars"),
        "marks_per_word": _ratio("n_marks", "n_words"),
        "chars_per_word": _ratio("word_chars", "n_words"),
        "repeat_per_word": _ratio("n_repeat_words", "n_words"),
        "dup_per_line": _ratio("n_dup_lines", "n_lines"),
        "words": F.col("n_words").cast("double"),
        "words_per_line": _ratio("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        f = features()[self.feature]
        return f > self.threshold if self.above else f <= self.threshold


def conjunction(conditions: list[Condition]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def verdict(rules: list[list[Condition]]) -> Column:
    """The list as an ordered conditional expression: the first rule that holds rejects."""
    out = None
    for rule in rules:
        out = F.when(conjunction(rule), False) if out is None else out.when(conjunction(rule), False)
    return F.lit(True) if out is None else out.otherwise(True)


def learn(stats: DataFrame, label: str = "bad", bins: int = 32, max_rules: int = 8,
          max_conditions: int = 3, min_precision: float = 0.9, min_covered: int = 5) -> list[list[Condition]]:
    """An ordered list of rules for label = true, by sequential covering.

    stats: the columns of text_stats and the boolean label. Two of three rows (by hash of
    doc_id) grow a rule, the third prunes it. A rule grows by the threshold with the most
    gain (p * (log precision after - before)); all features, thresholds and both directions
    are counted in one aggregation over the rows not yet covered. Pruning keeps the prefix
    with the best (p - n) / (p + n) on the pruning rows. Rows that a rule covers leave the
    next round. It ends when a rule's precision or cover is too low. Thresholds are
    quantiles of each feature; the driver sees only them and counts. No labels: no rules.
    """
    cols = features()
    part = (F.abs(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))) % 3).alias("_part")
    rows = stored(stats.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_bad"), part, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "n_upper", "n_marks", "n_lines"))
    table_ = rows.select("*", *[c.alias(f"_{k}") for k, c in cols.items()])
    cuts = {}
    steps = [i / bins for i in range(1, bins)]
    found = table_.select(*[F.percentile_approx(f"_{k}", steps, 10000).alias(k) for k in cols],
                          *[F.percentile_approx(F.when(F.col("_bad"), F.col(f"_{k}")), steps, 10000)
                            .alias(f"bad_{k}") for k in cols]).first()
    for k in cols:
        seen = sorted({*(found[k] or []), *(found[f"bad_{k}"] or [])})
        between = [a + (b - a) * i / 4 for a, b in zip(seen, seen[1:], strict=False) for i in (1, 2, 3)]
        cuts[k] = sorted({*seen, *between})
    rules: list[list[Condition]] = []
    for _ in range(max_rules):
        left = table_.where(~_any(rules))
        rule: list[Condition] = []
        counts = left.where(F.col("_part") < 2).agg(
            F.count_if("_bad").alias("p"), F.count_if(~F.col("_bad")).alias("n")).first()
        p0, n0 = counts["p"], counts["n"]
        while p0 and n0 and len(rule) < max_conditions:
            best = _best(left.where((F.col("_part") < 2) & conjunction(rule)), cuts, p0, n0)
            if best is None:
                break
            _, condition, p0, n0 = best
            rule.append(condition)
        if not rule:
            break
        rule = _pruned(left, rule)
        c = left.where(conjunction(rule)).agg(F.count_if("_bad").alias("p"), F.count("*").alias("all")).first()
        if c["p"] < min_covered or c["p"] < min_precision * c["all"]:
            break
        rules.append(rule)
    return rules


def _bin(value: Column, at: list[float]) -> Column:
    """How many of the thresholds the value is above."""
    return F.size(F.filter(F.array(*[F.lit(float(x)) for x in at]), lambda x: x < value))


def _any(rules: list[list[Condition]]) -> Column:
    out = F.lit(False)
    for r in rules:
        out = out | conjunction(r)
    return out


def _best(rows: DataFrame, cuts: dict[str, list[float]], p0: int, n0: int):
    """The condition with the most gain over p0 bad and n0 good rows, from one aggregation.

    Each row adds to one bin of each feature; what lies above a threshold is a sum of bins.
    """
    parts = []
    for k, at in cuts.items():
        bin_ = _bin(F.col(f"_{k}"), at)
        parts.append(F.struct(F.lit(k).alias("k"), bin_.alias("b")))
    counted = rows.select("_bad", F.explode(F.array(*parts)).alias("x")).groupBy("x.k", "x.b").agg(
        F.count_if("_bad").alias("p"), F.count_if(~F.col("_bad")).alias("n")).collect()
    by = {k: {} for k in cuts}
    for r in counted:
        by[r["k"]][r["b"]] = (r["p"], r["n"])
    before, found = math.log2(p0 / (p0 + n0)), []
    for k, at in sorted(cuts.items()):
        for j, threshold in enumerate(at):
            above = [sum(v[i] for b, v in by[k].items() if b > j) for i in (0, 1)]
            below = [sum(v[i] for b, v in by[k].items() if b <= j) for i in (0, 1)]
            for side, (p, n) in ((True, above), (False, below)):
                if p and n < n0:
                    gain = p * (math.log2(p / (p + n)) - before)
                    found.append((gain, Condition(k, side, float(threshold)), p, n))
    if not found or (top := max(x[0] for x in found)) <= 0:
        return None
    first = next(x for x in found if x[0] == top)
    same = [x for x in found if (x[0], x[1].feature, x[1].above, *x[2:])
            == (top, first[1].feature, first[1].above, *first[2:])]
    return same[len(same) // 2]  # the middle of equal thresholds, away from either class


def _pruned(left: DataFrame, rule: list[Condition]) -> list[Condition]:
    found = left.where(F.col("_part") == 2).agg(*[x for i in range(1, len(rule) + 1) for x in (
        F.count_if(F.col("_bad") & conjunction(rule[:i])).alias(f"p{i}"),
        F.count_if(~F.col("_bad") & conjunction(rule[:i])).alias(f"n{i}"))]).first()
    worth = [(found[f"p{i}"] - found[f"n{i}"]) / max(1, found[f"p{i}"] + found[f"n{i}"])
             for i in range(1, len(rule) + 1)]
    return rule[:worth.index(max(worth)) + 1]


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document the statistics, base_failed, and kept: the base rules, then the learned list.

    labels: doc_id, quality (0 or 1). The list learns from the labelled documents that the
    base rules keep; a document with several labels is bad if any says so. Rows with a null
    id or label teach nothing. Without labels the list is empty and the base rules decide.
    """
    stats = stored(text_stats(docs, id_col, text_col))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").alias("_id")).agg((F.min("quality") == 0).alias("bad"))
    taught = stats.where(~base_failed()).join(known, F.col("doc_id") == F.col("_id"))
    rules = learn(taught)
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
