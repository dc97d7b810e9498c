"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

A rule rejects a document whose measure (a share, higher is worse) lies above a
cutoff. Cutoffs are certified on labelled documents, per stratum (bands of text
length): with ``n`` good labelled documents of which ``r`` lie above a cutoff, the
cutoff is certified if the exact binomial probability of at most ``r`` rejections
at the allowed rate is small, ``P(Bin(n, rate) <= r) <= delta / tests`` (the exact
upper confidence bound of the false rejection rate is then below the rate). Each
of the rules gets an equal share of the stratum's allowed rate ``risk``, so the
rules together reject at most ``risk`` of a stratum's good documents.

Multiple testing: Bonferroni over strata and rules; inside a rule the cutoffs of
its fixed grid are tested from the mildest on until the first that fails (fixed
sequence), which needs no correction. Of the certified cutoffs the one that
rejects the largest share of the labelled bad documents beyond its share of the
good ones is used, the mildest among equals; it must reject more bad documents
than good ones. A rule without such a cutoff rejects nothing.

Base checks (fewer than 50 words; more than half of the words in repeated 3-word
windows) come first; documents failing them are outside the labelled counts.

Defined results: a null or empty text has no words and fails; a document without
a label is judged all the same; null labels and null ids take no part in the
counts, several labels of one id count as one (the worst); rows are judged one by
one, so repeated rows get equal results. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

#: Upper ends (exclusive, in words) of the strata; the last one is open.
BANDS = (200, 500, 1500)
#: Cutoffs of each rule, mildest first.
GRID = {
    "symbol_share": (0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "upper_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "dup_line_share": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeat_share": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "digit_share": (0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
}
_GAP = r"[\x20\x09-\x0D]+"


def measures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Counts of every text: ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words`` and ``n_lines, n_upper, n_digits``.

    Repeated 3-word windows: a window's hash, with its low bits replaced by its
    place, is a sortable long, so sorting brings equal windows together; their
    words are compared before they count. Columns used inside a lambda are used
    outside it too: Catalyst then computes them once, not once per element.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    one = docs.select(
        F.col(id_col).alias("id"), F.array_remove(F.split(text, _GAP, -1), "").alias("w"), lines.alias("lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("n_upper"),
        F.regexp_count(text, F.lit("[0-9]")).alias("n_digits"))
    n = F.size("w")
    bits = F.length(F.bin(n))
    place = F.sequence(F.lit(0), n - 3)
    two = one.select(
        "id", "w", "n_symbols", "n_upper", "n_digits", n.alias("n_words"), bits.alias("bits"),
        F.length(F.array_join("w", "")).alias("word_chars"), F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(n >= 3, F.transform(place, lambda i: _stamp(F.xxhash64(
            F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)), F.length(F.bin(n)), i)))
        .otherwise(F.array().cast("array<bigint>")).alias("stamps"))
    three = two.withColumn("s", F.sort_array("stamps")).drop("stamps")
    size = F.size("s")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1

    def at(j: Column) -> Column:
        return F.get("s", j).bitwiseAND(mask).cast("int")

    def same(i: Column, j: Column) -> Column:
        equal = F.call_function("shiftright", F.get("s", i), F.col("bits")) == F.call_function(
            "shiftright", F.get("s", j), F.col("bits"))
        for k in range(3):
            equal = equal & (F.get("w", at(i) + k) == F.get("w", at(j) + k))
        return F.coalesce(equal, F.lit(False))

    again = F.when(size > 1, F.transform(F.filter(
        F.sequence(F.lit(0), size - 1), lambda j: same(j, j + 1) | ((j > 0) & same(j - 1, j))), at)) \
        .otherwise(F.array().cast("array<int>"))
    four = three.select(*[c for c in three.columns if c not in ("w", "s")],
                        F.size("w").alias("check"), again.alias("again"))
    # words covered by [p, p + 3) for the sorted places p
    covered = F.aggregate(
        F.sort_array("again"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n")),
        lambda a: a["n"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper", "n_digits")
    return four.select("id", *[F.col(c).cast("long").alias(c) for c in names],
                       covered.cast("long").alias("n_repeat_words"))


def _stamp(h: Column, bits: Column, i: Column) -> Column:
    """The hash with its low ``bits`` replaced by ``i``."""
    high = F.call_function("shiftleft", F.call_function("shiftright", h, bits), bits)
    return high.bitwiseOR(i.cast("long"))


def _share(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))


def _rules() -> dict[str, Column]:
    return {"symbol_share": _share("n_symbols", "word_chars"), "upper_share": _share("n_upper", "word_chars"),
            "dup_line_share": _share("n_dup_lines", "n_lines"), "repeat_share": _share("n_repeat_words", "n_words"),
            "digit_share": _share("n_digits", "word_chars")}


def _stratum() -> Column:
    band = F.lit(len(BANDS))
    for k in reversed(range(len(BANDS))):
        band = F.when(F.col("n_words") < BANDS[k], k).otherwise(band)
    return band


def binomial_at_most(r: Column, n: Column, rate: float) -> Column:
    """P(Bin(n, rate) <= r), exactly summed from the largest term down; 1 where
    r is not below the mean (no cutoff is certified there)."""
    log_choose = F.aggregate(F.when(r > 0, F.sequence(F.lit(1).cast("long"), r)).otherwise(F.array().cast("array<bigint>")),
                             F.lit(0.0), lambda a, j: a + F.log((n - r + j) / j))
    last = log_choose + r * math.log(rate) + (n - r) * math.log1p(-rate)
    below = F.aggregate(
        F.when(r > 0, F.sequence(r, F.lit(1).cast("long"))).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda a, i: F.struct((a["t"] * i / (n - i + 1) * ((1 - rate) / rate)).alias("t"),
                              (a["s"] + a["t"] * i / (n - i + 1) * ((1 - rate) / rate)).alias("s")),
        lambda a: a["s"])
    return F.when(r >= n * rate, F.lit(1.0)).otherwise(F.exp(last) * below)


def certified_cutoffs(labelled: DataFrame, risk: float, delta: float) -> DataFrame:
    """Cutoff per stratum and rule: ``stratum, rule, cutoff, n_good, r_good,
    n_bad, r_bad``. ``labelled``: stratum, good (boolean) and the rules' columns.
    The result has at most one row for each stratum and rule."""
    rate, tests = risk / len(GRID), len(GRID) * (len(BANDS) + 1)
    grid = F.create_map(*[x for k, g in GRID.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in g]))])
    long = labelled.select("stratum", "good", F.explode(F.create_map(
        *[x for k in GRID for x in (F.lit(k), F.col(k))])).alias("rule", "value"))
    # index of the mildest cutoff that the value lies above
    counts = (long.select("stratum", "good", "rule", F.size(F.filter(
        grid[F.col("rule")], lambda c: c >= F.col("value"))).alias("above"))
        .groupBy("stratum", "rule", "above")
        .agg(F.sum(F.col("good").cast("long")).alias("g"), F.sum((~F.col("good")).cast("long")).alias("b")))
    steps = (counts.groupBy("stratum", "rule").agg(
        F.sum("g").alias("n_good"), F.sum("b").alias("n_bad"),
        F.collect_list(F.struct("above", "g", "b")).alias("bins"))  # one entry per cutoff at most
        .select("*", F.posexplode(grid[F.col("rule")]).alias("step", "cutoff"))
        .withColumn("r_good", _below("g")).withColumn("r_bad", _below("b")))
    ok = binomial_at_most(F.col("r_good"), F.col("n_good"), rate) <= delta / tests
    order = Window.partitionBy("stratum", "rule").orderBy("step")  # a grid's few rows
    held = steps.withColumn("ok", F.min(ok.cast("int")).over(order)).where("ok = 1")
    gain = F.col("r_bad") / F.col("n_bad") - F.col("r_good") / F.col("n_good")
    return (held.where("r_bad > r_good").withColumn("gain", gain).where("gain > 0")
            .groupBy("stratum", "rule")
            .agg(F.max_by(F.struct("cutoff", "n_good", "r_good", "n_bad", "r_bad"),
                          F.struct("gain", "cutoff")).alias("c")).select("stratum", "rule", "c.*"))


def _below(name: str) -> Column:
    """Documents above the cutoff of this step: all with a mildest cutoff up to it."""
    return F.aggregate("bins", F.lit(0).cast("long"), lambda a, x: a + F.when(
        x["above"] <= F.col("step"), x[name]).otherwise(F.lit(0)))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_id_col: str = "doc_id", label_col: str = "quality", min_words: int = 50,
                  risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Verdict per document: ``id_col``, the measures, ``base_failed``, ``kept``
    and ``rules`` (names of the certified rules that reject it)."""
    found = stage(measures(docs, id_col, text_col), "measures")
    judged = found.select("*", _stratum().alias("stratum"), *[c.alias(k) for k, c in _rules().items()],
                          ((F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
                          .alias("base_failed"))
    label = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id_col).alias("id"))
             .agg((F.min(label_col) == 1).alias("good")))
    cutoffs = certified_cutoffs(judged.where(~F.col("base_failed")).join(label, "id"), risk, delta).collect()
    rejects = [F.when((F.col("stratum") == r["stratum"]) & (F.col(r["rule"]) > r["cutoff"]), F.lit(r["rule"]))
               for r in cutoffs]  # at most strata x rules
    rules = F.array_compact(F.array(*rejects)) if rejects else F.array().cast("array<string>")
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & (F.size(rules) == 0)).alias("kept"), rules.alias("rules"))
