"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Statistics of every whole text feed rules of the form "reject above a cutoff". Each
rule has a fixed ladder of cutoffs, from harmless to strict, and each stratum (one of
STRATA, or all other languages together) its own choice among them. Labelled documents
are in two folds. On the first each rule gets the cutoff that best separates the labels,
or none, and the rules an order, by how much they gain. On the second what counts is
what a stratum loses altogether: the rules are added in that order, and after each the
good documents that any of them rejects are tested against the limit with the exact
binomial tail, P(Bin(n, limit) <= k) at most delta over the number of strata
(Bonferroni). The first failure ends the sequence; such a fixed order of tests, set
before the fold is looked at, needs no further correction. With probability 1 - delta no
stratum loses more than the limit of its good documents to its rules. The base checks
are given and stand outside of this bound.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vectorloom.llm.common import narrow, stored

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STRATA = ("en", "de", "fr", "es")
#: Cutoffs of each rule, from harmless to strict.
LADDERS = {
    "symbols": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04),
    "upper": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1),
    "calls": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.04, 0.03),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
    "repeats": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
    "long_words": (60.0, 40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 15.0, 14.0, 13.0, 12.0, 11.0),
}
LIMIT, DELTA = 0.02, 0.1
#: What a false rejection weighs against a right one when a cutoff is chosen among those that pass.
REGRET = 10.0


def count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the rules' measures.

    Null texts are empty: all counts are 0. Repeated rows stay. Work stays within a row:
    3-word windows of a text are hashed and sorted there, so that equal ones are neighbours.
    """
    texts = narrow(docs, doc_id="long", lang="string", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    spaced = F.translate("text", WHITE[1:], " " * (len(WHITE) - 1))
    split = texts.select(
        "doc_id",
        F.when(F.col("lang").isin(*STRATA), F.col("lang")).otherwise("other").alias("stratum"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.char_length(F.translate("text", WHITE, "")).cast("long").alias("word_chars"),
        count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        count_of(F.col("text"), UPPER).cast("long").alias("n_upper"),
        count_of(F.col("text"), "!?").cast("long").alias("n_calls"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0).alias("lines"),
        F.array_remove(F.split(spaced, " "), "").alias("words"),
    )
    n = F.size("words")
    triples = F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, n).alias("b"), F.slice("words", 3, n).alias("c"))
    hashed = split.select(
        "doc_id", "stratum", "n_chars", "word_chars", "n_symbols", "n_upper", "n_calls",
        n.cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.transform(F.slice(triples, 1, F.greatest(n - 2, F.lit(1))), lambda x: F.xxhash64(x["a"], x["b"], x["c"]))).alias("windows"),
    )
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.withColumn("windows", F.when(some, F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    near = lambda x, i: (F.get("windows", i - 1)["h"] == x["h"]) | (F.get("windows", i + 1)["h"] == x["h"])
    repeated = ordered.withColumn("windows", F.sort_array(F.transform(F.filter("windows", lambda x, i: F.coalesce(near(x, i), F.lit(False))), lambda x: x["i"])))
    # each repeated window adds those of its three words that the one before it has not covered
    covered = F.aggregate(
        "windows",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, i: F.struct((s["n"] + i + 3 - F.greatest(i, s["end"])).alias("n"), (i + 3).alias("end")),
        lambda s: s["n"],
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    counted = repeated.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return counted.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", "n_chars").alias("symbols"), share("n_upper", "n_chars").alias("upper"), share("n_calls", "n_chars").alias("calls"),
        share("n_dup_lines", "n_lines").alias("dup_lines"), share("n_repeat_words", "n_words").alias("repeats"), share("word_chars", "n_words").alias("long_words"),
    )


def binomial_tail(k: Column, n: Column, limit: float) -> Column:
    """P(Bin(n, limit) <= k), summed exactly in logarithms; 1 where k is above the mean, since no test passes there."""
    ratio = log(limit / (1 - limit))
    start = F.struct((n * log(1 - limit)).alias("term"), (n * log(1 - limit)).alias("sum"))

    def step(s, i):
        term = s["term"] + F.log((n - i + 1) / i) + ratio
        high, low = F.greatest(term, s["sum"]), F.least(term, s["sum"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    steps = F.when(k >= 1, F.sequence(F.lit(1), F.greatest(k, F.lit(1)).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.when(k > n * limit, 1.0).otherwise(F.aggregate(steps, start, step, lambda s: F.exp(s["sum"])))


def cutoffs(measured: DataFrame, labels: DataFrame, limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """stratum, rule, cutoff, step, n_good, false_rejections, p_value of the chosen cutoffs; the last three of the rules up to this one together.

    Labelled holdouts are the rows whose crc32(doc_id) mod 3 is 0 (first fold) or 2
    (second); a document with several labels has the least; labels other than 0 and 1 and
    null ids are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3).filter(F.col("quality").isin(0, 1) & (F.col("fold") != 1))
    known = known.groupBy("doc_id", "fold").agg(F.min("quality").alias("quality"))
    rows = stored(measured.join(known, "doc_id").select("stratum", "quality", "fold", *LADDERS))  # labelled documents only, numbers only
    size = len(next(iter(LADDERS.values())))
    # the first cutoff of the ladder that rejects, size if none does
    rung = lambda rule: sum((F.col(rule) <= c).cast("int") for c in LADDERS[rule])
    first = rows.filter("fold = 0").select("stratum", "quality", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), rung(r).alias("rung")) for r in LADDERS))).alias("x"))
    counts = first.groupBy("stratum", "x.rule").agg(
        F.greatest(F.sum("quality"), F.lit(1)).alias("n_good"),
        F.greatest(F.sum(1 - F.col("quality")), F.lit(1)).alias("n_bad"),
        F.array(*(F.sum(F.when(F.col("x.rung") <= g, F.col("quality")).otherwise(0)) for g in range(size))).alias("good"),
        F.array(*(F.sum(F.when(F.col("x.rung") <= g, 1 - F.col("quality")).otherwise(0)) for g in range(size))).alias("bad"),
    )
    steps = counts.select("stratum", "rule", "n_good", "n_bad", F.posexplode(F.arrays_zip("good", "bad")).alias("rung", "x"))
    gain = F.col("x.bad") / F.col("n_bad") - REGRET * F.col("x.good") / F.col("n_good")
    best = steps.withColumn("gain", gain).filter("gain > 0").groupBy("stratum", "rule").agg(F.max_by("rung", F.struct("gain", -F.col("rung"))).alias("rung"), F.max("gain").alias("gain"))
    values = F.create_map(*(x for r, steps in LADDERS.items() for x in (F.lit(r), F.array(*map(F.lit, steps)))))
    best = best.withColumn("cutoff", F.get(values[F.col("rule")], F.col("rung")))
    best = best.withColumn("step", F.row_number().over(Window.partitionBy("stratum").orderBy(F.col("gain").desc(), "rule")))  # strata times rules, 30 at most
    ordered = best.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("step", "rule", "cutoff"))).alias("chosen"))
    # the step of the first rule that rejects a document of the second fold
    measures = F.create_map(*(x for r in LADDERS for x in (F.lit(r), F.col(r))))
    hit = F.get(F.filter("chosen", lambda x: F.col("measures")[x["rule"]] > x["cutoff"]), F.lit(0))["step"]
    second = rows.filter("fold = 2 and quality = 1").withColumn("measures", measures).join(F.broadcast(ordered), "stratum", "left").select("stratum", hit.alias("hit"))
    lost = second.groupBy("stratum").agg(F.count("*").alias("n_good"), *(F.count(F.when(F.col("hit") <= i + 1, 1)).alias(f"k{i}") for i in range(len(LADDERS))))
    lost = lost.withColumn("tests", F.count("*").over(Window.partitionBy(F.lit(1))))  # five strata at most
    tested = best.join(lost, "stratum").withColumn("false_rejections", F.element_at(F.array(*(F.col(f"k{i}") for i in range(len(LADDERS)))), F.col("step")))
    tested = tested.withColumn("p_value", binomial_tail(F.col("false_rejections"), F.col("n_good"), limit))
    passed = F.max("p_value").over(Window.partitionBy("stratum").orderBy("step")) <= F.lit(delta) / F.col("tests")
    return tested.withColumn("passed", passed).filter("passed").select("stratum", "rule", "cutoff", "step", "n_good", "false_rejections", "p_value")


def judged(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, rejected_by (rules, comma-joined) of every document.

    base_failed: fewer than 50 words, or over half of the words in repeated 3-word windows.
    """
    measured = stored(statistics(docs))
    chosen = cutoffs(measured, labels, limit, delta).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    joined = measured.join(F.broadcast(chosen), "stratum", "left")  # five strata at most
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    by = F.array_join(F.array(*(F.when(F.col(r) > F.col("cutoffs")[F.lit(r)], F.lit(r)) for r in sorted(LADDERS))), ",")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (by == "")).alias("kept"), by.alias("rejected_by"),
    )
