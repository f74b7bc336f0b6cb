"""Quality rules whose cutoffs carry a bound on false rejection.

Each rule compares one measure of a text with a cutoff from a fixed ladder; a
document goes if one rule or more rejects it. The labels are halved by a digest
of the id. On the tuning half each rule gets, for every stratum and tolerance
level, the cutoff that parts bad from good documents best among those rejecting at
most the level's share of the good ones (the most lenient on a tie). What the
holdout half tests is the whole set of rules, as the verdict uses it: with k of
its n good documents rejected, P(Binomial(n, risk) <= k) must not exceed the error
level divided by all tests (strata x levels, Bonferroni). So with probability
1 - error the share of good documents that the rules reject, beyond the base rule,
is at most ``risk`` in every stratum. Among the admitted levels the tuning half
picks the one that parts best. A stratum without one keeps what the base rule keeps.

Null texts count as no words; null strata are one stratum with the empty name;
null labels and labels without a document are not used; a document labelled
twice counts twice; without labels only the base rule applies. Repeated rows are
kept; columns beyond the named ones are left out of ``assess``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosestat.llm.shared import let, whole, written

WHITE = r"[\x20\x09-\x0D]+"
SIGNS = r"[#*$%&|<>]"
#: Measures in thousandths of words or characters, and the ladder of cutoffs: a value above the cutoff rejects.
RULES = {
    "signs_per_char": (("n_symbols", 1000, "word_chars"), (10, 20, 40, 60, 80, 100, 150, 200)),
    "repeats_per_word": (("n_repeat_words", 1000, "n_words"), (50, 100, 150, 200, 300, 400)),
    "copied_lines_per_line": (("n_dup_lines", 1000, "n_lines"), (100, 200, 300, 400, 500, 600)),
    "shouts_per_word": (("n_shouts", 1000, "n_words"), (50, 100, 200, 300, 500)),
}
RISK, ERROR = 0.02, 0.05
#: Tolerance levels: shares of the risk that all rules together may use up on the tuning half.
SHARES = (1.0, 0.5, 0.25, 0.125, 0.0)
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts")


def _covered(starts: Column, width: int) -> Column:
    """How many places windows of ``width`` at the sorted ``starts`` cover."""
    gaps = F.transform(starts, lambda s, i: F.when(i == 0, width).otherwise(F.least(s - F.get(starts, i - 1), F.lit(width))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)


def repeated_words(words: Column) -> Column:
    """Words inside windows of three words that occur twice or more in ``words``, first ones included.

    Hashes of all windows, sorted, tell at once that nothing repeats. Otherwise
    the windows themselves are sorted with their places and compared.
    """
    n = F.size(words) - 2
    hashes = F.sort_array(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    alike = let(hashes, lambda h: F.exists(F.sequence(F.lit(1), F.size(h) - 1), lambda i: F.get(h, i) == F.get(h, i - 1)))
    placed = F.array_sort(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("window"), i.alias("at"))))
    starts = let(placed, lambda p: F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), n - 1), lambda i: (F.get(p, i)["window"] == F.get(p, i + 1)["window"]) | ((i > 0) & (F.get(p, i)["window"] == F.get(p, i - 1)["window"]))),
        lambda i: F.get(p, i)["at"])))
    return F.when(n < 2, F.lit(0).cast("long")).when(alike, let(starts, lambda s: _covered(s, 3))).otherwise(F.lit(0).cast("long"))


def measure(text: Column) -> Column:
    """A struct of ``FEATURES`` of a text; words are runs of anything but ASCII white space."""
    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.regexp_replace(x, WHITE, "")) > 0)
        return let(F.filter(F.split(t, WHITE), lambda w: w != ""), lambda words: let(lines, lambda ls: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(SIGNS)).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(ls).cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: w.endswith("!!"))).cast("long").alias("n_shouts"))))
    return let(whole(text), of)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def exceeds(rule: str, cutoff: Column) -> Column:
    """Whether a document's measure is above ``cutoff`` (null: no cutoff, false); whole numbers only."""
    (part, scale, per), _ = RULES[rule]
    return F.coalesce(F.col(part) * scale > cutoff * F.col(per), F.lit(False))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed in logarithms term by term; 1 where k is above the mean."""
    ratio = F.log(F.lit(p / (1 - p)))
    first = n * F.log1p(F.lit(-p))
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + ratio
        top = F.greatest(term, a["total"])
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(F.least(term, a["total"]) - top))).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.exp(F.aggregate(steps, start, step)["total"]))


def _counts(out: str) -> list[Column]:
    """Of labelled rows: good and bad documents of the tuning half, and how many of them go."""
    tuning = {"good": F.col("good") & ~F.col("held"), "bad": ~F.col("good") & ~F.col("held")}
    return [F.count(F.when(which & also, 1)).alias(name + end) for name, which in tuning.items()
            for end, also in (("_n", F.lit(True)), ("_out", F.col(out)))]


GAIN = "bad_out * good_n - good_out * bad_n"


def _candidates(used: DataFrame, risk: float) -> DataFrame:
    """(stratum, level, a cutoff per rule or null): the cutoffs that the tuning half proposes."""
    tries = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).cast("long").alias("cutoff"), exceeds(r, F.lit(c)).alias("out"))
                      for r, (_, ladder) in RULES.items() for c in ladder])
    counted = (used.select("stratum", "good", "held", F.explode(tries).alias("t")).select("stratum", "good", "held", "t.*")
               .groupBy("stratum", "rule", "cutoff").agg(*_counts("out")))
    levels = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(ppm).cast("long").alias("ppm")) for i, ppm in enumerate(tolerances(risk))])
    kept = counted.select("*", F.expr(GAIN).alias("gain"), F.explode(levels).alias("at")).where(
        "gain > 0 and good_out * 1000000 <= good_n * at.ppm")
    best = kept.groupBy("stratum", "at.level", "rule").agg(F.max(F.struct("gain", "cutoff"))["cutoff"].alias("cutoff"))
    return best.groupBy("stratum", "level").pivot("rule", list(RULES)).agg(F.max("cutoff"))


def tolerances(risk: float) -> list[int]:
    """By level, how many of a million good documents of the tuning half one rule may reject."""
    return [int(risk * 1_000_000 * share) // len(RULES) for share in SHARES]


def _rejected() -> Column:
    out = F.lit(False)
    for rule in RULES:
        out = out | exceeds(rule, F.col(rule))
    return out


def cutoffs(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label_key: str = "doc_id", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum with a cutoff per rule (null: none), from the labels (``label_key``, quality 0 or 1)."""
    known = labels.where("quality is not null").select(F.col(label_key).alias("label_key"), (F.col("quality") == 1).alias("good"))
    used = (measured.where(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).join(known, F.col(key) == F.col("label_key"))
            .select("stratum", "good", *FEATURES, (F.substring(F.md5(F.col(key).cast("string")), 1, 1) >= "8").alias("held")))
    proposed = written(_candidates(used, risk), "proposed")  # some rows a stratum: met by the labelled documents where they are
    on_holdout = [F.count(F.when(F.col("good") & F.col("held") & also, 1)).alias(name) for name, also in (("n", F.lit(True)), ("k", F.col("out")))]
    tested = used.join(proposed, "stratum").withColumn("out", _rejected()).groupBy("stratum", "level", *RULES).agg(*on_holdout, *_counts("out"))
    # all tests at once: the rows of this small table, some levels for each stratum
    admitted = (tested.withColumn("tests", F.count("*").over(Window.partitionBy(F.lit(0))))
                .where(binomial_tail(F.col("k"), F.col("n"), risk) <= F.lit(error) / F.col("tests")))
    best = admitted.withColumn("gain", F.expr(GAIN)).where("gain > 0").groupBy("stratum").agg(F.max(F.struct("gain", "level", *RULES)).alias("b"))
    return best.select("stratum", *[F.col("b")[r].alias(r) for r in RULES])


def _measured(df: DataFrame, own: list[Column], text: str, stratum: str) -> DataFrame:
    names = [f"own_{i}" for i in range(len(own))]
    rows = df.select(*[c.alias(n) for c, n in zip(own, names)], df[text].alias("text_"), whole(df[stratum].cast("string")).alias("stratum"))
    return rows.withColumn("m_", measure(F.col("text_"))).select(*names, "stratum", *[F.col("m_")[f].alias(f) for f in FEATURES])


def _verdict() -> Column:
    return ~(base_failed(F.col("n_words"), F.col("n_repeat_words")) | _rejected())


def _judged(df: DataFrame, labels: DataFrame, own: list[Column], key: str, text: str, stratum: str, risk: float, error: float) -> DataFrame:
    """own_0 (the key) and the other columns of ``own``, the measures and the cutoffs of the stratum.

    The texts are measured once; what is written to the shared folder serves the
    cutoffs and the verdicts. Cutoffs are one short row per stratum.
    """
    measures = written(_measured(df, own, text, stratum), "measures")
    limits = written(cutoffs(measures, labels, "own_0", key, risk, error), "cutoffs")
    return measures.join(limits, "stratum", "left")


def assess(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = RISK,
           error: float = ERROR) -> DataFrame:
    """``key``, the measures, ``base_failed`` and ``kept`` of every document."""
    return _judged(df, labels, [df[key]], key, text, stratum, risk, error).select(
        F.col("own_0").alias(key), *FEATURES, base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"), _verdict().alias("kept"))


def passing(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = RISK,
            error: float = ERROR) -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns.

    Rows are written beside their measures and read again with the verdict: a
    write in place of a second measuring or of a shuffle of the texts.
    """
    row = F.struct(*[df[c] for c in df.columns])
    return _judged(df, labels, [df[key], row], key, text, stratum, risk, error).where(_verdict()).select("own_1.*")
