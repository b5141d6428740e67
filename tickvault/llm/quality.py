"""Quality rules whose cutoffs are chosen under a guaranteed false-rejection risk.

Fixed base rule: texts of fewer than 10 words, or with more than 20 % of their words inside
repeated 5-word windows, fail. On top of it each feature rule ("reject if the feature is at least
the cutoff") gets one cutoff per stratum from labelled documents:

* for every (stratum, feature, cutoff) the good documents it would reject are counted (k of n);
* the exact binomial tail P(Bin(n, ALPHA) <= k) is the p-value of "its false-rejection rate is over
  ALPHA"; a cutoff is certified if that p-value is at most DELTA / number of tests (Bonferroni over
  all strata, features and cutoffs);
* of the certified cutoffs the one with the largest net benefit (share of bad documents rejected
  less ``COST`` times the share of good ones) is used; without a certified, useful cutoff the
  feature rejects nothing in that stratum.

With probability 1 - DELTA every chosen cutoff rejects at most ALPHA of a stratum's good documents.

DataFrame functions only. Null text: no words. Nulls in the stratum form a stratum of their own.
Null labels count nowhere. Repeated rows are judged alike; ids may repeat or be null.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import drop_stages, let, stage

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
ALPHA, DELTA, COST = 0.02, 0.05, 5.0
#: Rejection cutoffs tried per feature, in the feature's own unit.
CUTOFFS = {
    "symbol_share": (0.02, 0.05, 0.1, 0.2, 0.4),        # symbols per word character
    "dup_line_share": (0.1, 0.2, 0.3, 0.5),             # repeated lines per line with a word
    "upper_share": (0.3, 0.5, 0.7, 0.9),                # words without a small letter, of words with a capital
    "pipe_share": (0.1, 0.2, 0.3, 0.5),                 # words that are a single non-letter
    "bang_share": (0.1, 0.2, 0.4, 0.6),                 # words ending in "!!"
}
TAIL_TERMS = 4096
_SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside a 5-word window that occurs at least twice in the text, the first included.

    Windows are compared by a 64-bit hash of their word hashes. Only texts in which a hash repeats
    are looked at further: equal hashes are found by sorting (hash, start) inside the row."""
    def covered(starts: Column) -> Column:
        step = lambda acc, s: F.struct(
            (s + WINDOW).alias("end"), (acc["n"] + F.least(F.lit(WINDOW), s + WINDOW - acc["end"])).alias("n"))
        return F.aggregate(starts, F.struct(F.lit(-WINDOW).alias("end"), F.lit(0).alias("n")), step, lambda acc: acc["n"])

    def repeated(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda p: covered(F.sort_array(F.transform(F.filter(p, lambda x, j: (
            (F.get(p, j - 1)["h"] == x["h"]) & (j > 0)) | F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))))

    def windows(h: Column) -> Column:
        at = lambda i, k: F.get(h, i + k)
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))

    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), lambda x: F.when(
            F.size(F.array_distinct(x)) == F.size(x), F.lit(0)).otherwise(repeated(x)))))


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base counts and the feature values of each whole text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = (df.withColumn("__w", words_of(F.col(text))).withColumn("__l", lines)
           .withColumns({
               "n_words": F.size("__w").cast("long"),
               "word_chars": F.length(F.regexp_replace(whole, _SPACE, "")).cast("long"),
               "n_symbols": F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long"),
               "n_lines": F.size("__l").cast("long"),
               "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
               "n_repeat_words": repeated_words(F.col("__w")).cast("long"),
               "__upper": F.size(F.filter("__w", lambda w: (F.upper(w) == w) & (F.lower(w) != w))),
               "__cased": F.size(F.filter("__w", lambda w: F.upper(w) != F.lower(w))),
               "__bare": F.size(F.filter("__w", lambda w: (F.length(w) == 1) & (F.upper(w) == F.lower(w)))),
               "__bang": F.size(F.filter("__w", lambda w: w.endswith("!!"))),
           }))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    n = F.col("n_words")
    return out.withColumns({
        "base_failed": (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n),
        "symbol_share": share(F.col("n_symbols"), F.col("word_chars")),
        "dup_line_share": share(F.col("n_dup_lines"), F.col("n_lines")),
        "upper_share": share(F.col("__upper"), F.col("__cased")),
        "pipe_share": share(F.col("__bare"), n),
        "bang_share": share(F.col("__bang"), n),
    }).drop("__w", "__l", "__upper", "__cased", "__bare", "__bang")


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series, after moving x up by 8 (error below 1e-10)."""
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    down = x
    for i in range(1, 8):
        down = down * (x + i)
    return series - F.log(down)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed downwards from k; a tail beyond TAIL_TERMS terms is bounded from
    above by its geometric series, so the value never falls short of the true one."""
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    odds = (1 - p) / p

    def step(acc: Column, j: Column) -> Column:
        i = k - j + 1                                     # from term i to term i - 1
        term = acc["term"] * i / (n - i + 1) * odds
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    steps = F.when(k > 0, F.sequence(F.lit(1), F.least(k, F.lit(float(TAIL_TERMS))).cast("int"))).otherwise(F.expr("CAST(array() AS array<int>)"))
    rest = F.greatest(k - TAIL_TERMS, F.lit(0.0))
    ratio = rest / (n - rest + 1) * odds
    return F.when(k >= n * p, 1.0).otherwise(F.least(F.lit(1.0), F.aggregate(
        steps, F.struct(top.alias("sum"), top.alias("term")), step, lambda acc: acc["sum"] + F.when(rest > 0, acc["term"] * ratio / (1 - ratio)).otherwise(0.0))))


def choose_cutoffs(labelled: DataFrame, stratum: str, spent: list[str], alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, feature, cutoff, p_value, ...) of the certified cutoffs in use, at most one per
    stratum and feature. ``labelled``: feature columns and ``good`` (true, false or null)."""
    grid = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(float(c)).alias("cutoff"), (F.col(f) >= c).alias("hit"))
                     for f, cs in CUTOFFS.items() for c in cs])
    count = lambda cond: F.count(F.when(cond, 1))
    hits = F.col("t.hit")
    tests = (labelled.filter("good IS NOT NULL").select(F.col(stratum).alias("stratum"), "good", F.explode(grid).alias("t"))
             .groupBy("stratum", F.col("t.feature").alias("feature"), F.col("t.cutoff").alias("cutoff"))
             .agg(count(F.col("good")).alias("n"), count(F.col("good") & hits).alias("k"),
                  count(~F.col("good")).alias("n_bad"), count(~F.col("good") & hits).alias("k_bad")))
    tests = stage(tests, "quality-tests", spent)
    m = max(1, tests.count())                             # tests made: strata x features x cutoffs
    scored = (tests.withColumn("p_value", binomial_tail(F.col("k"), F.col("n"), alpha))
              .withColumn("benefit", F.col("k_bad") / F.greatest("n_bad", F.lit(1)) - COST * F.col("k") / F.greatest("n", F.lit(1))))
    best = F.max_by(F.struct("cutoff", "p_value", "n", "k", "n_bad", "k_bad"), F.struct(F.col("benefit"), -F.col("cutoff")))
    return (scored.filter((F.col("p_value") <= delta / m) & (F.col("benefit") > 0))
            .groupBy("stratum", "feature").agg(best.alias("b")).select("stratum", "feature", "b.*"))


def judge_quality(docs: DataFrame, labelled_ids: DataFrame, stratum: str = "lang", doc_id: str = "doc_id",
                  text: str = "text", spent: list[str] | None = None) -> DataFrame:
    """``docs``' id, the base counts, the features, ``failed_rules`` and ``kept``.

    ``labelled_ids``: (doc_id, good) of some documents; if an id has several labels it counts as
    good only if all agree. The features are computed once, in a staged table without the texts."""
    own: list[str] = []
    feats = stage(features(docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("__stratum"), F.col(text).alias("text"))).drop("text"),
                  "quality", own)
    marks = labelled_ids.groupBy("doc_id").agg(F.min("good").alias("good"))
    held = feats.filter(~F.col("base_failed")).join(marks, "doc_id")
    cuts = choose_cutoffs(held, "__stratum", own)
    by_stratum = cuts.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("feature", "cutoff"))).alias("cuts"))   # one entry per feature
    by_stratum = stage(by_stratum, "quality-cuts", own)
    known = F.coalesce(F.col("cuts"), F.expr("CAST(map() AS map<string,double>)"))
    failed = F.filter(F.array(*[F.when(F.col(f) >= F.try_element_at(known, F.lit(f)), F.lit(f)) for f in CUTOFFS]), lambda x: x.isNotNull())
    out = (feats.join(by_stratum, F.col("__stratum").eqNullSafe(F.col("stratum")), "left")
           .withColumn("failed_rules", failed).drop("stratum", "cuts")
           .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).withColumnRenamed("__stratum", stratum))
    if spent is not None:
        spent.extend(own)
    return out
