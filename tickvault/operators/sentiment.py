"""Sentiment of posts by a lexicon learnt from labelled ones (§2.14, the index's ``sentiment_score``).

* ``learn``: every word of the labelled posts gets its smoothed log-odds between positive and negative posts
  (each post counts a word once, so a long post weighs no more than a short one). Words whose log-odds are within
  ``Z`` standard errors of zero say nothing and are dropped. One shuffle of (word, label) counts, combined
  map-side and staged; a word in a third of all posts is one row per task.
* ``score``: the mean weight of a post's lexicon words, the sign turned for words that follow a negation within
  ``SCOPE`` words, squeezed into (-1, 1); 0 without such words. A lexicon of up to ``BROADCAST_TERMS`` words is
  broadcast to the words where they are read, so one row per post is shuffled; with a larger one the words are
  counted per (post, word, turned) before they meet it.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from tickvault.session import scratch_path
from tickvault.sinks.text_index import words

PRIOR, Z, SCOPE, DIGITS = 0.5, 2.0, 3, 5
BROADCAST_TERMS = 500_000       # largest lexicon that is broadcast to the posts' words
# fixed values: words that negate, in the languages of the posts
NEGATIONS = ("not", "no", "never", "none", "nothing", "neither", "nor", "without", "cannot", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "sans",
             "nunca", "ni", "sin")


def learn(posts: DataFrame, labels: DataFrame, key: str = "submission_id", text: str = "text", positive: str = "positive") -> DataFrame:
    """(term, weight, z) from posts (key, text) and labels (key, positive boolean). A post that is labelled both ways
    counts as negative; null labels are ignored."""
    marks = labels.filter(F.col(positive).isNotNull()).groupBy(key).agg(F.min(positive).alias("_tv_positive"))
    seen = posts.join(marks, key).groupBy(key).agg(F.max_by(text, F.length(text)).alias("_tv_text"), F.first("_tv_positive").alias("_tv_positive"))
    terms = seen.select("_tv_positive", F.explode(F.array_distinct(words(F.col("_tv_text")))).alias("term"))
    count = lambda c: F.sum(c.cast("int")).cast("double")
    counts = terms.groupBy("term").agg(count(F.col("_tv_positive")).alias("p"), count(~F.col("_tv_positive")).alias("n"))
    spark, path = posts.sparkSession, scratch_path(posts.sparkSession, "word-counts")          # read twice
    counts.write.parquet(path)
    table = spark.read.schema(counts.schema).parquet(path)
    total = table.agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()        # one row
    odds = lambda c, whole: F.log((F.col(c) + PRIOR) / ((whole or 0.0) + PRIOR * total.v))
    weight = odds("p", total.p) - odds("n", total.n)
    z = weight / F.sqrt(1 / (F.col("p") + PRIOR) + 1 / (F.col("n") + PRIOR))
    return table.select("term", weight.alias("weight"), z.alias("z")).filter(F.abs("z") >= Z)


def turned_words(posts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, turned) of every word, turned if a negation is among the SCOPE words before it: the words are zipped
    with themselves moved by 1 to SCOPE places, which leaves no lambda to be run for each word."""
    with_words = posts.select(key, words(F.col(text)).alias("term"))
    none, before = F.lit(None).cast("string"), [f"_tv_before_{k}" for k in range(1, SCOPE + 1)]
    moved = [F.concat(F.array(*[none] * k), F.col("term")).alias(c) for k, c in enumerate(before, 1)]
    each = with_words.select(key, F.inline(F.arrays_zip("term", *moved))).filter(F.col("term").isNotNull())
    return each.select(key, "term", functools.reduce(Column.__or__, [F.coalesce(F.col(c).isin(*NEGATIONS), F.lit(False)) for c in before]).alias("turned"))


def score(posts: DataFrame, lexicon: DataFrame, key: str = "submission_id", text: str = "text", out: str = "sentiment_score") -> DataFrame:
    """(key, score, number of lexicon words) of every key of ``posts``; keys must be unique. Null text: 0."""
    each, weights = turned_words(posts, key, text), lexicon.select("term", "weight")
    if weights.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        hits = each.join(F.broadcast(weights), "term").withColumn("c", F.lit(1).cast("long"))
    else:
        hits = each.groupBy(key, "term", "turned").agg(F.count(F.lit(1)).alias("c")).join(weights, "term")
    signed = F.col("weight") * F.when(F.col("turned"), -1.0).otherwise(1.0) * F.col("c")
    mean = hits.groupBy(key).agg((F.sum(signed) / F.sum("c")).alias("m"), F.sum("c").alias("n_terms"))
    return (posts.select(key).join(mean, key, "left")
            .select(key, F.coalesce(F.round(F.col("m") / (1 + F.abs("m")), DIGITS), F.lit(0.0)).alias(out), F.coalesce("n_terms", F.lit(0)).alias("n_terms")))
