"""A stored inverted index of posts with BM25 ranking (O3 relevance, K6).

``path/docs``: one row per post (id, number of words, its words with their counts), in buckets of ids;
``path/postings``: (term, post, count, post's length), in buckets of terms. ``update_index`` merges a batch:

1. the batch's words are counted and compared with what is stored of the same posts (by a digest); posts that
   did not change (most re-fetched ones) go no further;
2. the buckets of the words that the others had or have are the only ones read and rewritten: stored
   postings without the batch's posts (anti join, ids broadcast by size) plus the new ones;
3. then the posts' rows are replaced. A job that dies before that finds the old words again, so the
   repeated merge touches the same buckets and gives the same index.

A frequent word's postings are rows like any others, written in as many files as their size needs. A search
shuffles the asked words' postings once, by post, whatever number of queries ask for them; scores are summed
and cut per query there.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickvault.operators.topn import top_n_per_group
from tickvault.session import delete_path, path_exists, scratch_path
from tickvault.sinks.merge import overwrite_partitions

TERM = T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())])
DOCS = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("length", T.IntegerType()),
                     T.StructField("terms", T.ArrayType(TERM)), T.StructField("bucket", T.IntegerType())])
POSTINGS = T.StructType([T.StructField("term", T.StringType()), T.StructField("doc_id", T.StringType()), T.StructField("tf", T.IntegerType()),
                         T.StructField("length", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
BUCKETS = 64                    # of terms and of posts; fixed when an index is made (at 100 TB: thousands)
K1, B = 1.2, 0.75               # fixed values: the usual BM25 parameters
SCORE_DIGITS = 6
SALT_BUCKETS = 16
BROADCAST_ASKED = 1_000_000     # most (query, word) pairs that are broadcast to the postings
BROADCAST_IDS = 2_000_000       # most changed posts of a merge whose ids are broadcast to what is stored


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def _bucket(c: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int").alias("bucket")


def counted(batch: DataFrame, doc_id: str, text: Column, buckets: int) -> DataFrame:
    """DOCS rows of a batch; of several rows of one id the longest text counts (ties: the greatest)."""
    one = batch.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("string").alias("doc_id")).agg(
        F.max_by(text, F.struct(F.length(text), text)).alias("text"))
    each = one.select("doc_id", F.explode_outer(words(F.col("text"))).alias("term")).groupBy("doc_id", "term").agg(F.count("term").cast("int").alias("tf"))
    packed = F.sort_array(F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "tf"))))         # a text's distinct words
    return each.groupBy("doc_id").agg(F.sum("tf").cast("int").alias("length"), packed.alias("terms")).withColumn("bucket", _bucket("doc_id", buckets))


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(docs, postings); empty and typed before the first merge."""
    read = lambda name, schema: (spark.read.schema(schema).parquet(f"{path}/{name}") if path_exists(spark, f"{path}/{name}")
                                 else spark.createDataFrame([], schema))
    return read("docs", DOCS), read("postings", POSTINGS)


def _digest(terms: Column) -> Column:
    return F.sha2(F.to_json(terms), 256)


def _buckets_of(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select("bucket").distinct().collect())          # at most the number of buckets


def update_index(batch: DataFrame, path: str, doc_id: str = "submission_id", text: str = "selftext", buckets: int = BUCKETS) -> dict:
    """Merge the posts of ``batch`` (null or wordless text: the post leaves the index). Returns how many posts
    changed and which term buckets were rewritten."""
    spark, stages = batch.sparkSession, []

    def staged(df: DataFrame) -> DataFrame:
        stages.append(scratch_path(spark, "index"))
        df.write.parquet(stages[-1])
        return spark.read.schema(df.schema).parquet(stages[-1])
    try:
        docs, postings = read_index(spark, path)
        batch = batch.filter(F.col(doc_id).isNotNull())
        at = _buckets_of(batch.select(F.col(doc_id).cast("string").alias("doc_id")).select(_bucket("doc_id", buckets)))
        # a stored post is compared by the digest of its words and counts; only that and its words' buckets are shuffled
        bucket_of = F.array_distinct(F.transform("terms", lambda t: F.pmod(F.xxhash64(t["term"]), F.lit(buckets)).cast("int")))
        had = docs.filter(F.col("bucket").isin(at)).select("doc_id", _digest(F.col("terms")).alias("was"), bucket_of.alias("old"))
        none = _digest(F.array().cast(DOCS["terms"].dataType))
        fresh = counted(batch, doc_id, F.col(text), buckets)
        changed = fresh.join(had, "doc_id", "left").filter(F.coalesce(F.col("was"), none) != _digest(F.col("terms")))
        changed = staged(changed.select(*DOCS.fieldNames(), F.array_union(F.coalesce("old", F.array().cast("array<int>")), bucket_of).alias("touched")))
        touched = _buckets_of(changed.select(F.explode("touched").alias("bucket")))
        if not touched:
            return {"posts": 0, "buckets": []}
        n = changed.count()
        ids = F.broadcast(changed.select("doc_id")) if n <= BROADCAST_IDS else changed.select("doc_id")
        new = changed.select(F.explode("terms").alias("t"), "doc_id", "length").select("t.term", "doc_id", "t.tf", "length").withColumn("bucket", _bucket("term", buckets))
        kept = postings.filter(F.col("bucket").isin(touched)).join(ids, "doc_id", "left_anti").select(*POSTINGS.fieldNames())
        merged = staged(kept.unionByName(new))
        # a bucket left without postings is one that dynamic overwrite does not see: it is deleted
        emptied = sorted(set(touched) - set(_buckets_of(merged)))
        overwrite_partitions(merged.repartitionByRange("bucket", "term", "doc_id"), f"{path}/postings", "bucket", clustered=True)
        at = _buckets_of(changed)
        rest = docs.filter(F.col("bucket").isin(at)).join(ids, "doc_id", "left_anti").select(*DOCS.fieldNames())
        now = staged(rest.unionByName(changed.filter("length > 0").select(*DOCS.fieldNames())))
        emptied_docs = sorted(set(at) - set(_buckets_of(now)))
        overwrite_partitions(now.repartitionByRange("bucket", "doc_id"), f"{path}/docs", "bucket", clustered=True)
        for name, gone in (("postings", emptied), ("docs", emptied_docs)):
            for b in gone:
                delete_path(spark, f"{path}/{name}/bucket={b}")
        return {"posts": n, "buckets": touched}
    finally:
        for p in stages:
            delete_path(spark, p)


def bm25_search(spark: SparkSession, path: str, queries: DataFrame, n: int, query_id: str = "query_id", text: str = "text",
                buckets: int = BUCKETS) -> DataFrame:
    """(query_id, doc_id, score, rank): the ``n`` best posts of each query by BM25, ties by id. A query's words count
    once each. Collection figures (posts, mean length, posts per word) are those of the stored index."""
    docs, postings = read_index(spark, path)
    asked = (queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(words(F.col(text)))).alias("term"))
             .withColumn("bucket", _bucket("term", buckets)))
    wanted = asked.select("bucket", "term").distinct()
    found = postings.join(wanted, ["bucket", "term"], "left_semi")       # partition pruning where the words are few
    df = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = docs.agg(F.count(F.lit(1)).cast("double").alias("posts"), F.avg("length").alias("mean")).first()       # one row
    if not total.posts:
        return spark.createDataFrame([], T.StructType([queries.schema[query_id], T.StructField("doc_id", T.StringType()),
                                                       T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]).simpleString())
    idf = F.log(1 + (F.lit(total.posts) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(total.mean)))
    # stored, so that Spark knows its size: one row per query and word
    asked_path = scratch_path(spark, "asked")
    asked.select("query_id", "term").join(df.select("term", idf.alias("idf")), "term").write.parquet(asked_path)
    weights = spark.read.schema(T.StructType([T.StructField("term", T.StringType()), T.StructField("query_id", queries.schema[query_id].dataType),
                                              T.StructField("idf", T.DoubleType())])).parquet(asked_path)
    if weights.count() <= BROADCAST_ASKED:
        # a posting is shuffled once, to its post, and there meets every query that asks for its word: scores need no further shuffle
        weights = F.broadcast(weights)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = found.select("doc_id", "term", weight.alias("w")).repartition(tasks, "doc_id")
    else:
        found = found.select("doc_id", "term", weight.alias("w"))
    scored = found.join(weights, "term").groupBy("query_id", "doc_id").agg(F.round(F.sum(F.col("idf") * F.col("w")), SCORE_DIGITS).alias("score"))
    return top_n_per_group(scored, ["query_id"], [F.col("score").desc(), F.col("doc_id")], n, salt_on=["doc_id"], salt_buckets=SALT_BUCKETS)
