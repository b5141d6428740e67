"""Periodic runs of words, found by an online sparse dynamic program over diagonals.

Diagonal ``q`` matches word ``i`` with word ``i - q``. A run with smallest period ``q`` is a maximal
stretch of matches on diagonal ``q``, seen with the ``q`` words before it; it counts if it has at least
``LEAST`` words and ``REPEATS`` periods.

For each word its earlier occurrences would increment the match length of their lags, which is a square
number of steps for frequent words. It is kept sparse, with the same result, by comparing grams instead
of single words: for k = 1, 2, 4, ... the gram of the k words that end at a word looks up its *last*
earlier occurrence, and only lags in (k/2, k] count. Inside a run of period q <= k the last occurrence of
a gram of k words is exactly q words back (a nearer one would make the period smaller), and a run of four
periods has room for it. So at any word at most one lag for each k is active, every run appears on
exactly one k, and the steps are n log n at worst. Only words whose gram of k words occurs twice in their
text are looked at for 2k, so ordinary text is left after a few k.

The words of one text are numbered from 0; words are runs of anything but ASCII white space. Null text
has no words. Rows are independent: repeated and null ids are rows of their own, an empty table gives an
empty result, columns beyond id and text are ignored. Nothing is shuffled; a task holds one Arrow batch
and ``BATCH_WORDS`` words (a longer text alone).
"""
from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.llm.common import ship

ship(__name__)

LEAST, REPEATS = 6, 4
#: Words put through numpy together.
BATCH_WORDS = 1 << 18
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def lags(words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For k = 1, 2, 4, ...: the words at which the last earlier occurrence of the k-gram that ends there is
    (k/2, k] words back, in order, and that lag."""
    n, k = len(words), 1
    at, gram = np.arange(n), words
    while len(at):
        order = np.argsort(gram, kind="stable")
        place, same = at[order], np.zeros(len(at) + 1, bool)
        same[1:-1] = gram[order[1:]] == gram[order[:-1]]
        back = np.where(same[1:-1], place[1:] - place[:-1], 0)
        near = np.flatnonzero((back > k // 2) & (back <= k))
        ends = place[near + 1]
        in_order = np.argsort(ends)
        yield k, ends[in_order], back[near][in_order]
        # the 2k-gram at a word is the k-grams there and k words before; both must occur twice
        name, twice = np.full(n, -1), same[1:] | same[:-1]
        name[place[twice]] = (np.cumsum(~same[:-1]) - 1)[twice]
        at = np.flatnonzero(name >= 0)
        at = at[at >= k]
        at = at[name[at - k] >= 0]
        gram = name[at - k] * n + name[at]
        k *= 2


def runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period. ``words``: a number for each word."""
    found = []
    for k, ends, back in lags(words):
        last, lag, matched = -2, 0, 0
        for i, b in zip(itertools.chain(ends.tolist(), [-2]), itertools.chain(back.tolist(), [0])):
            if i == last + 1 and b == lag:
                matched += 1                                             # the active diagonal goes on
            else:                                                        # it ends: emit, and open another
                length = matched + k - 1 + lag
                if lag and length >= max(LEAST, REPEATS * lag):
                    found.append((last + 1 - length, length, lag))
                lag, matched = b, 1
            last = i
    return sorted(found, key=lambda r: (r[0], r[2]))


def tile(words: list[bytes], seed: int) -> list[bytes]:
    """The text made periodic: from word ``g % n`` on, the words there repeat (``g`` = seed without its last digit)."""
    n, g = len(words), seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _batch_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``runs`` of several texts at once: words of different texts get different numbers."""
    names: defaultdict = defaultdict(itertools.count().__next__)
    numbers = np.fromiter(map(names.__getitem__, itertools.chain.from_iterable(texts)), np.int64)
    starts = np.cumsum([0] + [len(t) for t in texts])
    text_of = np.repeat(np.arange(len(texts)), np.diff(starts))
    out: list = [[] for _ in texts]
    for s, length, q in runs(numbers + text_of * max(len(names), 1)):
        t = int(text_of[s])
        out[t].append((s - int(starts[t]), length, q))
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that are in the first period of every run that holds them."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, q in found:
        keep[start + q:start + length] = False
    return [w for w, k in zip(words, keep.tolist()) if k]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: Column | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs by start, then period, and its text without
    their repetitions, words joined by one space. ``seed``: rows where it is a multiple of 10 are made
    periodic first (``tile``), to have runs of known shape; null: not."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(T._parse_datatype_string(RUN))), T.StructField("collapsed", T.BinaryType())])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def done(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = _batch_runs(texts)
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found]
        joined = [b" ".join(collapsed(w, f)) for w, f in zip(texts, found)]
        return pa.RecordBatch.from_arrays([ids, pa.array([len(w) for w in texts], pa.int64()), pa.array(rows, run_type), pa.array(joined, pa.binary())],
                                          names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first, size = [], 0, 0
            for i in range(batch.num_rows):
                words = (batch["text"][i].as_py() or b"").split()        # bytes: splits at ASCII white space only
                number = batch["seed"][i].as_py()
                if words and number is not None and number % 10 == 0:
                    words = tile(words, number)
                texts.append(words)
                size += len(words)
                if size >= BATCH_WORDS or i == batch.num_rows - 1:
                    yield done(batch.column("doc_id").slice(first, len(texts)), texts)
                    texts, first, size = [], i + 1, 0
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"),
                       (F.lit(None) if seed is None else seed).cast("long").alias("seed"))
    return rows.mapInArrow(run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def run_digest(docs: DataFrame) -> DataFrame:
    """Every document's number of runs, its run of greatest exponent and digests of its runs and of its collapsed
    text. Documents whose crc32 is a multiple of 10 are made periodic first; a null id has no crc32."""
    found = periodic_runs(docs, seed=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    # exact comparison of length / period; of equal exponents the first by start, then period stays
    higher = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    best = F.when(F.size("runs") > 0, F.aggregate("runs", F.element_at("runs", 1), lambda b, r: F.when(higher(b, r), r).otherwise(b)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))
