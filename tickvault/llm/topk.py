"""Exact top-k search by inner product over whole tables of vectors.

Components become integers ``floor(SCALE * x)``; a score is the integer inner product.

* Vectors are put in order of descending length and packed into blocks of about ``BLOCK_BYTES``;
  ``GROUP_BLOCKS`` successive blocks at most are a group. Queries are packed in any order.
* Axes are rotated by the singular vectors of the whole table (from the sums of component products, one
  pass), so that the first few rotated components, the head, carry most of an inner product.
* The longest vectors (block 0) give every query a first k-th best score. With it a query needs no group whose
  longest vector is too short to reach it (Cauchy-Schwarz on whole vectors). Inside a group, blocks go by
  descending length; a pair's score is at most its head's partial sum plus the product of the two
  residual lengths (Cauchy-Schwarz on the rest), and only pairs that can reach the query's k-th best
  so far are computed, exactly.
* A task holds one group (at most GROUP_BLOCKS blocks) and reads query blocks one after the other, at most
  ``SLICE_BLOCKS`` of them. Only scores that can still count leave it; the best k of each query are taken by Spark.

A query's own rows are those with its vec_id; they are no candidates of it. Every query row is ranked on
its own, also if its id is repeated, and repeated candidate rows count one by one. Vectors that are null or hold
null or non-finite components, and rows without vec_id, take no part. Shorter vectors count as filled up
with zeros; an empty vector is a zero vector. Components and scores beyond the range of long are held at
its ends. A query without candidates has no row. Empty table: empty result. Extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickvault.llm.common import drop_stages, ship, stage

ship(__name__)

K, SCALE, EVERY = 5, 256, 50
#: PART_BLOCKS: blocks that a task packs, about.
BLOCK_BYTES, GROUP_BLOCKS, SLICE_BLOCKS, PART_BLOCKS = 1 << 20, 64, 256, 4
#: Share of the squared lengths that the head's axes carry.
HEAD = 0.8
#: Vectors of more components are not rotated: the products of components would outgrow the driver.
MAX_ROTATED = 512
#: Components multiplied together; tasks of the search, at most; the least long.
CELLS, MAX_TASKS, LEAST = 1 << 21, 20_000, np.int64(-2**63)


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector array<bigint>, length double) of the rows that take part."""
    x = F.transform(F.col(vector).cast("array<double>"), lambda v: F.floor(v * F.lit(float(SCALE))).cast("long"))
    odd = F.exists(vector, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    good = df.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).filter(~odd)
    good = good.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return good.withColumn("length", F.sqrt(square))


def _matrix(vectors, dims: int) -> np.ndarray:
    """Rows of one matrix, shorter vectors filled up with zeros."""
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def rotation(vectors: DataFrame, dims: int) -> tuple[np.ndarray, int]:
    """The axes (columns, by falling share of the squared lengths) and the number that make the head."""
    if not 0 < dims <= MAX_ROTATED:
        return np.eye(max(dims, 1)), max(dims, 1)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims, dims))
        for pdf in batches:
            m = _matrix(pdf["vector"], dims).astype(float)
            total += m.T @ m
        yield pd.DataFrame({"axis": np.arange(dims), "row": list(total)})
    each = vectors.select("vector").mapInPandas(products, "axis int, row array<double>")
    sums = each.select("axis", F.posexplode("row").alias("other", "value")).groupBy("axis", "other").agg(F.sum("value").alias("value"))
    rows = sums.collect()                                                # dims x dims, at most MAX_ROTATED squared
    gram = np.zeros((dims, dims))
    for r in rows:
        gram[r.axis, r.other] = r.value
    if not np.isfinite(gram).all():
        return np.eye(dims), dims
    weight, axes = np.linalg.eigh(gram)
    weight, axes = np.clip(weight[::-1], 0, None), axes[:, ::-1]
    carried = np.cumsum(weight) / max(weight.sum(), 1e-300)
    return np.ascontiguousarray(axes), int(min(np.searchsorted(carried, HEAD) + 1, dims))


def _blocks(vectors: DataFrame, dims: int, per_group: int, by_length: bool, name: str, spent: list[str]) -> DataFrame:
    """The vectors in blocks, staged: (group, at, vec_id, vector, longest). ``by_length``: in order of descending length;
    groups of at most ``per_group`` successive blocks are numbered in that order, blocks inside them by ``at``."""
    rows = max(1, BLOCK_BYTES // (8 * max(dims, 1)))
    parts = max(1, -(-vectors.count() // (rows * PART_BLOCKS)))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, done, ids, held, longest = TaskContext.get().partitionId(), 0, [], [], 0.0

        def block() -> pd.DataFrame:
            return pd.DataFrame({"group": [(part << 32) + done // per_group], "at": [done], "vec_id": [np.array(ids, np.int64)],
                                 "vector": [_matrix(held, dims).tobytes()], "longest": [longest]})
        for pdf in batches:
            for i, v, length in zip(pdf["vec_id"], pdf["vector"], pdf["length"]):
                longest = max(longest, length) if ids else length
                ids.append(i)
                held.append(v)
                if len(ids) == rows:
                    yield block()
                    done, ids, held = done + 1, [], []
        if ids:
            yield block()
    order = [F.desc("length"), F.asc("vec_id"), F.asc("__n")]            # __n: rows alike in both are dealt out too
    dealt = vectors.withColumn("__n", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order) if by_length else dealt.repartition(parts)
    packed = dealt.select("vec_id", "vector", "length").mapInPandas(pack, "group bigint, at int, vec_id array<bigint>, vector binary, longest double")
    return stage(packed, name, spent)


class Block:
    """Vectors of one block, rotated: head components, lengths and what the head leaves of them."""

    def __init__(self, vec_id, vector: bytes, dims: int, axes: np.ndarray, head: int):
        self.ids = np.asarray(vec_id, np.int64)
        self.ints = np.frombuffer(vector, np.int64).reshape(len(self.ids), dims)
        self.real = self.ints.astype(float)
        square = (self.real * self.real).sum(axis=1)
        self.head, self.length = self.real @ axes[:, :head], np.sqrt(square)
        self.rest = np.sqrt(np.clip(square - (self.head**2).sum(axis=1), 0, None) + 1e-9 * square)    # rounded up


class Best:
    """The k best of each query of a block so far, greater scores first, then smaller ids. ``floor``: the least
    score that still counts, for each query."""

    def __init__(self, queries: Block, k: int, floor: np.ndarray | None = None):
        self.queries, self.k = queries, k
        self.floor = np.full(len(queries.ids), LEAST) if floor is None else np.array(floor, np.int64)
        self.query, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        query, score, vec_id = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, vec_id)))
        order = np.lexsort((vec_id, ~score, query))                      # ~score: falling, without overflow
        query, score, vec_id = query[order], score[order], vec_id[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep, last = rank < self.k, rank == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        self.query, self.score, self.id = query[keep], score[keep], vec_id[keep]

    def search(self, block: Block) -> int:
        """Add a block's candidates, longest first. Returns the number of pairs computed exactly."""
        q, at, step, computed = self.queries, 0, 16, 0
        while at < len(block.ids):
            part = slice(at, at + step)
            # partial sums, Cauchy-Schwarz on the rest, and room for rounding
            bound = q.head @ block.head[part].T + q.rest[:, None] * block.rest[None, part]
            bound = np.maximum(bound + 1e-9 * q.length[:, None] * block.length[None, part] + 1e-3, float(LEAST))
            floor = self.floor.astype(float)
            i, j = np.nonzero((bound >= (floor - 1e-9 * np.abs(floor))[:, None]) & (q.ids[:, None] != block.ids[None, part]))
            few = max(1, CELLS // max(q.ints.shape[1], 1))
            # many pairs left (no floor yet): all of this part at once is cheaper, where floats are exact
            dense = q.real @ block.real[part].T if len(i) * 16 > bound.size and exact_in_floats(q.real, block.real) else None
            for a in range(0, len(i), few):
                of, to = i[a:a + few], at + j[a:a + few]
                s = products(q.ints[of], block.ints[to]) if dense is None else dense[of, to - at].astype(np.int64)
                ok = s >= self.floor[of]
                self.add(of[ok], s[ok], block.ids[to[ok]])
            computed += len(i)
            at, step = at + step, min(2 * step, max(16, (1 << 20) // len(q.ids)))
        return computed

    def needs(self, longest: float) -> np.ndarray:
        """Which queries can gain from vectors no longer than ``longest``."""
        floor = self.floor.astype(float)
        return self.queries.length * longest * (1 + 1e-9) + 1e-3 >= floor - 1e-9 * np.abs(floor)


def exact_in_floats(x: np.ndarray, y: np.ndarray) -> bool:
    """Are inner products of these rows of whole numbers, and all partial sums, exact as floats?"""
    return float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(x.shape[1], 1) < 2.0**53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows, held in the range of long."""
    x, y = a.astype(float), b.astype(float)
    if exact_in_floats(x, y):
        return np.einsum("ij,ij->i", x, y).astype(np.int64)
    exact = (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.array([min(max(int(s), -2**63), 2**63 - 1) for s in exact], np.int64)


def top_products(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` for each row of ``queries`` (both as
    ``integer_vectors`` gives them)."""
    spark, spent = vectors.sparkSession, []
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    dims = vectors.agg(F.max(F.size("vector"))).first()[0]
    asked = queries.agg(F.max(F.size("vector"))).first()[0]
    if dims is None or asked is None:
        return spark.createDataFrame([], schema)
    dims = max(dims, asked, 1)
    try:
        axes, head = rotation(vectors, dims)
        blocks = _blocks(vectors, dims, GROUP_BLOCKS, True, "topk-blocks", spent)
        asking = _blocks(queries, dims, SLICE_BLOCKS, False, "topk-queries", spent)
        groups = blocks.groupBy("group").agg(F.max("longest").alias("longest")).orderBy("group").collect()   # one row for GROUP_BLOCKS blocks
        slices = [r[0] for r in asking.select("group").distinct().collect()]                                # one for SLICE_BLOCKS blocks of queries
        first = blocks.filter((F.col("group") == groups[0].group) & (F.col("at") == 0)).select("vec_id", "vector").first()   # one block
        names, longest = np.array([g.group for g in groups]), np.array([g.longest for g in groups])

        def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            longest_vectors = Block(first.vec_id, first.vector, dims, axes, head)
            for pdf in batches:
                for group, at, vec_id, vector in zip(pdf["group"], pdf["at"], pdf["vec_id"], pdf["vector"]):
                    best = Best(Block(vec_id, vector, dims, axes, head), k)
                    best.search(longest_vectors)
                    needed = names[[bool(best.needs(x).any()) for x in longest]]
                    yield pd.DataFrame({"slice": [group], "at": [at], "vec_id": [vec_id], "vector": [vector], "floor": [best.floor], "groups": [needed]})

        started = asking.select("group", "at", "vec_id", "vector").mapInPandas(
            start, "slice bigint, at int, vec_id array<bigint>, vector binary, floor array<bigint>, groups array<bigint>")
        asked_of = started.select(F.explode("groups").alias("group"), "slice", F.lit(1).alias("asks"), "at", "vec_id", "vector", "floor")
        held = blocks.select("group", F.explode(F.lit(slices)).alias("slice"), F.lit(0).alias("asks"), "at", "vec_id", "vector", F.lit(None).cast("array<bigint>").alias("floor"))
        tasks = min(len(groups) * len(slices), MAX_TASKS)
        cells = held.unionByName(asked_of).repartition(tasks, "group", "slice").sortWithinPartitions("group", "slice", "asks", "at")

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cell, own = None, []
            for pdf in batches:
                for group, part, asks, at, vec_id, vector, floor in zip(*(pdf[c] for c in ("group", "slice", "asks", "at", "vec_id", "vector", "floor"))):
                    if cell != (group, part):
                        cell, own = (group, part), []
                    block = Block(vec_id, vector, dims, axes, head)
                    if not asks:
                        own.append(block)
                        continue
                    best = Best(block, k, floor)
                    for candidates in own:
                        if best.needs(float(candidates.length[0])).any():
                            best.search(candidates)
                    yield pd.DataFrame({"slice": part, "at": at, "row": best.query, "query_id": block.ids[best.query], "vec_id": best.id, "score": best.score})
        found = cells.mapInPandas(search, "slice bigint, at int, row bigint, query_id bigint, vec_id bigint, score bigint")
        rank = F.row_number().over(Window.partitionBy("slice", "at", "row").orderBy(F.desc("score"), "vec_id"))
        ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        return stage(ranked, "topk-found")
    finally:
        drop_stages(spark, spent)


def search_digest(table: DataFrame) -> DataFrame:
    """The best rows for every row whose vec_id is divisible by ``EVERY``, against the whole table."""
    spent: list[str] = []
    try:
        vectors = stage(integer_vectors(table), "topk-vectors", spent)
        return top_products(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))
    finally:
        drop_stages(table.sparkSession, spent)
