"""Near-duplicate documents by BagMinHash signatures of word-shingle multisets.

A text's elements are its lower-cased 5-word shingles with their multiplicities (texts of fewer words:
one shingle of all of them); two texts are near copies if the weighted Jaccard similarity of these
multisets is ``SIMILARITY`` or more, and classes are the connected components of that relation.

* Signatures: every element runs a Poisson process of points in (time, register, level). The weight
  axis is cut into levels [0,1), [1,2), [2,4), [4,8), ...; each level has its own process, seeded by
  (element, level) alone, at a rate in proportion to its height, and a point counts if its place on the
  axis lies below the element's weight. A register keeps the identity of its earliest point, so two
  registers agree with probability equal to the weighted Jaccard similarity. Points are drawn only
  up to the time by which all registers are filled, a few hundred per text instead of
  registers x elements.
* Candidates: ``BANDS`` bands of ``ROWS`` registers, one hash each (a pair at 0.8 shares a band with
  probability 0.9999). Equal texts are one node from the start.
* Verification (exact multiset overlap of the whole texts) first compares all nodes of a bucket with one
  centre, and all nodes that share a rare shingle with one of them; confirmed pairs give classes.
  Pairs of nodes of one class need no further look. Of the pairs across classes in a bucket, every one
  that can reach the threshold is then compared: in large buckets a shingle is rare if at most ``RARE``
  of their nodes have it, two nodes without a common rare shingle overlap in at most
  ``total - rare`` of either, and nodes with a common one are few and found by a join on it. The node
  of the smallest rare share is also the best centre: it is the text that the others were edited from.
  So no candidate link is lost, and the pairs made follow the number of texts, not the square of a
  group.

Null text counts as empty; empty texts (and texts of white space only) are copies of each other only
if equal. Rows with equal ids or null ids are rows of their own. Empty table: empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import drop_stages, ship, stage

ship(__name__)

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: Words of texts put through numpy together (a longer text is a batch of its own), texts whose signatures are
#: drawn together, elements and points of the drawing: they bound a worker's matrices whatever the texts' lengths.
BATCH_WORDS, BATCH_TEXTS = 1 << 16, 256
ELEMENTS, POINTS = 1 << 16, 1 << 18
CHUNK_BYTES = 1 << 20
#: Buckets of so many nodes are pruned by rare shingles, those that at most RARE of their nodes have.
LARGE_BUCKET, RARE = 16, 8
_U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _chunks(data: bytes) -> Iterator[bytes]:
    """The text in parts of about CHUNK_BYTES, cut at white space."""
    at = 0
    while len(data) - at > CHUNK_BYTES:
        cut = max(data.rfind(c, at, at + CHUNK_BYTES) for c in (b" ", b"\n", b"\t"))
        if cut <= at:
            break
        yield data[at:cut]
        at = cut
    yield data[at:]


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words (runs of anything but ASCII white space) of the lower-cased text."""
    out = []
    for part in _chunks((text or "").lower().encode("utf-8", "replace")):
        a = np.frombuffer(part, np.uint8)
        space = np.ones(len(a) + 2, bool)
        space[1:-1] = (a == 32) | ((a >= 9) & (a <= 13))
        edge = np.flatnonzero(space[1:] != space[:-1])
        if not len(edge):
            continue
        starts, ends = edge[::2], edge[1::2]
        power = np.cumprod(np.full(len(a), _P, _U))
        total = np.zeros(len(a) + 1, _U)
        np.cumsum((a.astype(_U) + _U(1)) * power, out=total[1:])
        inverse = np.cumprod(np.full(len(a), _P_INVERSE, _U))
        out.append(mix((total[ends] - total[starts]) * inverse[starts]))
    return np.concatenate(out) if out else np.zeros(0, _U)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, multiplicities) of the text's shingles, by hash."""
    w = word_hashes(text)
    if not len(w):
        return w, np.zeros(0, np.int64)
    k = min(SHINGLE, len(w))
    s = w[:len(w) - k + 1] + _U(k)
    for j in range(1, k):
        s = mix(s * _U(_P) + w[j:len(w) - k + 1 + j])
    return np.unique(s, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets; two empty ones are 0."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    both = int(a[1].sum() + b[1].sum()) - shared
    return shared / both if both else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash signature (identities of the earliest points) of each non-empty multiset."""
    some = [_signatures(bags[at:at + BATCH_TEXTS], registers) for at in range(0, len(bags), BATCH_TEXTS)]
    return np.concatenate(some) if some else np.zeros((0, registers), _U)


def _signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    sig = np.zeros((len(bags), registers), _U)
    todo, slack = np.array([i for i, b in enumerate(bags) if len(b[0])], dtype=np.int64), 4.0
    while len(todo):
        size = np.array([bags[i][1].sum() for i in todo], dtype=float)
        limit = (np.log(registers) + slack) / size                       # by then all registers are filled, nearly always
        doc = np.repeat(np.arange(len(todo)), [len(bags[i][0]) for i in todo])
        element = np.concatenate([bags[i][0] for i in todo])
        weight = np.concatenate([bags[i][1] for i in todo])
        parts, low, level = [], 0, 0
        while True:
            at = np.flatnonzero(weight > low)
            if not len(at):
                break
            height = max(low, 1)
            parts.append((doc[at], mix(element[at] ^ mix(np.full(1, level + 1, _U))), weight[at], np.full(len(at), low), np.full(len(at), height)))
            low, level = low + height, level + 1
        drawn = [np.concatenate(x) for x in zip(*parts)]
        best_t = np.full(len(todo) * registers, np.inf)
        best_id = np.zeros(len(todo) * registers, _U)
        for at in range(0, len(drawn[0]), ELEMENTS):
            _draw(*(x[at:at + ELEMENTS] for x in drawn), limit, registers, best_t, best_id)
        filled = np.isfinite(best_t).reshape(len(todo), registers).all(axis=1)
        sig[todo[filled]] = best_id.reshape(len(todo), registers)[filled]
        todo, slack = todo[~filled], slack + 6.0
    return sig


def _draw(d: np.ndarray, seed: np.ndarray, w: np.ndarray, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray, registers: int,
          best_t: np.ndarray, best_id: np.ndarray) -> None:
    """Run the elements' processes up to their texts' time limits; registers keep their earliest point."""
    rate = hi * float(registers)
    time, count = np.zeros(len(d)), np.zeros(len(d), _U)
    while len(d):
        expected = float((rate * (limit[d] - time)).mean())
        block = int(np.clip(expected * 1.5 + 2, 2, max(2, POINTS // len(d))))
        k = count[:, None] + np.arange(1, block + 1, dtype=_U)
        u = mix(seed[:, None] + k * _U(_P))
        t = time[:, None] + np.cumsum(-np.log(((u >> _U(11)).astype(float) + 0.5) * 2.0**-53) / rate[:, None], axis=1)
        v = mix(u ^ _U(0xD6E8FEB86659FD93))
        place = lo[:, None] + hi[:, None] * ((v >> _U(32)).astype(float) * 2.0**-32)
        r, c = np.nonzero((t <= limit[d][:, None]) & (place < w[:, None]))
        register = d[r] * registers + ((v[r, c] & _U(0xFFFFFFFF)) * _U(registers) >> _U(32)).astype(np.int64)
        when, point = t[r, c], u[r, c]
        order = np.lexsort((when, register))                             # the earliest of each register comes first
        register, when, point = register[order], when[order], point[order]
        first = np.ones(len(register), bool)
        first[1:] = register[1:] != register[:-1]
        register, when, point = register[first], when[first], point[first]
        better = when < best_t[register]
        best_t[register[better]], best_id[register[better]] = when[better], point[better]
        more = np.flatnonzero(t[:, -1] <= limit[d])
        time, count = t[more, -1], count[more] + _U(block)
        d, seed, w, lo, hi, rate = d[more], seed[more], w[more], lo[more], hi[more], rate[more]


def band_hashes(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One signed 64-bit hash per band of registers."""
    n, bands = len(sig), sig.shape[1] // rows
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=_U)), (n, bands)).copy()
    cut = sig.reshape(n, bands, rows)
    for j in range(rows):
        h = mix(h * _U(_P) + cut[:, :, j])
    return h.view(np.int64)


def node_of(text: Column) -> Column:
    """16 bytes that identify a text (null: empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _signed(rows: DataFrame) -> DataFrame:
    """(node, total, bands) of rows (node, text): shingles and band hashes; texts without words have none."""
    def signed(nodes: list[bytes], bags: list) -> pa.RecordBatch:
        bands = band_hashes(signatures(bags))
        offsets = np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([int(b[1].sum()) for b in bags], pa.int64()),
                                           pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel()))], names=["node", "total", "bands"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:                                            # one text at a time becomes a Python string
            nodes, bags, words = [], [], 0
            for i in range(batch.num_rows):
                bag = shingles(batch["text"][i].as_py())
                if len(bag[0]):
                    nodes.append(batch["node"][i].as_py())
                    bags.append(bag)
                    words += len(bag[0])
                if bags and (words >= BATCH_WORDS or i == batch.num_rows - 1):
                    yield signed(nodes, bags)
                    nodes, bags, words = [], [], 0
    return rows.select("node", "text").mapInArrow(run, "node binary, total long, bands array<bigint>")


def _rare(texts: DataFrame, spent: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of the shingles that at most RARE of these texts have: (node, rare), their number in each text, and
    (node, shingle), those that two or more texts share."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for node, text in zip(pdf["node"], pdf["text"]):
                h, n = shingles(text)
                high, low = np.frombuffer(node, ">i8")
                yield pd.DataFrame({"high": np.full(len(h), high, np.int64), "low": np.full(len(h), low, np.int64), "shingle": h.view(np.int64), "n": n})
    node = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("high", "low")])).alias("node")
    each = stage(texts.select("node", "text").mapInPandas(run, "high long, low long, shingle long, n long"), "dup-shingles", spent)
    few = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), *[F.min(c).alias(c) for c in ("high", "low", "n")]).filter(F.col("df") <= RARE)
    few = stage(few, "dup-few", spent)
    # the owner of a shingle that only one text has is known; only shared ones are joined back
    shared = stage(each.join(few.filter("df > 1").select("shingle").hint("merge"), "shingle").select(node, "shingle", "n"), "dup-rare", spent)
    weight = few.filter("df = 1").select(node, "n").union(shared.select("node", "n")).groupBy("node").agg(F.sum("n").alias("rare"))
    return weight, shared.select("node", "shingle")


def _confirmed(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    wide = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a").select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, None
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a = batch["a"][i].as_py()
                if a != last:                                            # rows come sorted by a
                    last, bag = a, shingles(batch["text_a"][i].as_py())
                keep.append(similarity(bag, shingles(batch["text_b"][i].as_py())) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return wide.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame, spent: list[str]) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b). Each round every node hooks onto the smallest of
    itself and its neighbours, and the edges move to the hooks; node ids are hashes, so that a round
    removes a constant share of the nodes and a few rounds suffice, whatever the shape."""
    edges = stage(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges", spent)
    out = None
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        hook = stage(ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("up")), "cc-hooks", spent)
        moved = (edges.join(hook.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a")
                 .join(hook.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b").filter("ua != ub"))
        edges = stage(moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "cc-edges", spent)
        out = _moved(out, hook)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if out is None else out


def _moved(known: DataFrame | None, hook: DataFrame) -> DataFrame:
    """Roots after their nodes have hooked onto others: (node, root) through (node, up)."""
    if known is None:
        return hook.select("node", F.col("up").alias("root"))
    return (known.join(hook.select(F.col("node").alias("root"), F.col("up").alias("__up")), "root", "left")
            .select("node", F.coalesce("__up", "root").alias("root")))


def _joined(known: DataFrame | None, links: DataFrame, spent: list[str]) -> DataFrame:
    """The classes ``known`` (node, root), joined along ``links`` (a, b)."""
    if known is None:
        return stage(components(links, spent), "dup-classes", spent)
    root = lambda c, r: known.select(F.col("node").alias(c), F.col("root").alias(r))
    ends = (links.join(root("a", "ra"), "a", "left").join(root("b", "rb"), "b", "left")
            .select("a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb")))
    ends = stage(ends, "dup-ends", spent)
    merged = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")), spent)
    nodes = known.union(ends.select("a", "ra")).union(ends.select("b", "rb")).distinct()
    return stage(_moved(nodes, merged.withColumnRenamed("root", "up")), "dup-classes", spent)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _classes(members: DataFrame, rare: DataFrame, texts: DataFrame, threshold: float, spent: list[str]) -> DataFrame:
    """(node, root) for every node that has a link. ``members`` (bucket, node, total, rare): buckets have
    two nodes or more; ``rare`` (node, shingle): shingles that 2 to RARE of the large buckets' nodes share."""
    share = F.struct((F.col("rare") / F.col("total")).alias("share"), "node")
    centre = members.groupBy("bucket").agg(F.min(share)["node"].alias("a"))
    stars = members.join(centre, "bucket").select("a", F.col("node").alias("b"))
    first = rare.groupBy("shingle").agg(F.min("node").alias("a"))
    stars = stars.union(rare.join(first, "shingle").select("a", F.col("node").alias("b"))).filter("a != b")
    tested = stage(_ordered(stars), "dup-stars", spent)
    known = _joined(None, stage(_confirmed(tested, texts, threshold), "dup-links", spent), spent)
    # the classes inside each bucket; nodes without a link are classes of their own. A node whose frequent
    # shingles can't reach the threshold even with the bucket's smallest text is done with here
    rooted = lambda df: df.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    left = F.col("total") - F.col("rare")
    low = members.groupBy("bucket").agg(F.min("total").alias("low"))
    at = rooted(members.join(low, "bucket").filter(left >= threshold * (F.col("low") + F.col("rare")) - 1e-9).drop("low"))
    at = stage(at, "dup-at", spent)
    parts = at.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.max_by("root", F.struct("n", "root")).alias("main")).filter("k > 1")
    inside = at.join(mixed.select("bucket", "main"), "bucket")
    side = lambda c: [F.col("node").alias(c), F.col("root").alias(f"r{c}"), F.col("total").alias(f"t{c}"), F.col("rare").alias(f"u{c}")]
    shared = F.least(F.col("ta") - F.col("ua"), F.col("tb") - F.col("ub"))                 # most that two nodes can have in common
    reachable = shared >= threshold * (F.col("ta") + F.col("tb") - shared) - 1e-9
    # the smaller classes' nodes against the rest of their bucket
    few, every = inside.filter("root != main").select("bucket", *side("a")), inside.select("bucket", "main", *side("b"))
    across = (F.col("rb") == F.col("main")) | (F.col("ra") < F.col("rb"))
    pairs = few.join(every.hint("merge"), "bucket").filter(across & reachable).select("a", "b")
    # and the nodes of different classes with a common rare shingle, at most RARE each
    of = rooted(rare)
    left_, right_ = of.select("shingle", F.col("node").alias("a"), F.col("root").alias("ra")), of.select("shingle", F.col("node").alias("b"), F.col("root").alias("rb"))
    pairs = pairs.union(left_.join(right_.hint("merge"), "shingle").filter("ra < rb").select("a", "b"))
    pairs = stage(_ordered(pairs).join(tested, ["a", "b"], "left_anti"), "dup-pairs", spent)
    return _joined(known, stage(_confirmed(pairs, texts, threshold), "dup-links", spent), spent)


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, node, class_id, class_size, is_first) for every row: class_id is the smallest doc_id of
    the class, ``node`` identifies the text, is_first marks the row(s) that stand for the class."""
    spark, spent = docs.sparkSession, []
    rows = docs.select(F.col(doc_id).alias("doc_id"), node_of(F.col(text)).alias("node"), F.col(text).alias("text"))
    ids = rows.select("doc_id", "node")
    signed = stage(_signed(rows), "dup-signatures", spent)
    buckets = (signed.groupBy("node").agg(F.first("bands").alias("bands"), F.first("total").alias("total"))
               .select("node", "total", F.explode("bands").alias("bucket")))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stage(buckets.join(shared.hint("merge"), "bucket").select("bucket", "node", "total", "n"), "dup-buckets", spent)
    texts = (rows.select("node", "text").join(members.select("node").distinct().hint("merge"), "node", "left_semi")
             .dropDuplicates(["node"]))
    texts = stage(texts, "dup-texts", spent)
    in_large = members.filter(F.col("n") >= LARGE_BUCKET).select("node").distinct()
    weight, rare = _rare(texts.join(in_large.hint("merge"), "node", "left_semi"), spent)
    # in smaller buckets the bound isn't used: partners there may be outside the nodes that were counted
    own = F.when(F.col("n") >= LARGE_BUCKET, F.coalesce("rare", F.lit(0))).otherwise(0)
    members = stage(members.join(weight, "node", "left").select("bucket", "node", "total", own.cast("long").alias("rare")), "dup-members", spent)
    known = stage(_classes(members, rare, texts, threshold, spent), "dup-roots")
    drop_stages(spark, spent)
    rooted = stage(ids.join(known, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root")), "dup-rows")
    first = F.min(F.struct(_id_or_last(F.col("doc_id")).alias("id"), "node"))
    groups = rooted.groupBy("root").agg(first.alias("first"), F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    is_first = (_id_or_last(F.col("doc_id")) == F.col("first.id")) & (F.col("node") == F.col("first.node"))
    return rooted.join(groups, "root").select("doc_id", "node", "class_id", "class_size", is_first.alias("is_first"))


def _id_or_last(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1).cast("long"))


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id (of equal rows, one; a null id
    only if the class has no other)."""
    found = near_duplicates(docs, threshold).filter("is_first")
    first = found.select(_id_or_last(F.col("doc_id")).alias("__id"), F.col("node").alias("__node")).distinct()
    keyed = docs.withColumn("__id", _id_or_last(F.col("doc_id"))).withColumn("__node", node_of(F.col("text")))
    return keyed.join(first.hint("merge"), ["__id", "__node"], "left_semi").dropDuplicates(["__id", "__node"]).drop("__id", "__node")
