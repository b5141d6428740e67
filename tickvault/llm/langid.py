"""Language identification: hashed subword embeddings, averaged over a text, with a linear softmax.

Subwords are the 1- to 4-letter sequences of the lower-cased text, with one word boundary allowed at
either end, hashed into ``BUCKETS`` rows. Embeddings and softmax are trained together by stochastic
gradient descent in numpy, on a bounded sample: at most about ``SAMPLE_PER_LANG`` documents of each
language, ``SEGMENTS`` segments of ``SEGMENT_CHARS`` characters from each. The model is linear, so for
prediction embeddings and softmax fold into one table (bucket -> score per language), which is what
tasks get: ``BUCKETS`` x languages floats, whatever the corpus size. Every text is scored whole.

Calibration: a fifth of the sampled documents is kept out of training; on their segments the softmax
temperature is fitted. A text is rejected by either of two conformal cuts, below each of which at most
``REJECT_ALPHA`` of the calibration rows lie: its largest probability (over segments, and over pairs of
segments of two languages, so that mixed texts are kept), and its familiarity, the mean log frequency
of its subwords in the learnt language where each is most frequent. Texts in no learnt language are
unfamiliar however sure the softmax is; they score 0.

Null texts and texts without a letter: ``und``, score 0, rejected. No training rows: all ``und``.
Null languages are never learnt. Repeated rows are predicted alike.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.llm.common import ship

ship(__name__)

BUCKETS, DIM, MAX_GRAM = 1 << 16, 12, 4
SAMPLE_PER_LANG, SEGMENTS, SEGMENT_CHARS = 400, 4, 240
#: Languages learnt, the most frequent first (the model holds a column for each).
MAX_LANGS = 1000
EPOCHS, BATCH, RATE, REJECT_ALPHA = 6, 32, 0.6, 0.001
#: Pseudo-count of a subword that a language's sample does not hold.
UNSEEN = 0.1
#: Code points scored at once, so memory does not depend on a text's length.
CHUNK = 1 << 18
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """Code point -> lower-case letter, or 0 for anything that is no letter."""
    return np.fromiter((ord(c.lower()[0]) if c.isalpha() else 0 for c in map(chr, range(0x110000))), np.uint32, 0x110000)


def letters_of(text: str, letters: np.ndarray) -> np.ndarray:
    return letters[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]


def grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, bucket) of every subword of a letter sequence (0: boundary)."""
    starts, hashes = [], []
    letter = codes > 0
    for n in range(1, MAX_GRAM + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        ok = letter[:m].copy() if n == 1 else (letter[:m] | letter[n - 1:n - 1 + m] if n == 2 else np.ones(m, bool))
        for j in range(n):
            h = (h ^ codes[j:j + m]) * np.uint32(0x01000193)
            if 0 < j < n - 1:
                ok &= letter[j:j + m]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        at = np.flatnonzero(ok)
        starts.append(at)
        hashes.append((h[at] & np.uint32(BUCKETS - 1)).astype(np.int32))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(starts), np.concatenate(hashes)


@dataclass
class Model:
    """Everything a task needs; the fields are plain values, so they can be broadcast."""
    langs: list[str]
    letters: np.ndarray
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))   # bucket x language
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0
    threshold: float = 0.0
    seen: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))     # log frequency of a bucket
    usual: np.ndarray = field(default_factory=lambda: np.zeros(0))                      # mean of seen, per language
    usual_n: float = 1.0                                                                # subwords of a segment
    unfamiliar: float = -np.inf

    def probabilities(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        z = (sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def familiarity(self, seen: np.ndarray, n: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Distance of a text's mean log frequency from its language's, in units that allow short texts more."""
        usual = self.usual[best] if len(self.usual) else 0.0
        return (seen / np.maximum(n, 1) - usual) / np.sqrt(1 / np.maximum(n, 1) + 1 / self.usual_n)

    def score_sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Summed scores and subword counts of whole texts, CHUNK code points at a time."""
        return self.text_sums(texts)[:2]

    def text_sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``score_sums`` and the summed log frequencies."""
        sums, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        seen = np.zeros(len(texts))
        queue, owner, size = [], [], 0

        def flush() -> None:
            nonlocal queue, owner, size
            if queue:
                codes, who = np.concatenate(queue), np.repeat(owner, [len(q) for q in queue])
                start, bucket = grams(codes)
                doc = who[start]
                n[:] += np.bincount(doc, minlength=len(texts))
                seen[:] += np.bincount(doc, weights=self.seen[bucket], minlength=len(texts))
                for k in range(len(self.langs)):
                    sums[:, k] += np.bincount(doc, weights=self.table[bucket, k], minlength=len(texts))
            queue, owner, size = [], [], 0

        gap = np.zeros(1, np.uint32)
        for i, t in enumerate(texts):
            for at in range(0, len(t or ""), CHUNK):
                part = letters_of(t[at:at + CHUNK], self.letters)
                queue.append(np.concatenate([gap, part, gap]))
                owner.append(i)
                size += len(part)
                if size >= CHUNK:
                    flush()
        flush()
        return sums, n, seen

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        sums, n, seen = self.text_sums(texts)
        p = self.probabilities(sums, n)
        best = p.argmax(axis=1)
        langs = [self.langs[b] if m else UNKNOWN for b, m in zip(best, n)]
        known = (n > 0) & (self.familiarity(seen, n, best) >= self.unfamiliar)
        return langs, np.where(known, np.clip(p.max(axis=1), 0.0, 1.0), 0.0)


def conformal(scores: np.ndarray) -> float:
    """The score below which at most ``REJECT_ALPHA`` of the rows lie; with too few rows to tell, a tenth
    of its size below the lowest."""
    ranked = np.sort(scores)
    k = int(REJECT_ALPHA * (len(ranked) + 1))
    return float(ranked[k - 1]) if k >= 1 else float(ranked[0] - 0.1 * abs(ranked[0]))


def log_frequencies(segments: list[np.ndarray], y: np.ndarray, fit: np.ndarray, n_langs: int) -> np.ndarray:
    """Per bucket, the log frequency in the language where it is most frequent."""
    out = np.full(BUCKETS, -np.inf)
    for k in range(n_langs):
        own = [segments[i] for i in fit if y[i] == k]
        if own:
            counts = np.bincount(np.concatenate(own), minlength=BUCKETS)
            np.maximum(out, np.log((counts + UNSEEN) / (counts.sum() + UNSEEN * BUCKETS)), out=out)
    return out.astype(np.float32)


def train(lang: list[str], segments: list[np.ndarray], calibration: np.ndarray, letters: np.ndarray, seed: int = 7) -> Model:
    """Fit a model to segments (arrays of buckets); ``calibration`` marks those kept out of training."""
    langs = sorted(set(lang))
    if not langs:
        return Model([], letters)
    y = np.searchsorted(langs, lang)
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    soft, bias = np.zeros((DIM, len(langs))), np.zeros(len(langs))
    fit = np.flatnonzero(~calibration) if (~calibration).any() else np.arange(len(y))
    steps, step = EPOCHS * -(-len(fit) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(fit)
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            rate, step = RATE * (1 - step / steps), step + 1
            sizes = np.array([len(segments[i]) for i in batch])
            bucket = np.concatenate([segments[i] for i in batch])
            mean = np.add.reduceat(emb[bucket], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / sizes[:, None]
            z = mean @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1                       # gradient of the loss by z
            back = (p @ soft.T) / sizes[:, None]
            soft -= rate * (mean.T @ p)
            bias -= rate * p.sum(axis=0) * 0.01
            hit, inverse = np.unique(bucket, return_inverse=True)
            per = np.repeat(back, sizes, axis=0)
            for d in range(DIM):
                emb[hit, d] -= rate * np.bincount(inverse, weights=per[:, d])
    model = Model(langs, letters, (emb @ soft).astype(np.float32), bias)
    model.seen = log_frequencies(segments, y, fit, len(langs))
    held = np.flatnonzero(calibration)
    if len(held):
        sums = np.stack([model.table[segments[i]].sum(axis=0) for i in held]).astype(float)
        n = np.array([len(segments[i]) for i in held])
        losses = {}
        for t in np.geomspace(0.05, 20, 61):
            model.temperature = t
            losses[t] = -np.log(np.maximum(model.probabilities(sums, n)[np.arange(len(held)), y[held]], 1e-12)).mean()
        model.temperature = float(min(losses, key=losses.get))
        p = model.probabilities(sums, n)
        best, own = p.argmax(axis=1), y[held]
        right = best == own
        with_other = rng.permutation(len(held))                           # the mixed texts: two segments each
        with_other, one = with_other[own[with_other] != own], np.flatnonzero(own[with_other] != own)
        mixed = model.probabilities(sums[one] + sums[with_other], n[one] + n[with_other])
        of_two = (mixed.argmax(axis=1) == own[one]) | (mixed.argmax(axis=1) == own[with_other])
        scores = np.concatenate([p.max(axis=1)[right], mixed.max(axis=1)[of_two]])
        model.threshold = conformal(scores) if len(scores) else 0.0
        seen = np.array([model.seen[segments[i]].sum(dtype=float) for i in held])
        model.usual_n = float(np.median(n))
        model.usual = np.array([(seen / n)[own == k].mean() if (own == k).any() else (seen / n).mean() for k in range(len(langs))])
        model.unfamiliar = conformal(model.familiarity(seen, n, best)[right]) if right.any() else -np.inf
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """Train on documents (doc_id, text, lang) that are not held out. What reaches the driver is
    bounded by the sample parameters: sparse buckets of the segments, never texts."""
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = (usable.select("doc_id", "lang", "text", draw.alias("draw")).join(F.broadcast(sizes), "lang")   # MAX_LANGS rows
              .filter(F.col("draw") * F.col("n") < SAMPLE_PER_LANG).select("lang", "draw", "doc_id", "text"))

    letters = letter_table()
    shared = docs.sparkSession.sparkContext.broadcast(letters)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for lang, doc_id, text in zip(pdf["lang"], pdf["doc_id"], pdf["text"]):
                last = max(0, len(text) - SEGMENT_CHARS)
                for k, at in enumerate(sorted({last * i // max(1, SEGMENTS - 1) for i in range(SEGMENTS)})):
                    bucket = grams(np.concatenate([[np.uint32(0)], letters_of(text[at:at + SEGMENT_CHARS], shared.value), [np.uint32(0)]]).astype(np.uint32))[1]
                    if len(bucket):
                        rows.append((lang, doc_id, k, bucket.astype("<u2").tobytes()))
            yield pd.DataFrame(rows, columns=["lang", "doc_id", "k", "buckets"])

    got = sample.select("lang", "doc_id", "text").mapInPandas(cut, "lang string, doc_id long, k int, buckets binary").collect()
    got.sort(key=lambda r: (r.lang, r.doc_id, r.k))
    segments = [np.frombuffer(r.buckets, "<u2").astype(np.int32) for r in got]
    calibration = np.array([(r.doc_id * 2654435761 >> 7) % 5 == 0 for r in got], dtype=bool)
    return train([r.lang for r in got], segments, calibration, letters)


def predict(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with lang_pred, score and rejected (columns of these names are replaced). Without
    ``keep_text`` the text column is not carried along. ``text`` may name a field of a struct column."""
    added, path = ("lang_pred", "score", "rejected"), text.split(".")
    names = [c for c in docs.columns if c not in added]
    out = [c for c in names if keep_text or c != text]
    schema = T.StructType([docs.schema[c] for c in out] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                                                         T.StructField("rejected", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            whole = batch.column(path[0])
            for field_name in path[1:]:
                whole = pc.struct_field(whole, field_name)
            langs, score = m.predict(whole.to_pylist())
            rejected = [(x == UNKNOWN) or bool(s < m.threshold) for x, s in zip(langs, score)]
            new = [pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in out] + new, names=[*out, *added])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)


def languages(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, rejected."""
    model = fit(docs.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
