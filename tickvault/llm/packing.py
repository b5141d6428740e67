"""Best-fit packing of documents into sequences of at most ``CAPACITY`` tokens.

Documents are tokenised, ended by ``END`` and, only if longer than a sequence, cut into pieces of
``CAPACITY`` tokens (the first piece is the shorter one). How to fill sequences is decided on the
histogram of piece lengths, which has at most ``CAPACITY`` rows whatever the corpus size:

1. the configuration linear program (how many sequences of each filling, so that every length is
   covered) is solved by multiplicative weights: each round a knapsack dynamic program prices all
   fillings, the best ones are used, then the prices of the lengths they cover fall;
2. the fractional solution is rounded to whole sequences, never beyond the pieces there are, and solved
   again for the pieces left, as long as that places some;
3. the few pieces left are placed best-fit decreasing, again on counts (equal bins together). If best-fit
   alone needs fewer sequences, its plan is taken.

The plan is a list of (filling, count). Pieces are numbered inside their length by Spark and look up
their sequence and offset; no task or driver ever holds a corpus-sized list.

Null text: empty document, one piece with the end token. Ids may repeat or be null; every row is
packed. An empty table gives an empty result.
"""
from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.llm.common import drop_stages, positions, ship, stage

ship(__name__)

CAPACITY, END = 2048, 0
TOKENIZER = "byte_bpe_50k.json"
ROUNDS, ETA, COLUMNS = 24, 0.5, 128
#: Share of a sequence that a rounded filling may leave empty.
WASTE = 0.002
#: Long pieces are worth a little more than their length, so that short ones are left to fill gaps.
LONG_FIRST = 0.3
#: Pieces numbered by one task; lengths with more are salted.
BUCKET_ROWS = 20_000
#: Rows tokenised together.
BATCH = 64
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space in a row that the fast encoder takes.
LONG_BLANK = 100_000
_long_blank = re.compile(r"\s{%d}" % LONG_BLANK)
_encoders: dict = {}


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def _tokens(path: str, text: str) -> np.ndarray:
    """A text's ids. White space of more than LONG_BLANK characters goes to tokenizers itself: the pattern's
    look-ahead would exhaust tiktoken's stack."""
    if len(text) > LONG_BLANK and _long_blank.search(text):
        if ("whole", path) not in _encoders:
            from tokenizers import Tokenizer
            _encoders["whole", path] = Tokenizer.from_file(path)
        return np.array(_encoders["whole", path].encode(text, add_special_tokens=False).ids, dtype="<u4")
    return np.frombuffer(encoder(path).encode_to_numpy(text, allowed_special="all"), dtype="<u4")


def encoder(path: str):
    """Byte-level BPE of a tokenizers JSON file. The merges are run by tiktoken, which gives the same
    ids several times faster; the vocabulary is the file's. Its added tokens are matched in the text
    before the merges, as tokenizers does, so a text that holds one gets its id."""
    if path not in _encoders:
        import tiktoken
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]      # bytes that stand for themselves
        rest = [b for b in range(256) if b not in keep]
        back = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        _encoders[path] = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=added)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, ids: bool = False,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's pieces, in order."""
    path = tokenizer or tokenizer_file()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    types = [T.IntegerType(), T.LongType(), T.LongType(), T.LongType()] + [T.ArrayType(T.IntegerType())] * ids
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType)] + [T.StructField(n, k) for n, k in zip(names[1:], types)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part, row, rows, cuts = batch.slice(at, BATCH), [], [], []
                for i, t in enumerate(part.column("text").to_pylist()):
                    tokens = np.append(_tokens(path, t or ""), np.uint32(END)).astype("<u4")
                    ends = [*range(len(tokens) % capacity or capacity, len(tokens), capacity), len(tokens)] if len(tokens) > capacity else [len(tokens)]
                    for piece, (start, end) in enumerate(zip([0, *ends], ends)):
                        own = tokens[start:end]
                        row.append(i)
                        rows.append((piece, start, end - start, zlib.crc32(own.tobytes())))
                        cuts.append(own)
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                if ids:
                    ends = np.cumsum([0] + [len(c) for c in cuts], dtype=np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(cuts).astype(np.int32))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row))] + columns, names=names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def best_by_room(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room up to ``capacity``: the largest value that fits into it, and the last length taken (-1: none)."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for c in range(int(lengths[0]), capacity + 1):
        k = fits[c]
        offer = best[c - lengths[:k]] + value[:k]
        i = int(offer.argmax())
        if offer[i] > best[c - 1]:
            best[c], take[c] = offer[i], i
        else:
            best[c] = best[c - 1]
    return best, take


def knapsack(lengths: np.ndarray, value: np.ndarray, limit: np.ndarray, capacity: int) -> Counter:
    """The filling of largest value, as length -> copies (never more copies than ``limit``)."""
    _, take = best_by_room(lengths, value, capacity)
    filling, c = Counter(), capacity
    while c > 0:
        i = int(take[c])
        if i < 0:
            c -= 1
            continue
        if filling[int(lengths[i])] < limit[i]:
            filling[int(lengths[i])] += 1
        c -= int(lengths[i])
    return +filling


def filling_with(first: int, lengths: np.ndarray, take: np.ndarray, left: np.ndarray, capacity: int) -> Counter:
    """The best filling that holds length number ``first`` (number -> copies), no more copies than are left."""
    filling, c = Counter({first: 1}), capacity - int(lengths[first])
    while c > 0:
        i = int(take[c])
        if i < 0:
            c -= 1
            continue
        if filling[i] < left[i]:
            filling[i] += 1
        c -= int(lengths[i])
    return filling


def linear_program(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], float]]:
    """Fillings and their fractional counts, by multiplicative weights: prices fall with coverage. One knapsack
    table prices all fillings; each round uses the ``COLUMNS`` best that hold different lengths."""
    left, picked = counts.astype(float), Counter()
    bins = max(1.0, float((lengths * counts).sum()) / capacity)
    share = max(1.0, bins / rounds / COLUMNS)
    size = lengths / capacity
    for _ in range(rounds):
        need = np.clip(left / counts, 0.0, 1.0)
        some = np.flatnonzero(left >= 1)
        if not len(some):
            break
        price = (size * (1 + LONG_FIRST * size) * np.exp(ETA * (need - 1)) + 1e-12 * lengths)[some]
        sizes = lengths[some]
        best, take = best_by_room(sizes, price, capacity)
        worth = price + best[capacity - sizes]
        for j in np.argsort(-worth, kind="stable")[:COLUMNS]:
            if left[some[j]] < 1:
                continue
            filling = filling_with(int(j), sizes, take, left[some], capacity)
            n = min(share, min(left[some[i]] / k for i, k in filling.items()))
            for i, k in filling.items():
                left[some[i]] -= n * k
            picked[tuple(sorted((int(sizes[i]) for i in filling.elements()), reverse=True))] += n
    return sorted(picked.items(), key=lambda x: -x[1])


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: bins with the same filling are moved together."""
    space: list[Counter] = [Counter() for _ in range(capacity + 1)]      # free room -> filling -> bins
    filled = np.zeros(capacity + 1, dtype=np.int64)                       # bins by free room
    for x, n in sorted(zip(lengths.tolist(), counts.tolist()), reverse=True):
        while n > 0:
            fits = np.flatnonzero(filled[x:])
            if not len(fits):
                k = capacity // x
                whole, rest = divmod(n, k)
                for copies, bins in ((k, whole), (rest, 1)):
                    if copies and bins:
                        space[capacity - copies * x][(x,) * copies] += bins
                        filled[capacity - copies * x] += bins
                break
            room = x + int(fits[0])
            filling, bins = next(iter(space[room].items()))
            used = min(bins, n)
            if used == bins:
                del space[room][filling]
            else:
                space[room][filling] -= used
            filled[room] -= used
            space[room - x][(*filling, x)] += used
            filled[room - x] += used
            n -= used
    return [(f, n) for level in space for f, n in level.items()]


def sequences(fillings: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(n for _, n in fillings)


def lp_fillings(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[list[tuple[tuple[int, ...], int]], Counter]:
    """Whole numbers of the program's fillings that waste at most ``WASTE`` of a sequence, and what they leave.
    Shares are rounded to the nearest number that the pieces allow; the program is solved again for the
    pieces left, until it places hardly any."""
    left, out = +Counter(histogram), []
    while left:
        lengths = np.array(sorted(left), dtype=np.int64)
        counts = np.array([left[int(x)] for x in lengths], dtype=np.float64)
        placed = 0
        for filling, share in linear_program(lengths, counts, capacity, rounds):
            if sum(filling) < (1 - WASTE) * capacity:
                continue
            need = Counter(filling)
            n = min([int(share + 0.5)] + [left[x] // k for x, k in need.items()])
            if n > 0:
                out.append((filling, n))
                left.subtract({x: n * k for x, k in need.items()})
                placed += n * len(filling)
        left = +left
        if placed < 0.02 * (placed + left.total()):
            break
    return out, left


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """(filling, sequences) covering every piece of the histogram exactly once: the program's fillings, best-fit
    decreasing for the few pieces they leave. Best-fit alone if that needs fewer sequences."""
    short = {x: n for x, n in histogram.items() if n > 0 and x < capacity}
    out = [((capacity,), histogram[capacity])] if histogram.get(capacity) else []
    if not short:
        return out
    fit = lambda h: best_fit(np.array(sorted(h), dtype=np.int64), np.array([h[x] for x in sorted(h)]), capacity) if h else []
    made, left = lp_fillings(short, capacity, rounds)
    made, alone = made + fit(left), fit(short)
    return out + (made if sequences(made) <= sequences(alone) else alone)


def seats(fillings: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """length -> (first number, first sequence, offset) of each run of pieces of that length."""
    runs: dict[int, list[list[int]]] = {}
    base = 0
    for filling, n in fillings:
        offset = 0
        for x in filling:
            own = runs.setdefault(x, [])
            own.append([own[-1][0] + own[-1][3] if own else 0, base, offset, n])
            offset += x
        base += n
    return {x: tuple(np.array([r[i] for r in own], dtype=np.int64) for i in range(3)) for x, own in runs.items()}


def place(staged: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``staged`` pieces with sequence_id and offset. ``staged`` must be a stored table."""
    narrow = staged.drop("ids")
    by_length = narrow.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()      # at most CAPACITY rows
    runs = seats(plan({r["length"]: r["n"] for r in by_length}, capacity))
    shared = staged.sparkSession.sparkContext.broadcast(runs)                              # bounded by the plan's size
    salts = {r["length"]: -(-r["n"] // BUCKET_ROWS) for r in by_length}
    salt = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in salts.items() for x in kv]), F.col("length")), F.lit(1)) if salts else F.lit(1)
    salted = narrow.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), salt))
    numbered = positions(salted, ["length"], ["__salt"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "number").drop("__salt")
    names = [c for c in numbered.columns if c != "number"]
    schema = T.StructType([numbered.schema[c] for c in names] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, base, off = table[int(x)]
                i = np.searchsorted(first, number[at], side="right") - 1
                sequence[at], offset[at] = base[i] + number[at] - first[i], off[i]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The placement of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    placed = place(stage(pieces(docs, tokenizer, capacity), "pieces"), capacity)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def packed_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """As ``pack``, with the token ids of each piece: what a training reader lays out by (sequence_id,
    offset). Tokens are computed once and joined to their places by a row number."""
    spent: list[str] = []
    staged = stage(pieces(docs, tokenizer, capacity, ids=True).withColumn("__row", F.monotonically_increasing_id()), "pieces")
    placed = stage(place(staged, capacity).select("__row", "sequence_id", "offset"), "places", spent)
    return (staged.join(placed.hint("merge"), "__row")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"))
