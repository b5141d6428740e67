"""op11 to op13 against brute-force versions."""
import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK, SF_SMALL
from tickvault.llm import periods, repair, topk
from tickvault.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- op11 -----------------------------------------------------------------------------------

def damage(rows):
    """{conv_id: [(turn, role, text)]} after the contract's damage."""
    out = {}
    tie = lambda r: hashlib.sha256(f"{r[2]}\0{r[3]}".encode()).hexdigest()
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, tie(r))):
        own = out.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            row = (t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            own += [row] * (2 if kind == 3 else 1)
    return out


def best_edits(rows):
    """(cost, audit, lines) by forward search over all edit sequences, cheapest first, then ASCII-least."""
    seen, faults = set(), []
    for _, role, text in rows:
        s = text.strip(SPACE)
        faults.append("blank" if not s else "duplicate" if (role, text) in seen else "truncated" if s[-1] not in ".!?" else "")
        seen.add((role, text))
    go = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                for x in ("u", "a"):
                    if x in go[s]:
                        offer = (cost + 2, audit + "I", lines + (f"{name[x]}:",))
                        best[x] = min(best.get(x, offer), offer)
        return best
    best = inserted(best)
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for s, (cost, audit, lines) in best.items():
            offers = [(s, (cost + 3, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                if role[:1] in go[s]:
                    offers.append((role[:1], (cost + cut, audit + "K", lines + (f"{role}:{text}",))))
                offers += [(x, (cost + 2 + cut, audit + "R", lines + (f"{name[x]}:{text}",))) for x in ("u", "a") if x in go[s]]
            for x, offer in offers:
                after[x] = min(after.get(x, offer), offer)
        best = inserted(after)
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    return cost, audit, lines, faults


def brute_repair(rows):
    out = {}
    for conv, own in damage(rows).items():
        cost, audit, lines, faults = best_edits(own)
        turns = [t for t, _, _ in own if t is not None]
        first = [r[:1] for _, r, _ in own]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_repair_query_equals_forward_search(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = repaired(QUERIES["op11_repair"](spark, SF_CHECK))
    assert got == brute_repair([tuple(r) for r in rows])
    assert len({a for *_, a, _ in got.values()}) > 20


def odd_conversations(seed, n=60):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "", " \t", None, "What?", "What? ", "é中!", "a.\n", "x" * 3000 + ".", " "]
    roles = ["user", "assistant", "system", "tool", "User", "", None, "u", "sys"]
    clean = ["user", "assistant"]
    rows = []
    for c in itertools.chain([None], range(n)):
        k = rng.choice([0, 1, 2, 5, 9, 14]) + 1
        for t in range(k):
            role = clean[t % 2] if rng.random() < 0.7 else rng.choice(roles)
            rows.append((c, rng.choice([None, t, t, t, t, -3]), role, f"m{t}." if rng.random() < 0.5 else rng.choice(texts)))
    return rows


@pytest.mark.parametrize("chunk,fixups", [(4096, 4), (3, 4), (1, 0), (2, 1)])
def test_repair_of_odd_rows_in_chunks(spark, monkeypatch, chunk, fixups):
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk)
    rows = odd_conversations(chunk)
    rows += [(1000, t, "tool" if t % 7 else "assistant", f"t{t % 50}.") for t in range(300)]       # never converges
    rows += [(1001, t, ["user", "assistant"][t % 2], f"t{t}.") for t in range(300)] + [(1002, 5, "user", "same.")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("at", F.lit("clash")).withColumn("codes", F.lit(1))
    assert repaired(repair.repair(repair.damaged(df.repartition(5)), fixups)) == brute_repair(rows)


def test_repair_of_empty_tables_string_ids_and_far_turns(spark):
    df = spark.createDataFrame([("a", 2**63 - 1, "user", "Hi."), ("a", -2**63, "assistant", "Ho."), (None, None, None, None)], "conv_id string, turn long, role string, text string")
    got = repaired(repair.repair_digest(df))
    assert got["a"][0] == 2**63 - 1 and got[None][5:] == (3, "D", hashlib.sha256(b"").hexdigest())
    assert repair.repair_digest(df.limit(0)).collect() == []


def test_fixups_stop_when_vectors_differ_only_by_constants():
    clean = "ua" * 20
    assert len({repair.run_back(clean, v) for v in [(0, 4, 2, 0), (0, 0, 0, 0), (2, 4, 2, 0), (4, 2, 0, 2)]}) == 1
    for codes in ("xxxx", clean, "-", "sUxA-u", ""):
        for v in [(0, 4, 2, 0), (2, 2, 0, 2), (4, 2, 0, 2)]:
            assert repair.apply(repair.transfer(codes), v) == repair.run_back(codes, v)


# ---- op12 -----------------------------------------------------------------------------------

def brute_top(rows, k=5, every=50):
    good = [(i, [min(max(int(np.floor(256 * float(x))), -2**63), 2**63 - 1) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % every == 0:
            every_score = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -2**63), 2**63 - 1), i) for i, w in good if i != q)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(every_score[:k], 1)]
    return sorted(out)


def top(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_top_k_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = top(QUERIES["op12_topk"](spark, SF_CHECK))
    assert got == brute_top(rows) and len(got) == 50


@pytest.mark.parametrize("block_bytes,group", [(1 << 20, 64), (400, 2)])
def test_top_k_of_odd_vectors(spark, monkeypatch, block_bytes, group):
    monkeypatch.setattr(topk, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", group)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.01, 1, 30])).round(3).tolist()) for i in range(400)]
    rows += [(400 + i, [0.5] * 8) for i in range(60)] + [(500, None), (550, [1.0, None]), (600, [float("nan")] * 8), (650, [float("inf"), 1.0]),
             (None, [1.0] * 8), (700, []), (750, [2.0, -1.0]), (800, [0.0] * 8), (-50, [-3.0] * 8), (3, [9.0] * 8), (3, [9.0] * 8), (100, [0.25] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    assert top(topk.search_digest(df)) == brute_top(rows)


def test_top_k_of_huge_components_and_few_rows(spark):
    rows = [(0, [1e300, 1.0]), (50, [1e18, -5.0]), (1, [3e10, 2e10]), (2, [-1e17, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert top(topk.search_digest(df)) == brute_top(rows)
    assert topk.search_digest(df.limit(0)).collect() == [] == topk.search_digest(df.filter("vec_id = 50")).collect()
    assert topk.search_digest(df.filter("vec_id = 1")).collect() == []


def test_bounds_prune_most_pairs():
    rng = np.random.default_rng(1)
    m = np.floor(256 * rng.normal(size=(3000, 32)) * (0.8 ** np.arange(32))).astype(np.int64)
    m = m[np.argsort(-np.square(m).sum(axis=1))]
    weight, axes = np.linalg.eigh((m.T @ m).astype(float))
    block = topk.Block(np.arange(3000), m.tobytes(), 32, axes[:, ::-1], 8)
    best = topk.Best(topk.Block(np.arange(0, 3000, 50), m[::50].tobytes(), 32, axes[:, ::-1], 8), 5)
    assert best.search(block) < 0.3 * 60 * 3000
    assert not best.needs(1.0).any()


# ---- op13 -----------------------------------------------------------------------------------

def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i - q, j - i + q), q)                  # a smaller period of the same stretch came before
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


DIGEST = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r[c] for c in DIGEST) for r in QUERIES["op13_periods"](spark, SF_SMALL).collect()}
    assert got == {d: brute_digest(d, t) for d, t in docs.items()}
    assert sum(r[0] > 0 for r in got.values()) > 5


def test_runs_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(periods, "BATCH_WORDS", 50)
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "a " * 5, "a " * 6, "a b " * 9, "é\x0b中\x1fx " * 7, "a b " * 4000, "x " * 3 + "a b c a b " * 30, "\x00 " * 8]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 80))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b " * 9), (7, "b " * 9), (7, "b " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("runs", F.lit(0))
    got = sorted((tuple(r[c] for c in ["doc_id", *DIGEST]) for r in periods.run_digest(df).collect()), key=repr)
    assert got == sorted(((i, *brute_digest(i, t)) for i, t in rows), key=repr)
    assert periods.run_digest(df.limit(0)).collect() == []


def test_runs_of_many_small_alphabets():
    rng = random.Random(11)
    for _ in range(3000):
        words = []
        while len(words) < rng.randint(0, 70):
            words += [rng.randrange(3) for _ in range(rng.randint(1, 6))] * rng.choice([1, 1, 2, 5])
        assert periods.runs(np.array(words, np.int64)) == brute_runs(words)
