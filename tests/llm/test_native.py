import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from tickvault.llm import chat, contamination, pii, quality, sharding, urls
from tickvault.llm.queries import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def no_python(df) -> None:
    text = plan_of(df)
    assert not any(x in text for x in ("PythonUDF", "MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


PII_TEXTS = [
    "a@b.c_d@e.f x@y.z.1.2.3.4.5.6.7.8", None, "", " ", "1" * 20000 + " " + "a" * 50000,
    "card 4111 1111 1111 1111 +49 (0)30 123456-78 999.1.1.1 000255.1.1.0001", "é😀 x@y.zz 😀😀 +12 345 678 90",
    "a@b" + ".c" * 5000 + " " + "1." * 3000 + "1", "mail a@b.cc " * 500, "+1 4501042323994846 x 4501042323994846",
]


def test_pii_base_spans_equal_plain_regular_expressions(spark, docs):
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(PII_TEXTS)], "doc_id long, text string")
    df = docs.select("doc_id", "text").union(extra)
    texts = {r.doc_id: r.text for r in df.collect()}
    out = pii.pii_digest(df)
    no_python(out)
    for r in out.collect():
        spans = brute.pii_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        counts = collections.Counter(k for k, _, _ in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in brute.PII]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r.spans.split(",")) | {""}


def test_pii_added_kinds_need_checksum_or_context(spark):
    df = spark.createDataFrame([(1, "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000."), (2, "GB82 WEST 1234 5698 7654 33"),
                                (3, "my ssn is 123-45-6789"), (4, "part 123-45-6789"), (5, "call (555) 123-4567"), (6, "(555) 123-4567")],
                               "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.pii_digest(df).collect()}
    assert got[1] == "iban:5:32,iban:37:59" and got[2] == ""
    assert got[3] == "ssn:10:21" and got[4] == "" and got[5] == "phone_local:5:19" and got[6] == ""


def test_redaction_removes_every_span_and_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "x a@b.cc é 1.2.3.4 y", "keep"), (2, None, None), (3, "", "e"), (3, "", "e")], "doc_id long, text string, s string")
    got = sorted((r.doc_id, r.text) for r in pii.redact(df).filter("text IS NOT NULL").collect())
    assert got == [(1, "x <EMAIL> é <IP> y"), (3, ""), (3, "")]
    assert pii.redact(df).columns == ["doc_id", "text", "s"] and pii.redact(df.limit(0)).count() == 0


def test_urls_parts_and_rules(spark):
    given = ["http://A.Example.NET/en/1?x#y", None, "", "no scheme/net/", "ftp://net/", "http://net", "http://x.org/fr/a/b://c", "http://xexample.com/de/1",
             "http://example.com/de", "http://example.com/de/", "https://a.b.example.com/de/9#z", "http://É.org/fr/?q", "http://u@h:1/p?://q", "://x/y", "a\nb://h/p"]
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(given)], "page_id long, url string, host string, rule int")
    out = urls.judge(pages, spark.createDataFrame([], "url string, bad int"))
    rows = {r.page_id: r for r in out.collect()}
    for i, u in enumerate(given):
        host, path = brute.url_parts(u)
        rule, verdict = brute.url_rule(host, path, urls.RULES)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), u
        assert rows[i].verdict == (verdict or "allow")


def brute_templates(shapes):
    """{(host, shape): template} by the level rule, on {(host, shape): [pages, labelled, bad]}."""
    parts = {k: (k[1][1:] if k[1].startswith("/") else k[1]).split("/") if k[1] else [] for k in shapes}
    out, d, open_ = {k: "" for k in shapes}, 0, set(shapes)
    while open_:
        nodes = collections.defaultdict(lambda: collections.defaultdict(lambda: [0, 0, 0]))
        for k in open_:
            own = nodes[k[0], out[k]][parts[k][d] if d < len(parts[k]) else None]
            for i in range(3):
                own[i] += shapes[k][i]
        step = {}
        for node, branches in nodes.items():
            n, labelled, bad = (sum(b[i] for b in branches.values()) for i in range(3))
            variable = len(branches) >= urls.VARIABLE_MIN and n <= urls.VARIABLE_MEAN * len(branches)
            for seg, (_, own, own_bad) in branches.items():
                rest, rest_bad, p = labelled - own, bad - own_bad, bad / max(labelled, 1)
                spread = (p * (1 - p) * (1 / max(own, 1) + 1 / max(rest, 1))) ** 0.5
                apart = own > 0 and rest > 0 and abs(own_bad / max(own, 1) - rest_bad / max(rest, 1)) > urls.Z_APART * spread and not variable
                worse = own_bad * max(rest, 1) > rest_bad * own
                step[node, seg] = "$" if seg is None else seg if len(branches) == 1 or (apart and worse) else "*-" if apart else "*"
        for k in open_:
            out[k] += "/" + step[(k[0], out[k]), parts[k][d] if d < len(parts[k]) else None]
        d += 1
        if d % urls.LEVELS == 0:
            together = collections.Counter((k[0], out[k]) for k in open_)
            for k in list(open_):
                if together[k[0], out[k]] == 1 or len(parts[k]) <= d:
                    out[k] += "".join(f"/{x}" for x in parts[k][d:])
                    open_.discard(k)
    return out


def test_url_tree_reaches_every_depth(spark):
    rng = random.Random(8)
    rows = [(f"http://h.org/2024/{m}/{s}/{rng.getrandbits(60):x}z", int(s == "spam")) for s in ("spam", "news", "blog") for m in range(1, 61)]
    rows += [(f"http://g.org/a/b/c/d/e/{'bad' if i % 2 else 'good'}/f/{'x/' * (i % 5)}{chr(97 + i % 26)}q", i % 2) for i in range(120)]
    rows += [(f"http://e.org/{x}", 0) for x in ("", "/", "//", "a", "a/", "a/b/c/d/e/f/g/h", "a/b/c/d/e/f/g/i")]
    df = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = {r.url: r for r in urls.judge(df.select("page_id", "url"), df.select("url", "bad")).collect()}
    assert {r.verdict for u, r in got.items() if "/spam/" in u or "/bad/" in u} == {"block"}
    assert {r.verdict for u, r in got.items() if "/spam/" not in u and "/bad/" not in u} == {"allow"}
    shapes = collections.defaultdict(lambda: [0, 0, 0])
    key = lambda u: (brute.url_parts(u)[0], re.sub("[0-9]+", "#", brute.url_parts(u)[1]))
    for u, b in rows:
        shapes[key(u)] = [x + y for x, y in zip(shapes[key(u)], (1, 1, b))]
    want = brute_templates(shapes)
    assert {key(u): r.template for u, r in got.items()} == want


def test_url_tree_blocks_a_bad_branch_only(spark):
    rows = [(f"http://h.com/{b}/{i}", int(b == "spam")) for b in ("spam", "news", "blog") for i in range(60)]
    rows += [(f"http://h.com/{b}/x{i}/deep/er", None) for b in ("spam", "news") for i in range(5)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    out = urls.judge(pages, spark.createDataFrame([r for r in rows if r[1] is not None], "url string, bad int"))
    got = out.collect()
    assert {r.verdict for r in got if "/spam/" in r.url and "deep" not in r.url} == {"block"}
    assert {r.verdict for r in got if "/spam/" not in r.url} == {"allow"}
    assert len({r.template for r in got if "/news/" in r.url and "deep" not in r.url} | {r.template for r in got if "/blog/" in r.url}) == 1   # merged
    assert urls.judge(pages.limit(0), spark.createDataFrame([], "url string, bad int")).count() == 0


def test_quality_counts_equal_brute_force(spark, docs):
    texts = [None, "", " \t\n", "a b c d e a b c d e", "x " * 3000, "a b c d e f\n" * 4, "l\nl\n \nl", "😀 é" * 20, "a\x0bb\x0cc"]
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    df = docs.select("doc_id", "text").union(extra)
    given = {r.doc_id: r.text for r in df.collect()}
    out = quality.features(df)
    no_python(out)
    for r in out.collect():
        e = brute.quality_counts(given[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == e
        assert r.base_failed == (e[0] < 10 or 100 * e[4] > 20 * e[0])


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (5, 50, 458, 3000) for k in (0, 1, 3, 20) if k < n * 0.02]
    df = spark.createDataFrame(cases, "k long, n long").withColumn("t", quality.binomial_tail(F.col("k"), F.col("n"), 0.02))
    for r in df.collect():
        assert math.isclose(r.t, sum(math.comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.k + 1)), rel_tol=1e-8)


def test_quality_cutoffs_are_certified_per_stratum(spark):
    """Symbols mark bad documents in both languages, but only ``a`` has labels enough to certify it."""
    good, bad = "plain words of a text that goes on for a while", "pl$$$$n w%%%ds of a t**t that g&&s on for a while"
    rows = [(i, good if i % 2 else bad, "a" if i < 2000 else None, i % 2) for i in range(2060)]
    docs_, marks = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string"), spark.createDataFrame(
        [(r[0], bool(r[3])) for r in rows], "doc_id long, good boolean")
    got = quality.judge_quality(docs_, marks).collect()
    assert len(got) == len(rows)
    assert {(r.lang, r.doc_id % 2, r.kept) for r in got} == {("a", 0, False), ("a", 1, True), (None, 0, True), (None, 1, True)}
    assert quality.judge_quality(docs_.limit(0), marks).count() == 0


def test_decontamination_equals_brute_force(spark, docs):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    out = contamination.leaked_documents(docs, items)
    no_python(out)
    pairs = lambda df, c: [(r[c], r.text) for r in df.select(c, "text").collect()]
    got = {(r.doc_id, r.item_id) for r in out.collect()}
    assert got == brute.leaks(pairs(docs, "doc_id"), pairs(items, "item_id")) and got


def test_reparameterised_questions_need_consistent_slots(spark):
    items = spark.createDataFrame([(1, "If Alice has 3 apples and buys 12 more, then Alice gives 3 apples to Bob, how many apples remain in total?"),
                                   (2, "x"), (3, None), (4, "one two three four five six"), (5, "one two three four five six"), (None, "seven eight nine ten")],
                                  "item_id long, text string")
    swapped = "If Carol has 5 apples and buys 40 more, then Carol gives 5 apples to Dave, how many apples remain in total?"
    d = [(10, "Before. " + swapped + " yes"), (11, swapped.replace("Carol gives 5", "Eve gives 6")), (12, None), (13, ""), (13, ""),
         (14, "zero one two three four five six seven"), (15, "a b c " * 3000), (16, "so seven eight nine ten"), (None, "one two three four five six")]
    docs_ = spark.createDataFrame(d, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contamination.leaked_documents(docs_, items).collect()}
    assert set(got) == {(10, 1), (14, 4), (14, 5), (16, None), (None, 4), (None, 5)}
    assert got[10, 1].n_changed == 4
    kept = contamination.remove_leaks(docs_, items).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["11", "12", "13", "13", "15"]
    assert contamination.leaked_documents(docs_, items.limit(0)).count() == 0 and contamination.leaked_documents(docs_.limit(0), items).count() == 0


def test_partly_changed_slots_do_not_hide_a_leak(spark):
    long = "we counted 7 birds near the old stone bridge on that cold morning and later saw 7 birds more behind the tall green barn by the river"
    items = spark.createDataFrame([(1, long), (2, "a crate holds 3 apples and stays shut for 3 days so count the fruit")], "item_id long, text string")
    d = [(10, long), (11, long.replace("saw 7", "saw 9")), (12, "a crate holds 5 apples and stays shut for 7 days so count the fruit"),
         (13, long.replace("counted 7", "counted 4").replace("saw 7", "saw 9").replace("old", "new").replace("morning", "night").replace("tall", "low").replace("river", "sea"))]
    got = contamination.leaked_documents(spark.createDataFrame(d, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(10, 1), (11, 1), (12, 2)}


def test_leaks_in_other_white_space_quotes_and_case(spark):
    item = "on the old road Alice met a tall Baker who sold Carol seven loaves"
    d = [item, item.replace(" Alice", "\nAlice").replace(" Baker", "\tBaker").replace(" Carol", "  Carol"), item.lower(), item.upper(), item.title(),
         item.replace("Alice", '"Alice"').replace("Baker", "(Baker)").replace("Carol", "\u201cCarol\u201d"), "on the new path nobody met anyone at all"]
    df = spark.createDataFrame(list(enumerate(d)), "doc_id long, text string")
    for given in (item, item.lower()):
        out = contamination.leaked_documents(df, spark.createDataFrame([(1, given)], "item_id long, text string"))
        assert {r.doc_id for r in out.collect()} == {0, 1, 2, 3, 4, 5}


def test_names_at_sentence_starts_short_items_and_unspaced_scripts(spark):
    items = {1: "Ann has 3 apples. Ann eats 2. How many remain for Ann?", 2: "What is 12 plus 30?", 3: "小明有三个苹果他吃了两个还剩几个", 4: "Yes or no", 5: "3 4 5 6 7 8 9 10 11 12", 6: "どれ?"}
    d = {10: "Bob has 7 apples. Bob eats 4. How many remain for Bob?", 11: "Bob has 7 apples. Carl eats 4. How many remain for Dan?",
         12: "Test. What is 12 plus 30? I ask", 13: "What is 13 plus 30?", 14: "题目:小明有三个苹果,他吃了两个,还剩几个?", 15: "yes, or no!", 16: "Say yes or no now",
         17: "a 3 4 5 6 7 8 9 10 11 12 b", 18: "a 3 4 5 6 7 8 9 10 11 13 b", 19: "小红有五本书", 20: items[1].upper(), 21: "どれ", 22: "どれか", 23: "So " + items[1] + " How quick, and How late"}
    frame = lambda rows, c: spark.createDataFrame(list(rows.items()), f"{c} long, text string")
    out = contamination.leaked_documents(frame(d, "doc_id"), frame(items, "item_id"))
    no_python(out)
    assert {(r.doc_id, r.item_id) for r in out.collect()} == {(10, 1), (20, 1), (23, 1), (12, 2), (14, 3), (15, 4), (17, 5), (21, 6)}


def test_a_window_that_many_items_share_is_no_long_row(spark, docs):
    head = "please read the following question with care and answer it "
    own = lambda i: " ".join(f"{chr(97 + i // 26)}{c}{chr(97 + i % 26)}" for c in "klmnopqrstuv")
    items = spark.createDataFrame([(i, head + own(i)) for i in range(300)], "item_id long, text string")
    d = spark.createDataFrame([(i, head + "nothing else") for i in range(20)] + [(99, f"so {head} {own(7)}")], "doc_id long, text string")
    made = contamination.leaked_documents(d, items)
    got = {(r.doc_id, r.item_id) for r in made.collect()}
    norm = [(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in items.collect()]
    assert got == {(a, b) for a, b in brute.leaks(*norm)} | {(99, 7)}
    assert "at:array" not in plan_of(made)


def check_shards(rows, texts, shards=sharding.SHARDS):
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values(), default=0) - min((counts.get(s, 0) for s in range(shards)), default=0) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    groups = collections.defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        if texts[r.doc_id] is not None:
            groups[texts[r.doc_id]].add(r.shard)
    return groups


def test_shards_are_even_and_keep_groups(spark, docs, monkeypatch):
    out = sharding.shard_documents(docs)
    no_python(out)
    groups = check_shards(out.collect(), {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    sizes = collections.Counter(r.text for r in docs.select("text").collect())
    quota = docs.count() // sharding.SHARDS
    assert sum(len(g) > 1 for t, g in groups.items() if sizes[t] <= quota) <= 1
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 40)
    made = [(i, "hot" if i % 3 == 0 else (f"t{i // 4}" if i % 5 else None)) for i in range(1500)]
    groups = check_shards(sharding.shard_documents(spark.createDataFrame(made, "doc_id long, text string")).collect(), dict(made))
    assert len(groups["hot"]) <= 10 and sum(len(g) > 1 for t, g in groups.items() if t != "hot") <= 12


def test_shards_of_repeated_null_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (None, None, 2), (None, "", 3)], "doc_id long, text string, shard int")
    rows = sharding.shard_documents(df, shards=3).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert sharding.shard_documents(df.limit(0)).count() == 0


def test_chat_links_quotes_and_orders_replies(spark):
    m = [(1, 0, "user", "Hello there, how do I sort a list?\nSecond question: what is a tuple?"), (1, 1, "assistant", "Use sorted().\nA tuple is immutable."),
         (1, 2, "user", "> Use  SORTED().\nThanks, and in reverse?"), (1, 3, "bot", "On Monday Bob wrote:\n> Second question: what is a tuple?\nIt is like a list."),
         (1, 4, "user", ">> Use sorted().\n> Thanks, and in reverse?\n\nreverse=True"), (1, 4, "user", "same turn"), (None, 0, "x", None),
         (None, None, None, "> nothing"), (2, 5, "user", ""), (2, 7, "user", "y" * 50000), (2, 9, "user", "> said later"), (2, 11, "user", "said later"),
         (3, 1, "u", ">" * 20000 + " deep")]
    out = chat.reply_ordered(spark.createDataFrame(m, "conv_id long, turn long, role string, text string"))
    no_python(out)
    got = {(r.conv_id, r.turn, r.body[:20]): r for r in out.collect()}
    assert len(got) == len(m)
    parent = {(c, t): r.parent_turn for (c, t, _), r in got.items()}
    assert [parent[1, t] for t in range(5)] == [None, 0, 1, 0, 2] and parent[2, 7] == 5 and parent[2, 9] == 7 and parent[2, 11] == 9
    depth = {(c, t): r.depth for (c, t, _), r in got.items()}
    assert [depth[1, t] for t in range(5)] == [0, 1, 2, 1, 3]
    assert got[1, 3, "It is like a list."].formatted == "<|bot|>\nIt is like a list.\n"
    assert got[1, 4, "reverse=True"].n_quoted_lines == 2 and got[None, None, ""].position == 0
    order = sorted((r.position, t) for (c, t, _), r in got.items() if c == 1)
    assert [t for _, t in order] == [0, 1, 3, 2, 4, 4]
    assert chat.reply_ordered(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


QUOTING = [
    (1, 0, "a", "I went there on Monday. The shop was closed because of the long public holiday, they said. Will you go again?"), (1, 1, "b", "Hm."), (1, 2, "c", "Well."),
    (1, 3, "d", "> The shop was closed because of\n> the long public holiday, they said.\nWhich holiday?"),
    (2, 0, "a", "No"), (2, 1, "b", "Sure?"), (2, 2, "c", "Wait."), (2, 3, "a", "> No\nReally not"), (2, 4, "c", "> 好\nx"), (2, 5, "c", "好。行。"), (2, 6, "d", ">> 行\n> x\ny"),
    (3, 0, "a", "First point here.\nSecond point there."), (3, 1, "b", "Other words."), (3, 2, "c", "More words."),
    (3, 3, "d", "> First\n> point here.\nyes\n> Second\n> point there.\nno"), (3, 4, "e", "> point here\nnot a whole sentence"), (3, 5, "f", "")]


def test_chat_links_rewrapped_sentences_runs_and_short_quotes(spark):
    """Against a plain reading: the earliest earlier message that has the quoted sentence, line or text."""
    df = spark.createDataFrame(QUOTING, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.parent_turn, r.by_quote) for r in chat.reply_ordered(df).collect()}
    assert got[1, 3] == (0, True) and got[2, 3] == (0, True) and got[2, 4] == (3, False) and got[2, 6] == (4, True)
    assert got[3, 3] == (0, True) and got[3, 4] == (3, False)
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    for c, t, _, text in QUOTING:
        quoted = [x.lstrip("> ") for x in text.split("\n") if x.startswith(">")]
        said = [n for k, n, _, other in QUOTING if k == c and n < t and not other.startswith(">") and quoted
                and {plain(x) for x in re.split("[.!?。]+", " ".join(quoted))} & {plain(x) for x in re.split("[.!?。]+|\n", other)} - {""}]
        if not text.startswith(">>"):
            assert got[c, t] == ((min(said), True) if said else (t - 1 if t else None, False))


def test_chat_without_quotes_keeps_every_turn_in_order(spark):
    rows = QUERIES["op10_chat"](spark, SF_SMALL).collect()
    given = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    assert len(rows) == len(given)
    assert all(r.depth == r.position for r in rows)
    assert {(r.conv_id, r.turn, r.body) for r in rows} == {(r.conv_id, r.turn, r.text.strip()) for r in given}


def test_chat_sql_says_the_same(spark):
    import duckdb

    from tickvault.llm.oracles import CHAT
    m = [(1, 0, "user", "Hello there, how do I sort a list?\nSecond question: what is a tuple?"), (1, 1, "assistant", "Use sorted().\nA tuple is immutable."),
         (1, 2, "user", "> Use  SORTED().\nThanks, and in reverse?"), (1, 3, "bot", "On Monday Bob wrote:\n> Second question: what is a tuple?\nIt is like a list."),
         (1, 4, "user", ">> Use sorted().\n> Thanks, and in reverse?\n\nreverse=True"), (2, 5, "user", ""), (2, 9, "user", "> said later"), (2, 11, "user", "said later")]
    m += [(c + 10, *rest) for c, *rest in QUOTING]
    df = spark.createDataFrame(m, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    assert sorted(con.execute(CHAT).fetchall()) == sorted(tuple(r) for r in chat.reply_ordered(df).collect())
