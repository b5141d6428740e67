import collections
import re
import html as entities
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tickvault.llm import html_text, langid, neardup, packing
from tickvault.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def tokenize():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.tokenizer_file())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, packing.END]


def check_packing(rows, tokens, capacity):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(tokens)
    for d, own in by_doc.items():
        ids, at = np.array(tokens[d], "<u4"), 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(ids[at:at + r.length].tobytes()))
            assert len(ids) <= capacity or k == 0 or r.length == capacity
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence), -(-sum(map(len, tokens.values())) // capacity)


def test_packing_is_whole_gapless_and_near_the_bound(spark, docs, tokenize):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    used, bound = check_packing(QUERIES["op1_packing"](spark, SF_SMALL).collect(), {d: tokenize(t) for d, t in texts.items()}, packing.CAPACITY)
    assert bound <= used <= bound * 1.02 + 1


def test_packing_of_odd_texts(spark, tokenize, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 2)
    texts = {1: "a", 2: None, 3: "", 4: "word " * 3000, 5: "é😀中" * 500, 6: "<|endoftext|> x", 7: "a" * 5000, 8: " \n\t ", None: "null id"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("offset", F.lit("clash"))
    check_packing(packing.pack(df, capacity=64).collect(), {d: tokenize(t) for d, t in texts.items()}, 64)
    again = packing.packed_pieces(df.union(df), capacity=64).collect()
    assert len(again) == 2 * packing.pack(df, capacity=64).count()
    seen = collections.Counter((r.sequence_id, r.offset) for r in again)
    assert set(seen.values()) == {1} and all(len(r.ids) == r.length for r in again)
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_gives_special_token_strings_their_id(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.tokenizer_file())
    texts = {1: "a <|endoftext|> b", 2: "<|endoftext|>", 3: "x<|endoftext|><|endoftext|>\n y", 4: " <|endoftext |> <|endoftext", 5: "é<|endoftext|>中 " * 40}
    tokens = {d: [*t.encode(x, add_special_tokens=False).ids, packing.END] for d, x in texts.items()}
    assert tokens[1] == [64, 220, 50256, 275, packing.END]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_packing(packing.pack(df, capacity=64).collect(), tokens, 64)


def test_packing_of_very_long_white_space(spark, tokenize):
    texts = {1: " " * 1_000_000 + "x", 2: "a" + "\n" * 400_000 + "\t \u00a0" * 200_000 + "é", 3: "x " * 60_000, 4: "y" + "\u3000" * 150_000}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    check_packing(packing.pack(df).collect(), {d: tokenize(t) for d, t in texts.items()}, packing.CAPACITY)


def test_the_program_places_most_pieces_and_never_loses_to_best_fit():
    """On a lognormal histogram (very many short pieces) best-fit still places most: known, see the README."""
    rng = np.random.default_rng(2)
    for sizes, most in ((rng.integers(100, 900, 20_000), 0.35), (rng.integers(600, 761, 50_000), 0.35), (np.clip(rng.lognormal(5.3, 1.1, 50_000).astype(int) + 1, 1, 2047), 0.85)):
        given = collections.Counter(sizes.tolist())
        lengths = np.array(sorted(given))
        alone = packing.best_fit(lengths, np.array([given[x] for x in lengths.tolist()]), packing.CAPACITY)
        assert packing.sequences(packing.plan(given)) <= packing.sequences(alone)
        made, left = packing.lp_fillings(given)
        assert left.total() < most * len(sizes) and sum(n * len(f) for f, n in made) + left.total() == len(sizes)


def test_plans_cover_the_histogram_exactly():
    rng = np.random.default_rng(5)
    for lengths in (rng.integers(1, 65, 500), np.full(77, 33), np.array([64] * 9), rng.integers(30, 40, 900), np.array([1])):
        given = collections.Counter(lengths.tolist())
        made = packing.plan(dict(given), 64, 60)
        used = collections.Counter()
        for filling, n in made:
            assert sum(filling) <= 64 and n > 0
            for x in filling:
                used[x] += n
        assert used == given
        bound = max(-(-int(lengths.sum()) // 64), int((lengths > 32).sum()))
        if lengths.min() > 64 // 3:                            # two a bin at most: pairing is the optimum
            left, bound = sorted(lengths.tolist()), 0
            while left:
                bound, x = bound + 1, left.pop()
                if left and left[0] + x <= 64:
                    left.pop(max(i for i, y in enumerate(left) if y + x <= 64))
        assert sum(n for _, n in made) <= bound * 1.05 + 1


def test_knapsack_finds_the_best_filling():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = np.unique(rng.integers(2, 12, 4))
        value = rng.random(len(lengths))
        best = [0.0] * 31
        for c in range(1, 31):
            best[c] = max([best[c - 1]] + [best[c - x] + v for x, v in zip(lengths, value) if x <= c])
        got = packing.knapsack(lengths, value, np.full(len(lengths), 99.0), 30)
        assert abs(sum(value[list(lengths).index(x)] * k for x, k in got.items()) - best[30]) < 1e-9
        assert sum(x * k for x, k in got.items()) <= 30


def test_language_held_out_accuracy(spark, docs):
    rows = QUERIES["op2_language"](spark, SF_SMALL.replace("0.001", "0.01")).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "lang").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_language_of_odd_texts_and_tables(spark, docs):
    odd = [(1, None, None), (2, "", "en"), (3, "123 !! 😀", None), (None, "the and of that", None), (4, "x" * 300000, None), (4, "中文字符测试", "q")]
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    df = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in langid.predict(df, model).collect()]
    assert len(got) == 6 and [(g[1], g[2]) for g in got[:3]] == [("und", True)] * 3 and got[3][:2] == (None, "en")
    empty = langid.fit(docs.select("doc_id", "text", "lang").limit(0))
    assert {(r.lang_pred, r.score) for r in langid.predict(df, empty).collect()} == {("und", 0.0)}
    assert langid.languages(docs.limit(0)).count() == 0


def test_language_rejects_unlearnt_languages_and_letter_junk(spark):
    """Also where the softmax can't: with one learnt language it is always 1, with two at least 0.5."""
    docs = spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/documents.parquet")
    texts = collections.defaultdict(list)
    for r in docs.select("lang", "text").collect():
        texts[r.lang].append(r.text)
    rng = np.random.default_rng(1)
    junk = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    "), 400)) for _ in range(50)]
    junk += ["Tämä on suomenkielinen teksti, jossa kerrotaan kaupungista ja sen asukkaista hyvin pitkästi ja perusteellisesti.",
             "Ez egy magyar nyelvű szöveg, amely a városról és lakóiról szól hosszasan és alaposan.",
             "Это русский текст о городе и его жителях, довольно длинный."]
    for learnt in (["en"], ["de", "en"], ["de", "en", "es", "fr"]):
        model = langid.fit(docs.filter(F.col("lang").isin(learnt)).select("doc_id", "text", "lang"))
        rejected = lambda rows: [s < model.threshold for s in model.predict(rows)[1]]
        assert all(rejected(junk)), learnt
        for lang in texts:
            assert np.mean(rejected(texts[lang])) <= 0.01 if lang in learnt else np.mean(rejected(texts[lang])) >= 0.9, (learnt, lang)
        mixed = [a[:400] + " " + b[:400] for i, x in enumerate(learnt) for z in learnt[i + 1:] for a, b in zip(texts[x][:40], texts[z])]
        assert not mixed or np.mean(rejected(mixed)) <= 0.02


def test_whole_texts_are_scored_across_chunks(docs, monkeypatch):
    rows = [r.text for r in docs.select("text").limit(40).collect()] + [None, ""]
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b"], langid.letter_table(), rng.normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.zeros(2))
    sums, n = model.score_sums(rows)
    one = [model.score_sums([t]) for t in rows]
    assert np.allclose(sums, np.concatenate([s for s, _ in one])) and (n == np.concatenate([k for _, k in one])).all()


def expected_text(page: str) -> str:
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    parts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", inside))
    return "\n".join(p for p in parts if p)


def test_html_text_is_the_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/pages.parquet").collect()}
    rows = QUERIES["op5_html_text"](spark, SF_SMALL.replace("0.001", "0.01")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text) == (pages[r.page_id].url, expected_text(pages[r.page_id].html)) and r.n_chars == len(r.text)


ARTICLE = "<p>One, two, and three.</p><p>Four &lt;x&gt; &amp; five&nbsp;six.</p><h2>Seven</h2><p>Eight, nine.</p>"
TEXT = "One, two, and three.\nFour <x> & five six.\nSeven\nEight, nine."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<p>a<br>b</p>", "a b"),
    (f"<body><div class='sidebar'>x, y.</div><div id=content>{ARTICLE}</div><div class='user-comments'><p>Nice, very long, comment, yes.</p></div>", TEXT),
    (f"<header>Site, name</header><main>{ARTICLE}<aside>Ad, ad.</aside><form>Mail: <input></form></main><footer>(c), all.</footer>", TEXT),
    (f"<nav><ul><li><a>m</a></ul></nav><table><tr><td>{ARTICLE}</td></tr></table>", TEXT),
    (f"<div role=navigation>a, b, c.</div><article>{ARTICLE}<section class='comments'><article><p>No, no, no.</p></article></section></article>", TEXT),
    ("<article><p>x <b>y</b>z<script>if(a<b){}</script> w</p><div style='display: none'>h</div><div class=cookie-notice>n</div></article>", "x yz w"),
    ("<article><ul><li>a<li>b</ul><pre>c  d\n e</pre></article>", "a\nb\nc d e"), ("<" * 3000, "<" * 3000), ("<p>" * 5000 + "x", "x"),
    ("<div>" * 3000 + "deep, text.", "deep, text."), ("</p></div>z", "z"), ("<article><p>cut in the mid", "cut in the mid"), ('<a href="' * 2000, ""),
])
def test_html_cases(page, text):
    assert html_text.main_text(page) == text


PROSE = "The committee met on Tuesday, and it agreed to publish the whole report; nobody objected, and the minutes were signed."


def prose(name):
    return f"{name}: {PROSE}"


@pytest.mark.parametrize("page,text", [
    ("<nav><a>Home</a></nav><article><h1>One</h1><p>{a} {b}</p></article><article><p>{c}</p></article><footer>f</footer>", "One\n{a} {b}\n{c}"),
    ("<div class=x><p>{a}</p></div><article><h1>T</h1><p>{b} {c}</p><p>{b}</p></article><div>Log in</div>", "{a}\nT\n{b} {c}\n{b}"),
    ("<article><p>{a}</p><div class='social-history'><p>{b}</p></div><div class='social-share'>Share it</div></article>", "{a}\n{b}"),
    ("<article><p>{a}</p><div class='share-price'>up</div></article>", "{a}"),
    ("<article><p>He <button>b</button> sat, and <label>x<b>y</b></label>then he stood up.</p></article>", "He sat, and then he stood up."),
    ("<div id=top><a>Home</a><a>News</a></div><div id=c><h2>Head</h2><p>{a}</p><p>Short.</p><p>{b}</p></div><div id=z><a>Terms</a></div>", "Head\n{a}\nShort.\n{b}"),
    ("<main><p>{a}</p></main><div class='user-comments'><p>{b}</p></div><div class='advert2'><p>{c}</p></div>", "{a}"),
    ("<article><p>{a}</p><form><p>{b}</p></form><select><option>o</select></article>", "{a}")])
def test_html_paths_decide(page, text):
    parts = {k: prose(k) for k in "abc"}
    assert html_text.main_text(page.format(**parts)) == text.format(**parts)


def test_html_ratios_change_the_result(monkeypatch):
    """With constant ratios every block is as good as any other: teasers come in."""
    page = f"<div id=a><a>Home</a><a>News</a></div><div id=b><p>{PROSE}</p><p>{PROSE}</p></div><div id=c><span>Terms</span></div>"
    assert html_text.main_text(page) == f"{PROSE}\n{PROSE}"
    monkeypatch.setattr(html_text, "_smooth", lambda v: np.ones(len(v)))
    assert html_text.main_text(page) == f"HomeNews\n{PROSE}\n{PROSE}\nTerms"


def test_html_table_with_odd_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>a</p>", "old"), (1, "u", "<p>a</p>", "old"), (None, None, None, None)], "page_id long, url string, html string, text string")
    rows = html_text.extract(df).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in rows) == [("1", "a", 1), ("1", "a", 1), ("None", "", 0)]
    assert html_text.extract(df.limit(0)).count() == 0


def bag_arrays(counts: dict, salt: int):
    h = neardup.mix(np.array(sorted(counts), np.uint64) + np.uint64(salt * 1000003))
    order = np.argsort(h)
    return h[order], np.array([counts[k] for k in sorted(counts)])[order]


@pytest.mark.parametrize("a, b", [({3: 5}, {3: 4}), ({1: 1, 2: 1, 4: 2}, {1: 1, 2: 3, 5: 2}), ({i: i % 7 + 1 for i in range(60)}, {i: i % 5 + 1 for i in range(5, 70)})])
def test_signatures_are_unbiased(a, b):
    hits, n, true = 0, 0, 0.0
    for salt in range(1, 9):
        x, y = bag_arrays(a, salt), bag_arrays(b, salt)
        true = neardup.similarity(x, y)
        s = neardup.signatures([x, y], 4000)
        hits, n = hits + int((s[0] == s[1]).sum()), n + 4000
    assert abs(hits / n - true) < 5 * (true * (1 - true) / n) ** 0.5


def test_signature_does_not_depend_on_the_batch(docs):
    bags = [neardup.shingles(r.text) for r in docs.select("text").limit(30).collect()]
    together = neardup.signatures(bags)
    assert all((neardup.signatures([b])[0] == s).all() for b, s in zip(bags, together))


def test_words_are_hashed_alike_across_chunks(monkeypatch):
    text = "Alpha beta\tgamma\n" * 500 + "x" * 3000 + " end"
    whole = neardup.word_hashes(text)
    monkeypatch.setattr(neardup, "CHUNK_BYTES", 64)
    assert (neardup.word_hashes(text) == whole).all() and len(whole) == len(text.split())


def test_near_duplicate_classes_equal_brute_force(spark, docs, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    made = {}
    for i in range(150):                                       # one large group around the threshold
        w = list(base)
        for _ in range(rng.integers(0, 5)):
            w[rng.integers(120)] = f"x{rng.integers(10**6)}"
        made[10**6 + i] = " ".join(w)
    made |= {2 * 10**6: None, 2 * 10**6 + 1: "", 2 * 10**6 + 2: "a b", 2 * 10**6 + 3: "A  b", 2 * 10**6 + 4: made[10**6], 2 * 10**6 + 5: "  "}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + list(made.items())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute.near_classes(rows)
    sizes = collections.Counter(expected.values())
    for large, rare in ((neardup.LARGE_BUCKET, neardup.RARE), (2, 3), (10**9, 1)):      # bounds as they are, everywhere, nowhere
        monkeypatch.setattr(neardup, "LARGE_BUCKET", large)
        monkeypatch.setattr(neardup, "RARE", rare)
        got = neardup.near_duplicates(df).collect()
        assert {r.doc_id: r.class_id for r in got} == expected and all(r.class_size == sizes[r.class_id] for r in got)
    kept = neardup.keep_one(df)
    assert kept.columns == ["doc_id", "text"] and {r.doc_id for r in kept.collect()} == set(expected.values())


def test_near_duplicates_of_repeated_and_null_rows(spark):
    same = "a b c d e f g"
    df = spark.createDataFrame([(1, same, "x"), (1, same, "x"), (None, same, "x"), (None, None, None), (5, None, "q")], "doc_id long, text string, node string")
    got = neardup.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.class_id, r.class_size) for r in got) == [("1", 1, 3), ("1", 1, 3), ("5", 5, 2), ("None", 1, 3), ("None", 5, 2)]
    assert sorted(tuple(r) for r in neardup.keep_one(df).collect()) == [(1, same, "x"), (5, None, "q")]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 8)], [(9, i) for i in range(8)], [(1, 1)], [], [(1, 2), (3, 4), (2, 1), (4, 3)]])
def test_components(spark, edges):
    key = lambda i: bytes([zlib.crc32(str(i).encode()) % 251, i])
    spent: list[str] = []
    got = neardup.components(spark.createDataFrame([(key(a), key(b)) for a, b in edges], "a binary, b binary"), spent).collect()
    parent = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    groups = collections.defaultdict(set)
    for r in got:
        groups[bytes(r.root)].add(bytes(r.node))
    expected = collections.defaultdict(set)
    for x, p in parent.items():
        expected[p].add(key(x))
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_pipeline_equals_a_plain_version(spark, docs, tokenize):
    """run() against the same decisions made in plain Python, over every row of the small table."""
    from tests.llm.test_native import pii
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    langs, score = model.predict(list(rows.values()))
    kept = {d: t for (d, t), x, s in zip(rows.items(), langs, score) if x != "und" and s >= model.threshold}
    classes = brute.near_classes(list(kept.items()))
    kept = {d: kept[d] for d in set(classes.values())}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute.leaks(list(kept.items()), items)}
    kept = {d: t for d, t in kept.items() if d not in leaked}
    for d, t in kept.items():
        for kind, a, b in reversed(brute.pii_spans(t)):
            kept[d] = kept[d][:a] + f"<{kind.upper()}>" + kept[d][b:]
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    used, bound = check_packing(got, {d: tokenize(t) for d, t in kept.items()}, packing.CAPACITY)
    assert used <= bound * 1.02 + 1 and all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)


def test_pipeline_stages_keep_columns_and_survive_odd_rows(spark, docs):
    odd = spark.createDataFrame([(None, None, None, None, None, "x"), (10**9, "", "en", "s", 0, "x"), (10**9, "", "en", "s", 0, "x"), (None, "the and of that it is", None, None, 3, None)],
                                "doc_id long, text string, lang string, source string, n_chars long, score string")
    d = docs.withColumn("score", F.lit("kept")).union(odd)
    for name, step in corpus_pipeline.STAGES[:-1]:
        d = corpus_pipeline.stage(step(spark, d, SF_SMALL), "test")
        assert d.columns == [*docs.columns, "score"], name
    assert d.filter("score = 'kept'").count() > 0 and d.filter("text IS NULL").count() == 0
    empty = docs.limit(0)
    for name, step in corpus_pipeline.STAGES:
        out = corpus_pipeline.stage(step(spark, empty, SF_SMALL), "test")
        assert out.count() == 0, name
