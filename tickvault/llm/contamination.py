"""Benchmark decontamination by template windows.

A text becomes a token sequence in which numbers, names (capitalised words inside a sentence) and
units are typed placeholders, so a re-parameterised copy of a question ("Ann has 3 apples" /
"Bob has 7 apples") has the same template. Template windows of ``WINDOW`` tokens (and whole items
that are shorter) are hashed (64 bits) and joined with the documents' windows. A window with names is
hashed a second time with them as plain words, so that copies in other case match too. The windows that match
at one alignment of item and document are put together. An item leaks into a document if the matched
windows cover ``COVERAGE`` of it or run over ``RUN`` tokens, with at least ``LITERALS`` plain words
among them. Windows with unchanged slots count by themselves; those with changed slots count if the
slots are consistent: one value of the item always becomes the same value in the document (equal
numbers before different words are different values), or only one slot is changed. Items of fewer than
``LITERALS`` plain words leak only if a document holds all of their tokens with unchanged slots; of fewer
than ``LITERALS`` tokens, if it is nothing else.

A capitalised word at the start of a sentence is a name if the text has it as one elsewhere. Scripts without
blanks between words are cut into single characters.

DataFrame functions only. Null and empty texts have no tokens. Documents are compared by distinct
text, so copies cost nothing extra and all of them are reported. Ids may repeat or be null; equal rows are
reported alike, one row for each (document row, item id).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import drop_stages, let, stage, text_key

WINDOW, COVERAGE, RUN, LITERALS = 8, 0.5, 13, 4
#: Benchmark windows up to this many are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
UNITS = ("mm|cm|m|km|inch|inches|ft|feet|foot|yard|yards|mile|miles|mg|g|kg|lb|lbs|pound|pounds|oz|ounce|ounces|ton|tons|ml|l|litre|litres|"
         "liter|liters|gallon|gallons|second|seconds|minute|minutes|hour|hours|day|days|week|weeks|month|months|year|years|"
         "dollar|dollars|cent|cents|euro|euros|percent|degrees|mph|kmh|watts|volts|joules|newtons")
# a name: capitalised word after a small letter, digit or comma and any white space, quotes and
# brackets; it is marked with a leading U+0001 so that the tokens keep both the type and the value
_NAME = r"""([\p{Ll}\p{N},;:])[\s\p{Z}"'`\u2018-\u201f\u00ab\u00bb\u2039\u203a()\[\]{}]++(?=\p{Lu}\p{Ll})"""
# a capitalised word at the start of a text or sentence, marked U+0002
_START = r"""(^|[.!?…:;\n]["'`\u2018-\u201f\u00ab\u00bb)\]]*+)[\s\p{Z}"'`\u2018-\u201f\u00ab\u00bb(\[]*+(?=\p{Lu}\p{Ll})"""
#: Scripts written without blanks between words: every character is a token.
_UNSPACED = r"\u0e01-\u0edf\u1000-\u109f\u1780-\u17d3\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\x{20000}-\x{3ffff}"
_TOKEN = r"[\x01\x02]?[\p{L}\p{M}]+|[0-9]++(?:[.,][0-9]++)*+"
_TOKEN_OR_CHARACTER = rf"[\x01\x02]?[\p{{L}}\p{{M}}&&[^{_UNSPACED}]]+|[{_UNSPACED}]|[0-9]++(?:[.,][0-9]++)*+"


_NO_WINDOWS = "CAST(array() AS array<struct<w:int,pos:int,hash:bigint,slots:array<string>>>)"


def tokens(text: Column) -> Column:
    """Lower-cased words and numbers in order; names keep a leading U+0001."""
    clean = F.translate(F.coalesce(text, F.lit("")), "\x01\x02", "  ")

    def cut(marked: Column) -> Column:
        found = lambda low, pattern: F.regexp_extract_all(low, F.lit(pattern), F.lit(0))
        return let(F.lower(marked), lambda low: F.when(low.rlike(f"[{_UNSPACED}]"), found(low, _TOKEN_OR_CHARACTER)).otherwise(found(low, _TOKEN)))

    def starts(all_: Column) -> Column:
        names = F.array_distinct(F.filter(all_, lambda t: t.startswith("\x01")))
        name = lambda t: F.concat(F.lit("\x01"), F.substring(t, F.lit(2), F.length(t)))
        return let(names, lambda known: F.transform(all_, lambda t: F.when(~t.startswith("\x02"), t).when(
            F.array_contains(known, name(t)), name(t)).otherwise(F.ltrim(t, F.lit("\x02")))))
    # sentence starts matter only in texts that have names
    return let(F.regexp_replace(clean, _NAME, "$1 \x01"), lambda named: F.when(
        named.contains("\x01"), let(cut(F.regexp_replace(named, _START, "$1 \x02")), starts)).otherwise(cut(named)))


def _units() -> Column:
    return F.array(*[F.lit(u) for u in UNITS.split("|")])


def template(token_list: Column) -> Column:
    """The tokens with placeholders. A unit counts as one only right after a number."""
    typed = F.transform(token_list, lambda t: F.when(t.startswith("\x01"), NAME).when(t.rlike("^[0-9]"), NUMBER).otherwise(t))
    return let(typed, lambda ts: F.when(F.array_contains(ts, NUMBER), F.transform(ts, lambda t, i: F.when(
        (F.get(ts, i - 1) == NUMBER) & F.array_contains(_units(), t), UNIT).otherwise(t))).otherwise(ts))


def _literal(t: Column) -> Column:
    return ~t.isin(NUMBER, NAME, UNIT)


def windows(raw: Column, size: int, keyed: bool = False) -> Column:
    """array<struct<w, pos, hash, slots>> of all windows of ``size`` tokens: the 64-bit hash of the
    template window, and the values behind its placeholders in order (null if the text has none).
    ``keyed``: each value as struct<p, v, key>, with its position and what it must be consistent by."""
    kind = "struct<p:int,v:string,key:string>" if keyed else "string"
    none = F.expr(f"CAST(NULL AS array<{kind}>)")

    def at(h: Column, values: Column, starts: Column) -> Column:
        return F.transform(starts, lambda i: F.struct(
            F.lit(size).alias("w"), i.alias("pos"), F.xxhash64(*[F.get(h, i + k) for k in range(size)]).alias("hash"),
            F.when(values.isNull(), none).otherwise(F.filter(F.slice(values, i + 1, size), lambda v: v.isNotNull())).alias("slots")))

    def hashed(tpl: Column, words: Column, starts: Column) -> Column:
        def slot(t: Column, i: Column) -> Column:
            v = F.get(words, i)
            key = F.when(t == NUMBER, F.concat_ws(" ", v, F.get(words, i + 1))).otherwise(v)
            return F.when(~_literal(t), F.struct(i.alias("p"), v.alias("v"), key.alias("key")) if keyed else v)
        values = F.when(F.exists(tpl, lambda t: ~_literal(t)), F.transform(tpl, slot)).otherwise(none)
        return let(F.transform(tpl, lambda w: F.xxhash64(w)), lambda h: let(values, lambda v: at(h, v, starts)))

    def of(tpl: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(raw) - size)
        named = F.filter(starts, lambda i: F.array_contains(F.slice(tpl, i + 1, size), NAME))
        plain = F.transform(raw, lambda t: F.ltrim(t, F.lit("\x01")))
        folded = let(plain, lambda words: let(template(words), lambda t: let(named, lambda n: hashed(t, words, n))))
        return F.when(F.array_contains(tpl, NAME), F.concat(hashed(tpl, raw, starts), folded)).otherwise(hashed(tpl, raw, starts))

    empty = F.expr(_NO_WINDOWS.replace("array<string>", f"array<{kind}>"))
    return F.when(F.size(raw) < size, empty).otherwise(let(template(raw), of))


def _wanted(raw: Column, size: int) -> Column:
    """A document's windows of one size; of the smallest sizes only a document that is nothing else."""
    made = windows(raw, size)
    return made if size >= LITERALS else F.when(F.size(raw) == size, made).otherwise(F.expr(_NO_WINDOWS))


def contaminated(docs: DataFrame, benchmark: DataFrame, spent: list[str] | None = None) -> DataFrame:
    """(text_key, item_ids, null_id, n_tokens, covered, longest, n_slots, n_changed) for each distinct
    document text and distinct benchmark text that leaks into it. ``docs``: ``text``; ``benchmark``:
    ``item_id, text``.

    The texts are read once and never shuffled: only windows that occur in the benchmark leave the
    scan, with their slot values, and an alignment (text, item, shift) has at most as many of them
    as the item has tokens."""
    own: list[str] = [] if spent is None else spent
    items = (benchmark.select("item_id", tokens(F.col("text")).alias("raw")).withColumn("tpl", template(F.col("raw")))
             .filter(F.size("raw") > 0).groupBy("tpl", "raw").agg(F.collect_set("item_id").alias("item_ids"), F.max(F.col("item_id").isNull()).alias("null_id")))
    items = stage(items.withColumn("item_no", F.xxhash64("raw")), "bench-items", own)
    width = F.least(F.size("tpl"), F.lit(WINDOW))
    sizes = [r[0] for r in items.select(width.alias("w")).distinct().collect()]      # at most WINDOW values
    if not sizes:
        return docs.sparkSession.createDataFrame([], "text_key string, item_ids array<bigint>, null_id boolean, n_tokens int, covered int, "
                                                 "longest int, n_slots int, n_changed int")
    in_items = reduce(DataFrame.union, [items.filter(width == w).select("item_no", F.explode(windows(F.col("raw"), w, keyed=True)).alias("x")) for w in sizes])
    # a row for each window and item: a window that many items share is many rows, never one long list
    in_items = stage(in_items.select("item_no", "x.w", "x.hash", F.col("x.pos").alias("i_pos"), F.col("x.slots").alias("i_slots")).distinct(), "bench-windows", own)
    keys = in_items.select("w", "hash").distinct()
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_WINDOWS else keys
    # the number of tokens is a column of its own before the explode, whose rows would carry all tokens otherwise
    every = docs.select(text_key(F.col("text")).alias("text_key"), tokens(F.col("text")).alias("raw")).withColumn("size", F.size("raw"))
    every = every.select("text_key", "size", F.explode(F.concat(*[_wanted(F.col("raw"), w) for w in sizes])).alias("x"))
    found = every.select("text_key", "size", "x.*").join(keys, ["w", "hash"], "left_semi").distinct()
    pairs = F.coalesce(F.zip_with("i_slots", "slots", lambda a, b: F.struct(a["p"].alias("p"), a["v"].alias("a"), a["key"].alias("key"), b.alias("b"))),
                       F.expr("CAST(array() AS array<struct<p:int,a:string,key:string,b:string>>)"))
    same = ~F.exists("pairs", lambda x: x["a"] != x["b"])
    placed = (found.join(in_items, ["w", "hash"])
              .select("text_key", "size", "item_no", (F.col("pos") - F.col("i_pos")).alias("shift"), F.col("i_pos").alias("pos"), "w", pairs.alias("pairs"))
              .groupBy("text_key", "size", "item_no", "shift").agg(F.collect_set(F.struct("pos", "w", "pairs", same.alias("same"))).alias("hits")))
    step = lambda acc, s: F.struct(F.when(s, acc["run"] + 1).otherwise(0).alias("run"),
                                   F.greatest(acc["best"], F.when(s, acc["run"] + 1).otherwise(0)).alias("best"))

    def evidence(df: DataFrame, tail: str) -> DataFrame:
        """The tokens that the hits (``_same``: those with unchanged slots) cover, and whether they are enough."""
        hit, covered, longest, literals = (c + tail for c in ("hit", "covered", "longest", "literals"))
        at = F.transform(F.sequence(F.lit(0), F.size("tpl") - 1), lambda p: F.exists(
            "hits", lambda h: (h["same"] | F.lit(not tail)) & (h["pos"] <= p) & (p < h["pos"] + h["w"])))
        return (df.withColumn(hit, at).withColumn(covered, F.size(F.filter(hit, lambda x: x)))
                .withColumn(longest, F.aggregate(hit, F.struct(F.lit(0).alias("run"), F.lit(0).alias("best")), step, lambda acc: acc["best"]))
                .withColumn(literals, F.size(F.filter(F.zip_with(hit, "tpl", lambda s, t: s & _literal(t)), lambda x: x)))
                .withColumn("enough" + tail, ((F.col(covered) >= COVERAGE * F.size("tpl")) | (F.col(longest) >= RUN)) & (F.col(literals) >= LITERALS)))

    distinct = lambda of: F.size(F.array_distinct(F.transform("pairs", of)))
    judged = (placed.join(items, "item_no").withColumn("pairs", F.array_distinct(F.flatten(F.transform("hits", lambda h: h["pairs"]))))
              .withColumn("slots", F.array_distinct(F.transform("pairs", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))))
              .withColumn("n_tokens", F.size("tpl")).withColumn("n_slots", F.size("slots"))
              .withColumn("n_changed", F.size(F.filter("slots", lambda x: x["a"] != x["b"])))
              .withColumn("consistent", (distinct(lambda x: x["key"]) == distinct(lambda x: F.struct(x["key"], x["b"])))
                          | (F.size(F.array_distinct(F.transform(F.filter("pairs", lambda x: x["a"] != x["b"]), lambda x: x["p"]))) <= 1)))
    judged = evidence(evidence(judged, ""), "_same")
    plain = F.size(F.filter("tpl", _literal))
    exact = (F.col("covered_same") == F.size("tpl")) & ((F.size("tpl") >= LITERALS) | (F.col("size") == F.size("tpl")))
    leaks = judged.filter(F.when(plain >= LITERALS, (F.col("enough") & F.col("consistent")) | F.col("enough_same")).otherwise(exact))
    best = F.max(F.struct("covered", "longest", "n_tokens", "n_slots", "n_changed"))
    return (leaks.groupBy("text_key", "item_no").agg(best.alias("b"), F.first("item_ids").alias("item_ids"), F.first("null_id").alias("null_id"))
            .select("text_key", "item_ids", "null_id", "b.n_tokens", "b.covered", "b.longest", "b.n_slots", "b.n_changed"))


def leaked_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per leaking document row and item: doc_id, item_id and the evidence."""
    spent: list[str] = []
    leaks = stage(contaminated(docs, benchmark, spent), "bench-leaks")
    drop_stages(docs.sparkSession, spent)
    at = docs.select("doc_id", text_key(F.col("text")).alias("text_key"))
    ids = F.when(F.col("null_id"), F.concat("item_ids", F.array(F.lit(None).cast("long")))).otherwise(F.col("item_ids"))
    return (at.join(leaks, "text_key").select("doc_id", F.explode(ids).alias("item_id"), "n_tokens", "covered", "longest", "n_slots", "n_changed"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows into which a benchmark item leaks."""
    spent: list[str] = []
    leaks = stage(contaminated(docs, benchmark, spent).select(F.col("text_key").alias("__key")).distinct(), "bench-leaks")
    drop_stages(docs.sparkSession, spent)
    return docs.withColumn("__key", text_key(F.col("text"))).join(leaks.hint("merge"), "__key", "left_anti").drop("__key")
