"""Personal data: patterns propose spans, checksums and ranges confirm them, nearby words adjust
the score. DataFrame functions only; one pass over each text, no shuffle.

Kinds ``email ip card phone`` follow the fixed definition (leftmost, non-overlapping per kind; a
match that fails its check is dropped, no retry). The method adds ``iban`` (mod 97), ``ssn`` and
``phone_local`` (both only beside a fitting context word), where they overlap no other span.

Null text: empty text, so no spans. Empty or very long texts: whole text, linear patterns
(possessive loops, no backtracking or recursion). Repeated rows, null ids and extra columns pass
through unchanged, row by row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import let

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "phone_local")

# A start inside a run of pattern characters would have matched from the run's beginning, so only
# run beginnings (or the end of the previous match) are tried; that keeps long runs linear.
_START = r"(?:\G|(?<![{0}]))"
PATTERNS = {
    "email": _START.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _START.format("0-9") + r"[0-9]++(?:\.[0-9]++){3}",
    # runs of fewer than 12 digits fail the check anyway and never overlap a longer run
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "phone_local": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Score of a confirmed span before its context is looked at, and the words that raise it.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.5, "phone_local": 0.5}
CONTEXT = {
    "email": "mail|contact|write", "ip": r"\bip\b|address|host|server", "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|fax|mobile|whatsapp", "iban": "iban|account|bank",
    "ssn": "ssn|social security", "phone_local": "phone|call|tel|fax|mobile|whatsapp",
}
CONTEXT_BONUS, CONTEXT_CHARS, ACCEPT = 0.3, 40, 0.7


def luhn(digits: Column) -> Column:
    """Luhn checksum of a string of digits."""
    def step(total: Column, i: Column) -> Column:
        v = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return total + F.when(twice & (v > 4), v * 2 - 9).when(twice, v * 2).otherwise(v)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(iban: Column) -> Column:
    """ISO 7064 mod 97-10 of an account number without spaces."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    def step(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    """Does a proposed span pass the check of its kind?"""
    def digits(low: int, high: int, check=None) -> Column:
        return let(F.regexp_replace(match, "[^0-9]", ""), lambda d: F.when(
            F.length(d).between(low, high), check(d) if check else F.lit(True)).otherwise(False))
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda q: F.when(
            F.length(q) <= 3, F.concat(F.lit("0"), q).cast("int") <= 255).otherwise(False)))
    if kind == "card":
        return digits(12, 19, luhn)
    if kind == "phone":
        return digits(9, 15)
    if kind == "iban":
        return let(F.replace(match, F.lit(" "), F.lit("")), lambda s: F.when(
            F.length(s).between(15, 34), mod97(s)).otherwise(False))
    return F.lit(True)


def proposals(text: Column, kind: str) -> Column:
    """array<struct<start, kind_no, end, score>> of the confirmed spans of one kind, in order.

    The pieces between the matches give the positions (code points, end exclusive) and the words
    just before and after each match."""
    empty = F.expr("CAST(array() AS array<struct<start:int,kind_no:int,end:int,score:double>>)")

    def spans(matches: Column, gaps: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            match, gap = F.get(matches, i), F.get(gaps, i)
            start = acc["pos"] + F.length(gap)
            near = F.lower(F.concat_ws(" ", F.right(gap, F.lit(CONTEXT_CHARS)), F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS // 2))))
            score = F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
            span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"),
                            (start + F.length(match)).alias("end"), F.least(score, F.lit(1.0)).alias("score"))
            return F.struct((start + F.length(match)).alias("pos"),
                            F.when(confirmed(kind, match), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), F.struct(F.lit(0).alias("pos"), empty.alias("out")),
                           step, lambda acc: acc["out"])

    return let(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), lambda m: F.when(F.size(m) == 0, empty).otherwise(
        let(F.split(text, PATTERNS[kind], -1), lambda g: spans(m, g))))


def find_spans(df: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """``df`` with ``out``: every personal-data span of the whole text, by start, then kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(*[proposals(whole, k) for k in BASE_KINDS])
    extra = F.concat(*[proposals(whole, k) for k in KINDS[len(BASE_KINDS):]])
    both = let(base, lambda b: F.concat(b, F.filter(extra, lambda e: (e["score"] >= ACCEPT) & ~F.exists(
        b, lambda x: (x["start"] < e["end"]) & (e["start"] < x["end"])))))
    return df.withColumn(out, F.array_sort(both))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each span in ``text`` replaced by its kind in angle brackets; overlapping spans
    become one. A null text stays null."""
    found = find_spans(df, text, "__spans")
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    whole = F.col(text)

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["pos"]
        between = F.substring(whole, acc["pos"] + 1, s["start"] - acc["pos"])
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.when(
            apart, F.concat(acc["out"], F.array(between, F.get(names, s["kind_no"])))).otherwise(acc["out"]).alias("out"))

    masked = F.aggregate(F.col("__spans"), F.struct(F.lit(0).alias("pos"), F.expr("CAST(array() AS array<string>)").alias("out")), step,
                         lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(whole, acc["pos"] + 1, F.length(whole))))
    return found.withColumn(text, F.when(F.size("__spans") == 0, whole).otherwise(masked)).drop("__spans")


def pii_digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans and all spans."""
    found = find_spans(docs.select("doc_id", "text"), "text", "s")
    of = lambda k: F.size(F.filter("s", lambda x: x["kind_no"] == KINDS.index(k))).cast("long")
    base = F.filter("s", lambda x: x["kind_no"] < len(BASE_KINDS))
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("s")).alias("spans"))
