"""Documents whose fields change (P1, S1-S3): VARIANT next to the typed columns, and a report of the drift.

A document is parsed once into a VARIANT. The declared fields are cast out of it as before; what the declared
schema does not name is kept, as VARIANT, in ``extra``, so a field that a source adds is there for
the day someone wants it. ``drift`` counts, for every path of the documents, the types seen and whether the
schema knows them. It goes down level by level as far as the declared schema goes, so a path count is
bounded by schema depth times the fields seen; map keys and array places are one path each (``*``).
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Type names of VARIANT values that a declared type takes without loss.
_TAKES = {T.StringType: ("STRING",), T.BooleanType: ("BOOLEAN",), T.LongType: ("BIGINT",), T.IntegerType: ("BIGINT",),
          T.DoubleType: ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), T.FloatType: ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")}


def parsed(docs: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """``docs`` with ``doc`` (VARIANT, NULL if the text is no JSON), ``typed`` (struct of the declared schema; fields of
    another type are NULL) and ``extra`` (VARIANT object of the top-level fields that the schema does not name)."""
    out = docs.withColumn("doc", F.try_parse_json(value))
    fields = [F.expr(f"try_variant_get(doc, '$[\"{f.name}\"]', '{f.dataType.simpleString()}')").alias(f.name) for f in schema.fields]
    top = F.from_json(value, "map<string,variant>")
    known = F.array(*[F.lit(n) for n in schema.fieldNames()])
    extra = F.map_filter(top, lambda k, v: ~F.array_contains(known, k))
    return out.withColumn("typed", F.when(F.col("doc").isNotNull(), F.struct(*fields))).withColumn(
        "extra", F.when(F.size(extra) > 0, F.try_parse_json(F.to_json(extra))))


def _kind(v: Column) -> Column:
    """The outer type of a VARIANT: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, ..., VOID."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _fits(kind: Column, t: T.DataType | None) -> Column:
    if t is None:
        return F.lit(False)
    if isinstance(t, (T.StructType, T.MapType)):
        return kind.isin("OBJECT", "VOID")
    return kind.isin("ARRAY", "VOID") if isinstance(t, T.ArrayType) else kind.isin(*_TAKES.get(type(t), ()), "VOID")


def _walk(rows: DataFrame, t: T.DataType, path: str) -> Iterator[DataFrame]:
    """(doc_no, path, kind, status) one level below ``rows`` (doc_no, v), then of the levels below that; one pass over
    the documents for each container in the declared schema."""
    if isinstance(t, T.ArrayType):
        each = rows.select("doc_no", F.explode(F.expr("try_variant_get(v, '$', 'array<variant>')")).alias("v")).withColumn("name", F.lit("*"))
        declared = {"*": t.elementType}
    else:
        each = rows.select("doc_no", F.explode(F.expr("try_variant_get(v, '$', 'map<string,variant>')")).alias("name", "v"))
        each = each.withColumn("name", F.lit("*")) if isinstance(t, T.MapType) else each
        declared = {"*": t.valueType} if isinstance(t, T.MapType) else {f.name: f.dataType for f in t.fields}
    each = each.withColumn("kind", _kind(F.col("v")))
    status = F.lit("new")
    for name, of in declared.items():
        status = F.when(F.col("name") == name, F.when(_fits(F.col("kind"), of), "known").otherwise("type")).otherwise(status)
    yield each.select("doc_no", F.concat(F.lit(path + "."), "name").alias("path"), "kind", status.alias("status"))
    for name, of in declared.items():
        if isinstance(of, (T.StructType, T.MapType, T.ArrayType)):
            inner = each.filter((F.col("name") == name) & _fits(F.col("kind"), of) & (F.col("kind") != "VOID")).select("doc_no", "v")
            yield from _walk(inner, of, f"{path}.{name}")


def drift(docs: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """(path, kind, status, n_docs): for each path and type seen the number of documents with it. status: ``known``, ``new``
    (the schema has no such field) or ``type`` (it has, with another type); texts that are no JSON objects are path ``$``
    with status ``type``."""
    rows = docs.select(F.monotonically_increasing_id().alias("doc_no"), F.try_parse_json(value).alias("v"))
    whole = F.coalesce(_kind(F.col("v")), F.lit("NOT JSON"))
    odd = rows.filter(whole != "OBJECT").select("doc_no", F.lit("$").alias("path"), whole.alias("kind"), F.lit("type").alias("status"))
    seen = reduce(DataFrame.unionByName, _walk(rows.filter(whole == "OBJECT"), schema, "$"), odd)
    return seen.distinct().groupBy("path", "kind", "status").agg(F.count(F.lit(1)).alias("n_docs"))
