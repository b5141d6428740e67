"""Nested lookups and JSON."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_field(quotes, field: str, currency: str = "USD") -> Column:
    """M1: ``quotes[currency][field]``; a missing currency or field gives NULL."""
    return F.try_element_at(_col(quotes), F.lit(currency)).getField(field)


def present(c) -> Column:
    """B3: "attribute present" flag."""
    return _col(c).isNotNull()


def keywords(*cols) -> Column:
    """List literal of keyword columns -> array (explode it to get one row per keyword)."""
    return F.array(*[_col(c) for c in cols])


def field_of_each(arr, field: str) -> Column:
    """R2: map over an array of structs, keep one field (``hashtags[].text``)."""
    return F.transform(_col(arr), lambda x: x.getField(field))


def decode(c, schema) -> Column:
    """B1: JSON text -> struct / array (PERMISSIVE: bad text gives NULL)."""
    return F.from_json(_col(c), schema)


def encode(c) -> Column:
    """B2: struct / array -> JSON text."""
    return F.to_json(_col(c))
