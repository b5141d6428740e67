"""Joins (J1, J2, J4, J5). Strategy is left to Catalyst + AQE; the sides are pre-reduced where
that shrinks the shuffle (distinct ids before an anti join)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickvault.operators.selection import difference


def latest_docs(docs: DataFrame, key: str = "id", version: str | None = "landed_at") -> DataFrame:
    """One document per key: the newest fetch (by ``version`` when present, then the whole row,
    so the choice is deterministic). Decomposable, so many copies of one coin stay cheap."""
    from tickvault.operators.topn import latest_per_key
    order = [version] if version and version in docs.columns else []
    out = latest_per_key(docs, [key], order)
    return out.select(*docs.columns).drop(*order)


def merge_right_wins(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """``{**left, **right}`` per key: every shared field comes from ``right``, even when NULL.

    A key missing on either side drops the pair (the source skipped a coin whose fetch failed).
    """
    keys = [key] if isinstance(key, str) else list(key)
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    return left.drop(*shared).join(right, keys, "inner")


def missing_ids(active: DataFrame, existing: DataFrame, key: str = "coin_id", method: str = "anti") -> DataFrame:
    """Ids of ``active`` with no row in ``existing``.

    ``existing`` is usually the whole price history: it is reduced to its distinct non-null ids
    first (partial aggregation on every map task), so the shuffle carries ids, not rows.
    ``method='except'`` is the set form; it differs from the anti join only on NULL ids.
    """
    ids = active.select(key).filter(F.col(key).isNotNull()).distinct()
    seen = existing.select(key).filter(F.col(key).isNotNull()).distinct()
    if method == "except":
        return difference(ids, seen)
    return ids.join(seen, key, "left_anti")


def lookup(hits: DataFrame, records: DataFrame, key: str | list[str]) -> DataFrame:
    """Found ids -> full records."""
    return hits.join(records, key, "inner")


def with_prices(active: DataFrame, ticks: DataFrame, key: str = "coin_id") -> DataFrame:
    """The per-coin fetch loop as one equi-join of the monitored coins with their ticks."""
    return active.join(ticks, key, "inner")
