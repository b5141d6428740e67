"""Log-and-re-raise wrapper for job entry points (batch side of the stream ``ErrorListener``)."""
from __future__ import annotations

import functools
import logging

log = logging.getLogger("tickvault")


def logged(name: str):
    """Decorator: log an exception with ``name`` (analysis errors apart), then re-raise it."""
    def deco(fn):
        @functools.wraps(fn)
        def wrapper(*args, **kwargs):
            try:
                return fn(*args, **kwargs)
            except Exception as e:
                from pyspark.errors import AnalysisException
                kind = "analysis error" if isinstance(e, AnalysisException) else "unexpected error"
                log.error("%s in %s: %s", kind, name, e)
                raise
        return wrapper
    return deco
