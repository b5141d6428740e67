"""Column-expression helpers. All return built-in Spark ``Column`` expressions (JVM side, codegen)."""
from tickvault.functions.nulls import default, falsy_default, first_non_empty, fill_strings  # noqa: F401
from tickvault.functions.times import (parse_iso, iso_from_epoch, to_text, ts_date, ts_hour,  # noqa: F401
                                       days_before, strip_iso)
from tickvault.functions.nested import quote_field, present  # noqa: F401
