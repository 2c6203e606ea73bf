"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from .compare import change_predicate_text, row_changed
from .timefn import file_date, minus_days, minus_seconds, plus_days, run_stamp, stamp_text

__all__ = ["change_predicate_text", "row_changed", "file_date", "minus_days", "minus_seconds",
           "plus_days", "run_stamp", "stamp_text"]
