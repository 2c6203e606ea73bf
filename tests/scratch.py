"""Helpers of the tests: fresh local scratch folders, rows for exact comparisons."""

import os
import tempfile


def scratch_dir(prefix: str = "histwright-") -> str:
    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("TMPDIR", "/tmp"))


def rows(df, cols=None):
    """Sorted tuples of ``df`` (timestamps as text) for exact comparisons."""
    from pyspark.sql import functions as F
    cols = cols or df.columns
    out = df.select(*[F.col(c).cast("string") if str(df.schema[c].dataType).startswith("Timestamp")
                      else F.col(c) for c in cols])
    return sorted((tuple(r) for r in out.collect()), key=repr)
