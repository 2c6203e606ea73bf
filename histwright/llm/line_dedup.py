"""Removal of boilerplate lines by the number of distinct sites that carry them.

A line (trimmed of spaces, tabs and carriage returns; blank lines never count) is boilerplate when
at least ``min_sites`` distinct values of ``source`` carry it. Its spread is a
HyperLogLog sketch of the sites for each line hash; sketches are built in the map tasks and
merged by the shuffle, so a line that a third of all documents carry moves one sketch for each
task. Lines whose estimate is within ``band`` of the threshold get an exact distinct
count; only these lines' sites are shuffled for it.

Boilerplate lines go whatever share of a document they make. Only a document all of whose non-blank lines are
boilerplate is left whole: it has no line of its own, so it is a copy for the near-duplicate operator rather
than a page around its boilerplate.

Line hashes are two independent 64-bit hashes, so at 10**12 distinct lines none is
expected to be taken for another.

Defined results: NULL and empty texts stay as they are; a NULL ``source`` is no site; repeated rows
are cleaned alike; an empty table gives no rows; further columns are passed on, whatever
their names (those that the operator adds are ``n_lines``, ``n_removed`` and ``left_whole``, and win).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SITES = 10
LG_K = 12


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def document_lines(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, source, pos, h1, h2 of every line that is not blank."""
    text = F.coalesce("text", F.lit(""))
    bare = F.btrim("line", F.lit(" \t\r"))
    return (docs.select("doc_id", F.xxhash64(text).alias("row_key"), "source",
                        F.posexplode(_lines(text)).alias("pos", "line"))
            .where(bare != "")
            .select("doc_id", "row_key", "source", "pos",
                    F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit(1), bare).alias("h2")))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2) of the lines on at least ``min_sites`` distinct sites."""
    # Five standard errors of the sketch, and at least one site.
    band = max(1.0, 5 * 1.04 / (1 << lg_k) ** 0.5 * min_sites)
    spread = (lines.where("source is not null").groupBy("h1", "h2")
              .agg(F.hll_sketch_estimate(F.hll_sketch_agg("source", F.lit(lg_k))).alias("sites"))
              .where(F.col("sites") >= min_sites - band))
    near = spread.where(F.col("sites") <= min_sites + band).select("h1", "h2")
    exact = (lines.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2")
             .agg(F.countDistinct("source").alias("sites")).where(F.col("sites") >= min_sites))
    return spread.where(F.col("sites") > min_sites + band).select("h1", "h2").unionByName(
        exact.select("h1", "h2"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and n_lines, n_removed, left_whole."""
    lines = document_lines(docs.select("doc_id", "source", "text"))
    drop = (lines.join(boilerplate(lines, min_sites, lg_k), ["h1", "h2"], "left_semi")
            .groupBy("doc_id", "row_key")
            .agg(F.collect_set("pos").alias("drop"))  # a set, as repeated rows give their lines more than once
            .select(F.col("doc_id").alias("drop_id"), F.col("row_key").alias("drop_key"), "drop"))
    added = ("n_lines", "n_removed", "left_whole")
    kept = [c for c in docs.columns if c not in added]
    # The row travels as one struct, so its columns can have any names.
    own = docs.select(F.struct(*kept).alias("r"))
    text = F.coalesce("r.text", F.lit(""))
    own = own.select("r", F.xxhash64(text).alias("key"), _lines(text).alias("all_lines"))
    same = F.col("r.doc_id").eqNullSafe(F.col("drop_id")) & (F.col("key") == F.col("drop_key"))
    own_lines = F.filter("all_lines", lambda x: F.btrim(x, F.lit(" \t\r")) != "")
    whole = F.coalesce(F.size("drop") == F.size(own_lines), F.lit(False))
    removed = F.when(F.col("left_whole") | F.col("drop").isNull(), F.lit(0)).otherwise(F.size("drop"))
    rest = F.array_join(F.filter("all_lines", lambda _, i: ~F.array_contains("drop", i)), "\n")
    done = (own.join(drop, same, "left").withColumn("left_whole", whole)
            .withColumn("n_removed", removed.cast("long")))
    cleaned = F.when(F.col("n_removed") > 0, rest).otherwise(F.col("r.text"))
    return done.select(*[cleaned.alias(c) if c == "text" else F.col(f"r.{c}").alias(c) for c in kept],
                       F.size("all_lines").cast("long").alias("n_lines"), "n_removed", "left_whole")
