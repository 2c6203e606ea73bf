"""Small tables with every awkward case: NULLs, empty and long texts, repeats, ties, clashing columns."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
BASE = " ".join(f"base{i}" for i in range(60))
#: Columns that operators use inside; a table may have them already.
CLASH = ("score", "hits", "keys", "hash", "root", "copy", "part", "target", "n", "drop", "line", "pos", "third",
         "prefix", "kept", "digest", "key", "u", "v", "file", "drop_id", "all_lines", "row_key", "asked")


def rows():
    return [
        (1, BASE, "en", "a", len(BASE)), (1, BASE, "en", "a", len(BASE)),          # a repeated row
        (2, BASE, None, "b", None),                                                  # an exact copy
        (3, BASE.replace("base30", "other"), "en", None, 0),                         # a near copy
        (4, None, "en", "a", None), (5, "", "en", "b", 0), (6, " \n\t ", "en", "c", 4),
        (7, "one", "en", "a", 3), (8, "one", "en", "b", 3),
        (9, LONG, "en", "a", len(LONG)), (None, "no id at all here", "en", "a", 17),
        (None, None, None, None, None), (12, "Ünï cödé 漢字 \U0001f600 text", "de", "c", 20),
    ]


def table(spark, clash=True):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)]) if clash else df


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
