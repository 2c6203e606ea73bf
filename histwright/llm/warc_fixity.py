"""Fixity audit of WARC replicas with Merkle trees over byte-offset ranges.

A replica is a table of records ``(file, offset, length, digest)``: the offsets are the
catalogue's, the digests SHA-256 of the bytes the replica holds there. The leaf of a tree is
a range of ``leaf_bytes`` of a file and hashes its records in order of offset; each level above
hashes ``fanout`` neighbouring ranges, up to one root for each file. Ranges are cut by offset, so
no ranks are needed and every group is bounded by its bytes, however large a file is. The audit compares
roots and goes down one level at a time, only below nodes that differ, to the records.

Defined results: an empty replica makes every record of the other ``missing`` or ``extra``; two empty
ones give no rows; records with equal file and offset are hashed together in digest order; NULL digests
hash as empty; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FILE_BYTES, LEAF_BYTES, FANOUT = 4 << 20, 64 << 10, 16


def record_bytes(url: Column, html: Column) -> Column:
    """A WARC resource record as bytes; NULL parts count as empty."""
    body = F.coalesce(html, F.lit("")).cast("binary")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n")).cast("binary")
    return F.concat(head, body, F.lit("\r\n\r\n").cast("binary"))


def leaves(records: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """(file, node, hash) of each byte range that holds the start of a record."""
    row = F.struct("offset", F.coalesce("digest", F.lit("")).alias("digest"), "length")
    listed = F.transform(F.array_sort(F.collect_list(row)), lambda r: F.concat_ws(
        ":", r["offset"].cast("string"), r["length"].cast("string"), r["digest"]))
    return (records.groupBy("file", F.floor(F.col("offset") / leaf_bytes).alias("node"))
            .agg(F.sha2(F.array_join(listed, "|").cast("binary"), 256).alias("hash")))


def parents(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The level above: each node hashes its children's numbers and hashes in order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))),
                         lambda r: F.concat_ws(":", r["node"].cast("string"), r["hash"]))
    return (nodes.groupBy("file", F.floor(F.col("node") / fanout).alias("up"))
            .agg(F.sha2(F.array_join(listed, "|").cast("binary"), 256).alias("hash"))
            .withColumnRenamed("up", "node"))


def tree(records: DataFrame, leaf_bytes: int, fanout: int, depth: int) -> list[DataFrame]:
    """All levels, leaves first; with enough ``depth`` the last has one root for each file."""
    levels = [materialize(leaves(records, leaf_bytes), "merkle-leaves")]
    for _ in range(depth):
        levels.append(parents(levels[-1], fanout))
    return levels


def differing(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose value differs or that one side lacks."""
    x, y = a.select(*keys, F.col(value).alias("va")), b.select(*keys, F.col(value).alias("vb"))
    return x.join(y, keys, "full").where(~F.col("va").eqNullSafe(F.col("vb"))).select(*keys)


def audit(a: DataFrame, b: DataFrame, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """file, offset, length, digest, replica_digest, status of the records in which ``b`` differs from ``a``.

    status: ``changed`` (other bytes), ``missing`` (not in ``b``), ``extra`` (not in ``a``).
    """
    last = max((r[0] or 0) for r in (x.agg(F.max("offset")).first() for x in (a, b)))
    depth, span = 0, leaf_bytes
    while span <= last:
        depth, span = depth + 1, span * fanout
    left, right = (tree(x, leaf_bytes, fanout, depth) for x in (a, b))
    bad = differing(left[depth], right[depth], ["file", "node"], "hash")
    for level in range(depth - 1, -1, -1):
        up = materialize(bad.withColumnRenamed("node", "up"), f"merkle-bad{level + 1}")

        def below(nodes: DataFrame) -> DataFrame:
            return nodes.withColumn("up", F.floor(F.col("node") / fanout)).join(up, ["file", "up"], "left_semi")

        bad = differing(below(left[level]), below(right[level]), ["file", "node"], "hash")
    bad = materialize(bad, "merkle-bad0")

    def inside(records: DataFrame, digest: str) -> DataFrame:
        return (records.withColumn("node", F.floor(F.col("offset") / leaf_bytes))
                .join(bad, ["file", "node"], "left_semi")
                .select("file", "offset", "length", F.col("digest").alias(digest)))

    x, y = inside(a, "digest").alias("x"), inside(b, "replica_digest").alias("y")
    both = x.join(y.withColumnRenamed("length", "held"), ["file", "offset"], "full")
    gone, more = F.col("length").isNull(), F.col("held").isNull()
    return both.where(gone | more | ~F.col("digest").eqNullSafe(F.col("replica_digest"))
                      | (F.col("length") != F.col("held"))).select(
        "file", "offset", F.coalesce("length", "held").alias("length"), "digest", "replica_digest",
        F.when(more, "missing").when(gone, "extra").otherwise("changed").alias("status"))


def catalogue(records: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Deal records ``(page_id, copy, digest, length, ...)`` out to WARC files and give each its offset.

    Files are dealt by hash of id, copy number and digest, as many as the bytes
    need, so no id and no group of equal records fills one file. Inside a file records stand in
    order of id, digest and copy.
    """
    total = records.agg(F.sum("length")).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    key = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                      F.col("copy").cast("string"), "digest")
    number = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    order = (Window.partitionBy("file").orderBy("page_id", "digest", "copy")
             .rowsBetween(Window.unboundedPreceding, -1))
    return (records.withColumn("file", number % files)
            .withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0).cast("long"))))


def numbered_copies(records: DataFrame) -> DataFrame:
    """Equal records (all columns) as one row each with a ``copy`` number from 0.

    Counted by aggregation, so a page that a third of all rows repeat is one row in the shuffle.
    """
    return (records.groupBy(*records.columns).agg(F.count(F.lit(1)).alias("n"))
            .select(*records.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy")))
