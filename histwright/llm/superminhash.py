"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

A document's set holds the hashes of its distinct 5-word shingles (words ``[^\\x20\\x09-\\x0D]+``,
A-Z lower-cased; with fewer words the whole sequence is the one shingle). Documents
are linked when ``100 * |A & B| >= 75 * |A | B|``; a document's group is its connected component.

1. One scan computes each document's set size, set digest and SuperMinHash signature. Each
   element walks its own random permutation of the signature's places, level by
   level, and the walk stops once no place can still improve. Bands of ``ROWS`` places are
   hashed to bucket keys. Two sets at the threshold miss all ``BANDS`` bands with a chance of 2e-6.
2. Documents with equal sets collapse to their smallest id, so copies cost nothing more.
3. Every bucket links its members to its smallest one (a star, linear in the bucket).
   Star pairs are confirmed on full sets, and confirmed pairs grouped.
4. Members of buckets that still hold different groups are joined exactly: a set's elements are
   ordered from rare to frequent among these members, and two linked sets share an element
   in the first quarter of both, with enough elements after it on both sides. Elements of one
   group alone are left out. Of the others, first one member of each group is compared with one of the
   element's smallest group (linear), which joins the groups that belong together; then all such
   pairs of groups that are still apart are confirmed on full sets, so no link that the
   bands found is lost, and neither pairs inside a group nor all pairs of a bucket are made.

Sets travel only for documents that share a bucket. Hot keys: bucket minima are aggregated before
the shuffle, star and set joins are split by adaptive execution.

Defined results: a NULL, empty or blank text has the empty set, links with nothing and is kept;
``doc_id`` is the document: rows that repeat it count as one, linked through any of its
texts, and each row is returned; a row with a NULL ``doc_id`` links with nothing, has a
NULL ``component_id`` and is kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textnum as tn
from .common import materialize
from .components import components

SHINGLE, SHARE = 5, 75
BANDS, ROWS = 48, 5
#: Levels after which the few unfinished walks hold their permutation in full.
_SPARSE_LEVELS = 6

_G = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def shingle_sets(raw: np.ndarray, offs: np.ndarray, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a chunk."""
    w = tn.Words(raw, offs, tn.NOT_SPACE)
    h, _ = tn.grams(w, n)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(h[a:b - n + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for x in w.hash[a:b]:
                whole = tn.mix(np.atleast_1d(np.atleast_1d(whole) * _G + x))[0]
            out.append(np.array([whole]))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """SuperMinHash signatures, one row per set (of the empty set: all ones).

    At level j element e draws a fraction r and a place through step j of its Fisher-Yates
    shuffle; a place keeps the least ``j + r``, here ``j << 32 | r``. Values of level
    j are below all of later levels, so a set is done when all its places have one.
    """
    out = np.full((len(sets), places), np.uint64(0xFFFFFFFFFFFFFFFF))
    size = np.array([len(s) for s in sets])
    if not size.sum():
        return out
    flat = out.reshape(-1)
    h = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    drawn: list[np.ndarray] = []  # place index drawn at each level so far
    moved: list[np.ndarray] = []  # what the shuffle put there
    perm = None
    for j in range(places):
        if j:
            open_rows = (out == np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1)
            go = open_rows[row]
            if not go.any():
                break
            if not go.all():
                h, row = h[go], row[go]
                drawn, moved = [x[go] for x in drawn], [x[go] for x in moved]
                perm = perm[go] if perm is not None else None
        x = tn.mix(h + np.uint64((j + 1) * int(_G) & 0xFFFFFFFFFFFFFFFF))
        k = (j + (((x >> np.uint64(32)) * np.uint64(places - j)) >> np.uint64(32)).astype(np.int64))
        if perm is None and j >= _SPARSE_LEVELS:
            perm = np.tile(np.arange(places, dtype=np.int16), (len(h), 1))
            at = np.arange(len(h))
            for i in range(j):
                perm[at, drawn[i]] = moved[i]
        if perm is None:
            place, here = k.copy(), np.full(len(k), j)
            for d, m in zip(drawn, moved):
                np.copyto(place, m, where=d == k)
                np.copyto(here, m, where=d == j)
            drawn.append(k)
            moved.append(here)
        else:
            at = np.arange(len(h))
            place, here = perm[at, k].astype(np.int64), perm[:, j].copy()
            perm[at, k] = here
        np.minimum.at(flat, row * places + place, np.uint64(j) << np.uint64(32) | (x & _LOW))
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    s = sig[:, :bands * rows].reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _G, (len(sig), bands)).copy()
    for i in range(rows):
        key = tn.mix(key * np.uint64(0xD6E8FEB86659FD93) + s[:, :, i])
    return key.view(np.int64)


def document_signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, digest of the set, bucket keys (empty sets: no digest, no key)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs):
                sets = shingle_sets(r, o)
                keys = band_keys(signatures(sets, bands * rows), bands, rows)
                full = [len(s) > 0 for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if f else None
                              for s, f in zip(sets, full)], pa.binary()),
                    pa.array([k if f else None for k, f in zip(keys, full)], pa.list_(pa.int64())),
                ], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, keys array<long>")


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id and its set as sorted little-endian 64-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i).cast(pa.int64()),
                    pa.array([s.astype("<u8").tobytes() for s in shingle_sets(r, o)], pa.binary()),
                ], ["doc_id", "set"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, set binary")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v, common, total (sizes of intersection and union) of pairs of ids, on full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, total = [], []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in (a, b))
                n = len(x) + len(y) - len(np.union1d(x, y))
                common.append(n)
                total.append(len(x) + len(y) - n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(common, pa.int64()),
                 pa.array(total, pa.int64())], ["u", "v", "common", "total"])

    a = sets.select(F.col("doc_id").alias("u"), F.col("set").alias("set_u"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("set").alias("set_v"))
    return (pairs.join(a, "u").join(b, "v").select("u", "v", "set_u", "set_v")
            .mapInArrow(run, "u long, v long, common long, total long"))


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs(doc_id, text)``."""
    sig = materialize(document_signatures(docs, bands, rows), "smh-signatures")
    known = sig.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = materialize(known.select("doc_id", "digest").join(classes, "digest")
                         .select("doc_id", "rep").distinct(), "smh-members")
    reps = member.select(F.col("rep").alias("doc_id")).distinct()

    # Buckets: (key, smallest member) of keys that more than one set has.
    entries = (known.select("doc_id", "n_shingles", "keys").join(reps, "doc_id", "left_semi")
               .select(F.col("doc_id").alias("u"), F.col("n_shingles").alias("n"),
                       F.explode("keys").alias("key")))
    shared = (entries.groupBy("key").agg(F.min("u").alias("p"), F.max("u").alias("last"))
              .where("p < last").select("key", "p"))
    buckets = materialize(entries.join(shared, "key"), "smh-buckets")

    need = buckets.select(F.col("u").alias("doc_id")).distinct()
    sets = materialize(document_sets(docs.select("doc_id", "text").join(need, "doc_id", "left_semi")),
                       "smh-sets")
    star = materialize(overlaps(buckets.where("u <> p").select("u", F.col("p").alias("v")).distinct(), sets),
                       "smh-star")
    linked = F.col("common") * 100 >= F.col("total") * SHARE
    # Several sets under one id: the id ties their groups together.
    tied = member.where("doc_id <> rep").join(
        member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
        .where("a < b").select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    found = star.where(linked).select("u", "v").unionByName(tied)
    groups = components(found)

    # First one pair for each element and group, so groups that belong together are one before members are paired.
    prefix = prefixes(buckets, groups, sets)
    for pairs in (root_stars, open_pairs):
        more = materialize(overlaps(pairs(prefix), sets).where(linked).select("u", "v"), "smh-more")
        if more.take(1):
            found = found.unionByName(more)
            groups = components(found)
            prefix = (prefix.drop("root").join(groups.select(F.col("node").alias("u"), "root"), "u", "left")
                      .withColumn("root", F.coalesce("root", "u")))

    by_doc = (member.groupBy("doc_id").agg(F.min("rep").alias("node"))
              .join(groups, "node", "left")
              .select("doc_id", F.coalesce("root", "node").alias("root")))
    return (sig.select("doc_id", "n_shingles").join(by_doc, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))


def set_elements(sets: DataFrame) -> DataFrame:
    """One row per element: u, root, n (size), sid (which set of u), e."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                x = [np.frombuffer(v.as_buffer(), "<i8") for v in part.column(2)]
                n = np.array([len(v) for v in x])
                u, root, sid = (np.repeat(part.column(c).to_numpy(), n) for c in (0, 1, 3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.int64()) for v in (u, root, np.repeat(n, n), sid, np.concatenate(x))],
                    ["u", "root", "n", "sid", "e"])

    return sets.select("u", "root", "set", F.xxhash64("set").alias("sid")).mapInArrow(
        run, "u long, root long, n long, sid long, e long")


def prefixes(buckets: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """u, root, n, e, at: the first elements (rare ones first) of the members of buckets with several groups.

    With elements in one global order, a linked pair's first common element stands in both members' first quarter.
    """
    held = (buckets.select("key", "u").join(groups.select(F.col("node").alias("u"), "root"), "u", "left")
            .withColumn("root", F.coalesce("root", "u")))
    mixed = (held.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"))
             .where("a < b").select("key"))
    members = held.join(mixed, "key", "left_semi").select("u", "root").distinct()
    el = materialize(set_elements(sets.withColumnRenamed("doc_id", "u").join(members, "u")), "smh-elements")
    common = el.groupBy("e").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    one = Window.partitionBy("u", "sid")
    # Elements of no other member come first; only their number matters.
    place = F.col("n") - F.count(F.lit(1)).over(one) + F.row_number().over(one.orderBy("df", "e")) - 1
    return materialize(el.join(common, "e").withColumn("at", place)
                       .where(F.col("at") * 100 <= F.col("n") * (100 - SHARE))
                       .select("u", "root", "n", "e", "at"), "smh-prefix")


def apart(prefix: DataFrame) -> DataFrame:
    """The rows whose element members of several groups have. An element of one group alone, however
    large that is, links nothing that isn't linked already."""
    several = (prefix.groupBy("e").agg(F.min("root").alias("least"), F.max("root").alias("most"))
               .where("least < most").select("e"))
    return prefix.join(several, "e", "left_semi")


def _may_link() -> Column:
    """Of rows a and b of one element: at most ``min(n_a - at_a, n_b - at_b)`` elements are common."""
    most = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    return most * 100 >= (F.col("a.n") + F.col("b.n") - most) * SHARE


def root_stars(prefix: DataFrame) -> DataFrame:
    """(u, v): of every element, one member of each group and one of its smallest group; linear in (element, group)."""
    rest = F.struct("u", "n", "at")
    one = apart(prefix).groupBy("e", "root").agg(F.min(rest).alias("x"))
    hub = one.groupBy("e").agg(F.min(F.struct("root", "x")).alias("h"))
    a = one.select("e", "root", "x.*").alias("a")
    b = hub.select("e", F.col("h.root").alias("root"), "h.x.*").alias("b")
    return (a.join(b, (F.col("a.e") == F.col("b.e")) & (F.col("a.root") > F.col("b.root")) & _may_link())
            .select(F.col("a.u").alias("u"), F.col("b.u").alias("v")).distinct())


def open_pairs(prefix: DataFrame) -> DataFrame:
    """(u, v) of different groups that can be linked: prefix and positional filters of exact set joins."""
    left = apart(prefix)
    a, b = left.alias("a"), left.alias("b")
    return (a.join(b, (F.col("a.e") == F.col("b.e")) & (F.col("a.root") < F.col("b.root")) & _may_link())
            .select(F.col("a.u").alias("u"), F.col("b.u").alias("v")).distinct())
