"""SimHash fingerprints and Hamming search, in DataFrame operations only.

A term is a word; its weight is its length in bytes, at most ``MAX_WEIGHT``, times how often it
occurs. Each term's 128-bit hash votes with its weight for or against every bit; the sign of the sum
is the bit. The votes of two bits share one 64-bit sum (32 bits each), so 64 sums hold all votes
and aggregate inside one partition, as all terms of a row are made there.

Search: the bits are cut into ``blocks``. Two fingerprints within ``radius`` bits differ in more than ``flips``
bits in at most ``radius // (flips + 1)`` blocks, so all the others are equal up to ``flips`` bits. There is
one table for each choice of so many blocks, keyed by them. A fingerprint stands in each table once; a
query looks up its own key and, with ``flips``, those that differ from it in up to so many bits.
Whatever is met is verified on the whole fingerprint, and a pair is taken from the first table that
can find it. Equal fingerprints are one entry with a count.

Radius 11 over four blocks of 32 bits and two flips asks 4 * 529 keys for each query. Of edited copies that keep a
five-word shingle similarity of 0.75 it finds over 0.9 (``test_search_finds_edited_copies``); texts of other
content lie further apart than that.

Defined results: a NULL or empty text has one term of weight 0 and fingerprint zero; equal texts
have equal fingerprints whatever the row; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BITS = 128
MAX_WEIGHT = 16
RADIUS, BLOCKS, FLIPS = 11, 4, 2
_LANES = 0x0000000100000001
_HALF = BITS // 64


def terms(text: Column) -> Column:
    """Array of the text's words."""
    return F.split(text, r"\s+")


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` with f0, f1 (the fingerprint's two longs). ``keys`` must identify a row.

    Keeps the partitioning of ``rows`` where that is by one of the keys; no shuffle then.
    """
    t = rows.select(*keys, F.explode(terms(F.col(text))).alias("t")).select(
        *keys, F.least(F.octet_length("t"), F.lit(MAX_WEIGHT)).cast("long").alias("w"),
        *[F.xxhash64(F.lit(i), F.col("t")).alias(f"h{i}") for i in range(_HALF)])
    votes = [F.sum(F.shiftrightunsigned(f"h{i}", k).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"v{i}_{k}")
             for i in range(_HALF) for k in range(32)]
    summed = t.groupBy(*keys).agg(F.sum("w").alias("w"), *votes)

    def word(i: int) -> Column:
        sums = F.array(*[F.col(f"v{i}_{k}") for k in range(32)])
        bits = F.transform(sums, lambda v, k: F.call_function("shiftleft", F.call_function("shiftleft", (
            F.shiftrightunsigned(v, 32) * 2 > F.col("w")).cast("long"), F.lit(32)).bitwiseOR(
            (v.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("w")).cast("long")), k))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return summed.select(*keys, *[word(i).alias(f"f{i}") for i in range(_HALF)])


def hamming(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)])


def likeness(a: list[Column], b: list[Column]) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - hamming(a, b) / F.lit(float(BITS))


def as_text(words: list[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(w), 16, "0") for w in words]))


def _masks(width: int, flips: int) -> list[int]:
    """All values of ``width`` bits with at most ``flips`` ones."""
    return [sum(1 << i for i in at) for n in range(flips + 1) for at in combinations(range(width), n)]


def near_counts(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                flips: int = FLIPS) -> DataFrame:
    """For each distinct fingerprint of ``queries(f0, f1)``: how many rows of ``prints`` are within ``radius``.

    All of them are found. ``blocks`` divides the bits into pieces of at most 64 bits; ``flips`` above 0 takes
    pieces of at most 32 bits and keys of one piece.
    """
    alike = blocks - radius // (flips + 1)
    if BITS % blocks or 64 % (BITS // blocks) or alike < 1:
        raise ValueError("blocks must cut 64-bit words evenly and be more than radius // (flips + 1)")
    width = BITS // blocks
    per_word = 64 // width
    if flips and (alike > 1 or width > 32):
        raise ValueError("flips take keys of one block of at most 32 bits")

    def piece(side: str, i: int) -> Column:
        w = F.shiftrightunsigned(f"{side}{i // per_word}", width * (i % per_word))
        return w if width == 64 else w.bitwiseAND(F.lit((1 << width) - 1))

    tables = list(combinations(range(blocks), alike))

    def keyed(df: DataFrame, side: str) -> DataFrame:
        """A row for each table: its number and the key, one block itself or the hash of several."""
        def key(t: tuple[int, ...]) -> Column:
            return piece(side, t[0]) if alike == 1 else F.xxhash64(*[piece(side, i) for i in t])
        return df.select("*", F.inline(F.array(*[F.struct(F.lit(n).alias("table"), key(t).alias("key"))
                                                 for n, t in enumerate(tables)])))

    # Neither the planner nor adaptive execution knows how many keys a query becomes: a number of partitions is set,
    # so that the few query rows are not put into one, and the join never broadcasts them.
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q = keyed(queries.select(F.col("f0").alias("q0"), F.col("f1").alias("q1"))
              .repartition(tasks, "q0", "q1").distinct(), "q")
    if flips:
        masks = F.expr("array(" + ", ".join(f"{m}L" for m in _masks(width, flips)) + ")")
        q = q.select("q0", "q1", "table", "key", F.explode(masks).alias("mask")).select(
            "q0", "q1", "table", F.col("key").bitwiseXOR(F.col("mask")).alias("key"))
    p = keyed(prints.groupBy("f0", "f1").agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("f0").alias("p0"), F.col("f1").alias("p1"), "n"), "p")

    def close(i: int) -> Column:
        x, y = piece("q", i), piece("p", i)
        return F.bit_count(x.bitwiseXOR(y)) <= flips if flips else x == y

    met = [reduce(lambda a, b: a & b, [close(i) for i in t]) for t in tables]
    first = F.lit(False)
    for n, m in enumerate(met):
        earlier = reduce(lambda a, b: a | b, met[:n], F.lit(False))
        first = first | ((F.col("table") == n) & m & ~earlier)
    pair = hamming([F.col("q0"), F.col("q1")], [F.col("p0"), F.col("p1")])
    return (q.join(p.hint("merge"), ["table", "key"]).where(first & (pair <= radius))
            .groupBy(F.col("q0").alias("f0"), F.col("q1").alias("f1")).agg(F.sum("n").alias("n_within")))


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id): the next smaller id; the smallest one's next is the largest.

    Ids are range-partitioned; neighbours are found inside each partition, and only
    each partition's least and greatest id are put in one order.
    """
    placed = materialize(ids.select("doc_id").where("doc_id is not null").distinct()
                         .repartitionByRange("doc_id").select("doc_id", F.spark_partition_id().alias("part")),
                         "simhash-ids")
    edges = placed.groupBy("part").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    order = Window.orderBy("part")
    before = edges.select(F.col("least").alias("doc_id"), F.coalesce(
        F.lag("most").over(order), F.max("most").over(order.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("crossing"))
    inside = placed.select("doc_id", F.lag("doc_id").over(
        Window.partitionBy("part").orderBy("doc_id")).alias("prior"))
    return (inside.join(before, "doc_id", "left")
            .select("doc_id", F.coalesce("prior", "crossing").alias("next_id")))


def edited_prints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, next_id, f0, f1, e0, e1, g0, g1: a row for each document.

    f: fingerprint of the text, e: of the edited text (its last third replaced by as many
    first code points of the next document in descending id), g: of the next document.
    A row with a NULL id has no next document: it loses its last third, and its next counts as
    empty. Where several rows have the next id, the least prefix and fingerprint count.
    """
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = whole.where("doc_id is not null")
    third = F.floor(F.length("text") / 3).cast("int")
    follows = materialize(next_ids(whole), "simhash-next")
    wanted = (known.groupBy("doc_id").agg(F.max(third).alias("k")).join(follows, "doc_id")
              .select(F.col("doc_id").alias("owner"), F.col("next_id").alias("doc_id"), "k"))
    prefix = (known.join(wanted, "doc_id").select("owner", F.expr("left(text, k)").alias("prefix"))
              .groupBy(F.col("owner").alias("doc_id")).agg(F.min("prefix").alias("prefix")))
    edited = F.concat(F.expr("left(text, n_chars - third)"), F.expr("left(prefix, third)"))

    def pairs(df: DataFrame) -> DataFrame:
        copy = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
        return (df.select("doc_id", "text", "prefix", copy.alias("copy"),
                          F.length("text").cast("long").alias("n_chars"), third.alias("third"))
                .select("doc_id", "copy", "n_chars", "text", edited.alias("edited"))
                .select("doc_id", "copy", "n_chars", F.inline(F.array(
                    F.struct(F.lit("").alias("sha"), F.col("text").alias("text")),
                    F.struct(F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
                             F.col("edited").alias("text"))))))

    keys = ["doc_id", "copy", "n_chars", "sha"]
    prints = fingerprints(pairs(known.join(prefix, "doc_id")), keys)
    unknown = whole.where("doc_id is null")
    lost = fingerprints(pairs(unknown.withColumn("prefix", F.lit(""))), keys)
    own = F.col("sha") == ""
    per_row = materialize(
        prints.unionByName(lost).groupBy("doc_id", "copy", "n_chars")
        .agg(F.max("sha").alias("edited_sha256"),
             *[F.max(F.when(own, F.col(f"f{i}"))).alias(f"f{i}") for i in range(_HALF)],
             *[F.max(F.when(~own, F.col(f"f{i}"))).alias(f"e{i}") for i in range(_HALF)]),
        "simhash-prints")
    least = (per_row.where("doc_id is not null").groupBy(F.col("doc_id").alias("next_id"))
             .agg(F.min(F.struct("f0", "f1")).alias("g")))
    after = follows.join(least, "next_id").select("doc_id", "next_id", "g.f0", "g.f1")
    zero = F.lit(0).cast("long")
    return per_row.join(after.toDF("doc_id", "next_id", "g0", "g1"), "doc_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", "next_id", "f0", "f1", "e0", "e1",
        F.coalesce("g0", zero).alias("g0"), F.coalesce("g1", zero).alias("g1"))
