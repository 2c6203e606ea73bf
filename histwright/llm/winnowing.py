"""Benchmark decontamination by winnowing.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A shared span
counts when it holds ``span`` (10) consecutive words of a benchmark item, or the
whole item when that is shorter. All k-grams of k words are hashed, and of every w
consecutive k-grams the one of least hash (the first of equals) is kept, with
``k + w - 1 = span``. Which one is kept depends on those ``span`` words alone, so
equal spans keep the same k-gram: every shared span is found. Kept k-grams of both
sides are joined on hash and words, and each hit is extended word by word
to both sides, which gives the exact covered words. Items shorter than ``span``
have no full window: the hash of the whole item is looked up at every word.

Documents never shuffle their text: a kept k-gram travels with the at most
``span - k`` words to each side that can decide about it. Kept k-grams that
cannot match are dropped by a bitmap of fixed size (``FILTER_BITS``) before they
leave the scan; the join stays exact whatever the bitmap lets through. The
benchmark's k-grams are broadcast only when there are at most ``BROADCAST_ROWS``
of them; larger ones are shuffled and skewed keys split by adaptive execution.

Defined results: NULL or empty texts have no words and are clean; an item
without words, or a NULL item text, matches nothing; an item with a NULL id covers words but is
not listed; repeated benchmark rows count once; repeated document rows each get
their row; an empty benchmark leaves all documents clean; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textnum as tn
from .common import materialize

SPAN, K = 10, 6
FILTER_BITS = 22
BROADCAST_ROWS = 100_000

#: kind: words of a kept k-gram, or minus the words of a whole short item.
HIT = "struct<pos:int,hash:long,kind:int,gram:string,left:array<string>,right:array<string>>"
_HIT = pa.struct([("pos", pa.int32()), ("hash", pa.int64()), ("kind", pa.int32()), ("gram", pa.string()),
                  ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])


def kept_grams(w: tn.Words, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the k-grams that winnowing keeps in a chunk."""
    h, _ = tn.grams(w, k)
    m = len(w) - span + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    best, at = h[:m].copy(), np.zeros(m, np.int64)
    for i in range(1, span - k + 1):
        less = h[i:i + m] < best
        best[less] = h[i:i + m][less]
        at[less] = i
    whole = np.repeat(w.first[1:], w.counts())[:m] >= np.arange(m) + span
    keep = np.zeros(len(h), bool)
    keep[(np.arange(m) + at)[whole]] = True
    pos = np.flatnonzero(keep)
    return pos, h[pos]


def _hit(w: tn.Words, d: int, p: int, kind: int, h: np.uint64, reach: int) -> dict:
    n = abs(kind)
    a, b = int(w.first[d]), int(w.first[d + 1])
    return {"pos": p - a, "hash": int(h.astype(np.int64)), "kind": kind, "gram": " ".join(w.text(p, p + n)),
            "left": w.text(max(a, p - reach), p)[::-1], "right": w.text(p + n, min(b, p + n + reach))}


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def item_grams(items: DataFrame, span: int, k: int) -> DataFrame:
    """(item_id, hit) of the benchmark: kept k-grams, or the whole short item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs):
                w = tn.Words(r, o, tn.ALNUM)
                count, doc = w.counts(), w.doc()
                rows, hits = [], []
                pos, hs = kept_grams(w, span, k)
                for p, h in zip(pos.tolist(), hs):
                    rows.append(i + int(doc[p]))
                    hits.append(_hit(w, int(doc[p]), p, k, h, span - k))
                for n in sorted(set(count[(count > 0) & (count < span)].tolist())):
                    hs, _ = tn.grams(w, n)
                    for d in np.flatnonzero(count == n).tolist():
                        p = int(w.first[d])
                        rows.append(i + d)
                        hits.append(_hit(w, d, p, -n, hs[p], 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(hits, _HIT)], ["item_id", "hit"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id long, hit {HIT}").select("item_id", "hit.*")


def row_key(text: Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def document_hits(docs: DataFrame, bitmap, lengths: list[int], span: int, k: int) -> DataFrame:
    """(doc_id, row_key, n_words, hits) of every document; hits that the bitmap lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {n: np.unpackbits(np.frombuffer(b, np.uint8)).view(bool) for n, b in bitmap.value.items()}
        for batch in batches:
            raw, offs = tn.utf8(batch.column(2))
            for i, j, r, o in tn.chunks(raw, offs):
                w = tn.Words(r, o, tn.ALNUM)
                doc = w.doc()
                hits: list[list[dict]] = [[] for _ in range(j - i)]
                if k in bits:
                    pos, hs = kept_grams(w, span, k)
                    ok = bits[k][_bit(hs)]
                    for p, h in zip(pos[ok].tolist(), hs[ok]):
                        hits[doc[p]].append(_hit(w, int(doc[p]), p, k, h, span - k))
                for n in lengths:
                    hs, whole = tn.grams(w, n)
                    for p in np.flatnonzero(whole & bits[-n][_bit(hs)]).tolist():
                        hits[doc[p]].append(_hit(w, int(doc[p]), p, -n, hs[p], 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array(w.counts(), pa.int64()), pa.array(hits, pa.list_(_HIT))],
                    ["doc_id", "row_key", "n_words", "hits"])

    return (docs.select("doc_id", row_key(F.col("text")).alias("row_key"), "text")
            .mapInArrow(run, f"doc_id long, row_key long, n_words long, hits array<{HIT}>"))


def _equal_run(mine: str, theirs: str, reach: int) -> Column:
    """How many leading words of two word lists are equal."""
    run, total = F.lit(True), F.lit(0)
    for i in range(reach):
        run = run & F.coalesce(F.get(mine, F.lit(i)) == F.get(theirs, F.lit(i)), F.lit(False))
        total = total + run.cast("int")
    return total


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, item_ids (sorted as text), contaminated: one row per document."""
    spark = docs.sparkSession
    grams = materialize(item_grams(benchmark, span, k).distinct(), "winnow-items")
    bits = (grams.select("kind", F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("bit"))
            .distinct().toArrow())
    packed, kinds = {}, bits.column("kind").to_numpy()
    for kind in set(kinds.tolist()):  # each at most 2**FILTER_BITS bits, whatever the benchmark's size
        on = np.zeros(1 << FILTER_BITS, bool)
        on[bits.column("bit").to_numpy()[kinds == kind]] = True
        packed[kind] = np.packbits(on).tobytes()
    lengths = sorted(-x for x in packed if x < 0)
    per_doc = materialize(document_hits(docs, spark.sparkContext.broadcast(packed), lengths, span, k),
                          "winnow-docs")

    theirs = grams.select("item_id", "kind", "hash", "gram", F.col("left").alias("item_left"),
                          F.col("right").alias("item_right"))
    if grams.count() <= broadcast_rows:
        theirs = F.broadcast(theirs)
    n = F.abs("kind")
    spans = (per_doc.where(F.size("hits") > 0).select("doc_id", "row_key", F.inline("hits"))
             .join(theirs, ["kind", "hash", "gram"])
             .withColumn("before", _equal_run("left", "item_left", span - k))
             .withColumn("after", _equal_run("right", "item_right", span - k))
             .where((F.col("kind") < 0) | (n + F.col("before") + F.col("after") >= span))
             .select("doc_id", "row_key", "item_id", (F.col("pos") - F.col("before")).alias("a"),
                     (F.col("pos") + n + F.col("after")).alias("b"))
             .distinct())
    found = per_span_union(spans)
    d, f = per_doc.drop("hits").alias("d"), found.alias("f")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.row_key") == F.col("f.row_key"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return d.join(f, same, "left").select(
        "d.doc_id", "d.row_key", "n_words", hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (hit > 0).alias("contaminated"))


def per_span_union(spans: DataFrame) -> DataFrame:
    """Words covered by the union of each document's spans, and its items sorted as text."""
    earlier = (Window.partitionBy("doc_id", "row_key").orderBy("a", "b")
               .rowsBetween(Window.unboundedPreceding, -1))
    once = spans.groupBy("doc_id", "row_key", "a", "b").agg(F.collect_set("item_id").alias("items"))
    return (once.withColumn("covered_to", F.coalesce(F.max("b").over(earlier), F.lit(0)))
            .withColumn("new", F.greatest(F.lit(0), F.col("b") - F.greatest("a", "covered_to")))
            .groupBy("doc_id", "row_key")
            .agg(F.sum("new").cast("long").alias("n_hit"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))).cast("array<string>"))
                 .alias("item_ids")))
