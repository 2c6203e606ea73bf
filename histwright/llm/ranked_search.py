"""Ranked lexical search: term-at-a-time over short lists, then document-at-a-time over long ones.

Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. With ``n`` terms in a
document, ``tf`` of them the term's, ``m = 100 - B + (B * n * N) div L`` and
``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))``, a term adds ``w * ((10**9 * tf) div (1000 * tf + 12 * m))``.

Each task turns its documents into segments, one row each: the terms that occur in
queries, and for each its documents (by number in the segment) and frequencies, so no text and
no posting is ever shuffled. N, L and each term's df are sums over all segments. The queries then go to
the segments in blocks of ``QUERY_BYTES``, each with its terms' weights. In a segment a query is evaluated in two steps:

* *Term at a time*: lists of at most ``short`` documents are added up into accumulators, which
  from then on count as one list whose bound is its highest sum in each range of documents.
* *Document at a time*: ranges of ``RANGE_DOCS`` documents are taken in order. A range whose bound
  (accumulators' and long lists' highest scores in it) is below the lowest score kept is skipped. In the others,
  long lists are read by falling bound; documents that the lists not yet read can't lift to the
  lowest score kept are left, so each next list is looked up at fewer documents.

Bounds are exact integers and only what is strictly below is left out, so results equal the full sum, ties
included. A task keeps the ``k`` best of each query over its segments; the best of those are taken at the end.

Defined results: NULL texts have no terms; a query without terms, or whose terms no document holds, gives no
rows; equal scores go by doc_id (NULL last); repeated document rows each rank; repeated queries
(same id and text) count once, different texts of one id are ranked apart; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textnum as tn
from . import units
from .common import materialize

K = 20
#: Documents and postings of a segment (or of one document), documents of a range, documents of a short list.
SEGMENT_DOCS, SEGMENT_ENTRIES, RANGE_DOCS, SHORT = 1 << 16, 2 << 20, 512, 256
CHUNK_BYTES = 4 << 20
#: Texts of queries sent to the tasks at once, and of distinct query terms sent to the indexing tasks; beyond it, all terms are indexed.
QUERY_BYTES, TERM_BYTES = 4 << 20, 32 << 20
B, TF_ADD, TF_SCALE, SCALE = 25, 12, 1000, 10 ** 9

SEGMENT = ("n_docs long, n_terms long, doc_ids binary, id_known binary, doc_terms binary, terms array<string>, "
           "dfs array<long>, slots binary, tfs binary")


def term_bounds(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, doc): term i of a chunk is the bytes from bounds[2 i] to bounds[2 i + 1], in document doc[i]."""
    is_term = tn.ALNUM[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[1:-1] = is_term[1:] != is_term[:-1]
    first = is_term[offs[:-1][offs[:-1] < len(raw)]]
    edge[offs[:-1][offs[:-1] < len(raw)][first]] = True
    starts = np.flatnonzero(edge[:-1] & is_term)
    last = np.zeros(len(raw) + 1, bool)
    last[1:] = is_term
    edge[offs] = True
    ends = np.flatnonzero(edge & last)
    bounds = np.empty(2 * len(starts), np.int64)
    bounds[::2], bounds[1::2] = starts, ends
    return bounds, np.searchsorted(offs, starts, "right") - 1


def terms_of(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(number of each term, its document, distinct terms) of a chunk."""
    bounds, doc = term_bounds(raw, offs)
    data = pa.py_buffer(np.ascontiguousarray(tn.LOWER[raw]))
    stops = np.append(bounds, len(raw)) if len(bounds) else np.zeros(1, np.int64)
    # What stands between two terms is an entry too (there are few kinds), so no byte is copied.
    both = pa.Array.from_buffers(pa.large_binary(), len(bounds), [None, pa.py_buffer(stops), data])
    found = both.dictionary_encode()
    return found.indices.to_numpy()[::2].astype(np.int64), doc, found.dictionary


class Segment:
    """Documents of one segment until it is written."""

    def __init__(self):
        self.ids, self.lengths, self.names = [], [], {}
        self.term, self.slot, self.tf, self.docs, self.entries = [], [], [], 0, 0

    def add(self, ids: pa.Array, lengths: np.ndarray, number: np.ndarray, doc: np.ndarray, names: pa.Array) -> None:
        """``number`` and ``doc`` of every indexed term, by ``names``."""
        key, tf = np.unique(number * len(lengths) + doc, return_counts=True)
        used, index = np.unique(key // max(1, len(lengths)), return_inverse=True)
        own = [self.names.setdefault(t, len(self.names)) for t in names.take(pa.array(used)).to_pylist()]
        self.term.append(np.array(own, np.int64)[index])
        self.slot.append(self.docs + key % max(1, len(lengths)))
        self.tf.append(tf)
        self.ids.append(ids)
        self.lengths.append(lengths)
        self.docs += len(lengths)
        self.entries += len(key)

    def batch(self) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        lengths, term, slot, tf = (np.concatenate(x) for x in (self.lengths, self.term, self.slot, self.tf))
        order = np.argsort(term, kind="stable")  # documents stay in order
        dfs = np.bincount(term, minlength=len(self.names))
        known = np.packbits(pc.is_valid(ids).to_numpy(zero_copy_only=False)).tobytes()
        return pa.RecordBatch.from_pylist([{
            "n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()),
            "doc_ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(), "id_known": known,
            "doc_terms": lengths.astype("<i8").tobytes(), "terms": [t.decode() for t in self.names], "dfs": dfs.tolist(),
            "slots": slot[order].astype("<u4").tobytes(), "tfs": tf[order].astype("<u4").tobytes()}],
            schema=pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.binary()),
                              ("id_known", pa.binary()), ("doc_terms", pa.binary()), ("terms", pa.list_(pa.string())),
                              ("dfs", pa.list_(pa.int64())), ("slots", pa.binary()), ("tfs", pa.binary())]))


def query_terms(queries: DataFrame) -> DataFrame:
    """term: the distinct terms of all queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = tn.utf8(batch.column(0))
            for _, _, r, o in tn.chunks(raw, offs):
                number, _, names = terms_of(r, o)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(np.unique(number))).cast(pa.binary()).cast(pa.string())], ["term"])

    return queries.select("text").mapInArrow(run, "term string").distinct()


def segments(docs: DataFrame, wanted=None, segment_docs: int = SEGMENT_DOCS,
             segment_entries: int = SEGMENT_ENTRIES) -> DataFrame:
    """One row per segment (see ``SEGMENT``). ``wanted``: a broadcast list of the terms to index, or None for all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = pa.array([t.encode() for t in wanted.value], pa.large_binary()) if wanted is not None else None
        segment = Segment()
        for batch in batches:
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs, CHUNK_BYTES):
                number, doc, names = terms_of(r, o)
                lengths = np.bincount(doc, minlength=j - i)
                if only is not None:
                    keep = pc.is_in(names, value_set=only).to_numpy(zero_copy_only=False)
                    number, doc = number[(kept := keep[number])], doc[kept]
                for a in range(0, j - i, segment_docs):
                    b = min(a + segment_docs, j - i)
                    if segment.docs and segment.docs + b - a > segment_docs:
                        yield segment.batch()
                        segment = Segment()
                    here = (doc >= a) & (doc < b)
                    segment.add(batch.column(0).slice(i + a, b - a), lengths[a:b], number[here], doc[here] - a, names)
                if segment.entries >= segment_entries:
                    yield segment.batch()
                    segment = Segment()
        if segment.docs:
            yield segment.batch()

    return docs.select("doc_id", "text").mapInArrow(run, SEGMENT)


class Best:
    """The k best (score, doc_id) of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc, self.known = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def least(self) -> int:
        """Documents below this score can't get in."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        score, doc, known = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.known, known)))
        order = np.lexsort((doc, ~known, -score))[:self.k]
        self.score, self.doc, self.known = score[order], doc[order], known[order]


class Lists:
    """A segment's lists with each entry's unweighted score, and their highest in every range of documents."""

    def __init__(self, row: dict, n: int, total: int):
        length = np.frombuffer(row["doc_terms"], "<i8").astype(np.int64)
        self.docs = len(length)
        self.ids = np.frombuffer(row["doc_ids"], "<i8")
        self.known = np.unpackbits(np.frombuffer(row["id_known"], np.uint8))[:self.docs].astype(bool)
        self.slot = np.frombuffer(row["slots"], "<u4").astype(np.int64)
        tf = np.frombuffer(row["tfs"], "<u4").astype(np.int64)
        m = 100 - B + (B * length * n) // max(1, total)
        self.gain = (SCALE * tf) // (TF_SCALE * tf + TF_ADD * m[self.slot])
        df = np.array(row["dfs"], np.int64)
        ends = np.cumsum(df)
        self.at = {t: (int(e - k), int(e)) for t, e, k in zip(row["terms"], ends, df)}
        self.ranges = -(-self.docs // RANGE_DOCS)
        self.tops: dict[str, np.ndarray] = {}

    def top(self, term: str) -> np.ndarray:
        """The term's highest score in each range of documents (kept, as many queries ask for the same long lists)."""
        if term not in self.tops:
            a, b = self.at[term]
            self.tops[term] = np.zeros(self.ranges, np.int64)
            np.maximum.at(self.tops[term], self.slot[a:b] // RANGE_DOCS, self.gain[a:b])
        return self.tops[term]

    def evaluate(self, weights: list[tuple[str, int]], best: Best, short: int) -> int:
        """Adds this segment's best documents of a query, given its terms' weights; returns how many entries of long
        lists were looked up."""
        lists = [(w, t) for t, w in weights if w and t in self.at]
        if not lists:
            return 0
        # Term at a time: all short lists become one.
        summed = np.zeros(self.docs, np.int64)
        long = []
        for w, t in lists:
            a, b = self.at[t]
            if b - a <= short:
                summed[self.slot[a:b]] += w * self.gain[a:b]
            else:
                long.append((w * self.top(t), w, a, b))
        starts = np.arange(0, self.docs, RANGE_DOCS)
        bound = np.maximum.reduceat(summed, starts)
        for top, *_ in long:
            bound = bound + top
        # Document at a time, by ranges.
        looked = 0
        for r in range(self.ranges):
            if bound[r] < best.least():
                continue
            lo, hi = r * RANGE_DOCS, min(self.docs, (r + 1) * RANGE_DOCS)
            score = summed[lo:hi].copy()
            order = sorted((x for x in long if x[0][r]), key=lambda x: -x[0][r])
            rest = sum(int(x[0][r]) for x in order)
            left = None  # all documents of the range, until some can't get in any more
            for top, w, a, b in order:
                if left is None and rest < best.least():
                    left = np.flatnonzero(score + rest >= best.least())
                elif left is not None:
                    left = left[score[left] + rest >= best.least()]
                rest -= int(top[r])
                a, b = a + np.searchsorted(self.slot[a:b], (lo, hi))
                if left is None:
                    score[self.slot[a:b] - lo] += w * self.gain[a:b]
                    looked += b - a
                elif len(left):
                    place = a + np.searchsorted(self.slot[a:b], left + lo)
                    held = place < b
                    held[held] = self.slot[place[held]] == left[held] + lo
                    score[left[held]] += w * self.gain[place[held]]
                    looked += len(left)
                else:
                    break
            left = np.arange(hi - lo) if left is None else left
            left = left[score[left] >= best.least()]
            if len(left):
                best.add(score[left], self.ids[lo + left], self.known[lo + left])
        return looked


def best_of_segments(index: DataFrame, queries, n: int, total: int, k: int = K, short: int = SHORT) -> DataFrame:
    """query, doc_id, score: each task's ``k`` best of every query; ``queries`` is a broadcast {query: [(term, weight)]}."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q: Best(k) for q in queries.value}
        for batch in batches:
            for i in range(batch.num_rows):
                lists = Lists(batch.slice(i, 1).to_pylist()[0], n, total)
                for q, weights in queries.value.items():
                    lists.evaluate(weights, best[q], short)
        some = {q: b for q, b in best.items() if len(b.score)}
        if some:
            known = np.concatenate([b.known for b in some.values()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(list(some), np.int64), [len(b.score) for b in some.values()])),
                 pa.array(np.concatenate([b.doc for b in some.values()]), mask=~known),
                 pa.array(np.concatenate([b.score for b in some.values()]))], ["query", "doc_id", "score"])

    return index.mapInArrow(run, "query long, doc_id long, score long")


def rank(docs: DataFrame, queries: DataFrame, k: int = K, short: int = SHORT, query_bytes: int = QUERY_BYTES,
         term_bytes: int = TERM_BYTES, **bounds) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each of ``queries(item_id, text)``."""
    spark = docs.sparkSession
    asked = (queries.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct())
    asked = materialize(asked.withColumn("query", F.xxhash64(F.lit(13), "item_id", "text")), "ranked-queries")
    terms = materialize(query_terms(asked), "ranked-terms")
    size = terms.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    wanted = (spark.sparkContext.broadcast([r.term for r in terms.collect()]) if size <= term_bytes else None)
    index = materialize(segments(docs, wanted, **bounds), "ranked-segments")
    n, total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    frequency = materialize(
        index.select(F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("dfs").alias("df"))))
        .groupBy("term").agg(F.sum("df").alias("df")).join(terms, "term", "left_semi"), "ranked-df")
    blocks = max(1, math.ceil((asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / query_bytes))
    found = None
    for b in range(blocks):  # of bounded size each, against all segments
        here = asked.where(F.pmod("query", F.lit(blocks)) == b)
        held = frequency.join(query_terms(here), "term", "left_semi") if blocks > 1 else frequency
        df = {r.term: r.df for r in held.collect()}
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
        weighted = {r.query: _weights(r.text, weight) for r in here.select("query", "text").collect()}
        best = materialize(best_of_segments(index, spark.sparkContext.broadcast(weighted), n, total, k, short),
                           "ranked-best")
        found = best if found is None else found.unionByName(best)
    # The rows of all tasks, at most k each, meet by query; Spark keeps the first k of every partition before that.
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score"))


def _weights(text: str, weight: dict[str, int]) -> list[tuple[str, int]]:
    """The known terms of a query with their weight times their number."""
    raw = np.frombuffer(text.encode(), np.uint8)
    number, _, names = terms_of(raw, np.array([0, len(raw)], np.int64))
    listed = [t.decode() for t in names.to_pylist()]
    return sorted((listed[i], weight[listed[i]] * c) for i, c in Counter(number.tolist()).items() if listed[i] in weight)
