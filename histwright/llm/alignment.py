"""Alignment of two tokenizers by inverted pair bitmaps.

Both tokenizers cover the same bytes: a space and the text. The byte offsets where
tokens of both end cut them into groups; every overlap of an A token and a B token is a
link. A text is tokenised and aligned by its distinct units (see ``units``): both tokenizers
cut there, so a unit's ids, groups and links are the same wherever it stands, are worked out
once, and documents are put together by gathering them.

The scores need, for each linked pair of ids, how many documents hold it. Each task
numbers its documents in blocks and turns the pairs of a block into postings: one row for
each pair and block with a compressed bitmap of the documents (sorted 16-bit numbers, or plain bits when
that is shorter) and, over the documents in it, one bit plane for each binary digit of the
number of links. Blocks never share a document, so the OR of a pair's bitmaps over all blocks is
their concatenation and its popcount the sum of the rows' counts: summed before the shuffle,
nothing but (pair, block, count) travels by pair. The counts then go back to the blocks, where
the postings are read once more: bitmaps give the documents, planes the links, counts the scores.

A block has at most ``BLOCK_DOCS`` documents and about ``BLOCK_ENTRIES`` postings (or one document's),
which bounds every task; a pair that all documents hold has one row for each block.

Defined results: a text that is NULL or empty, or whose bytes one tokenizer changes, has no
tokens: zeros and empty ``groups``; repeated rows are documents of their own and each get
their row; NULL ids stay NULL; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textnum as tn
from . import units
from .common import materialize

BLOCK_DOCS = 1 << 16
BLOCK_ENTRIES = 3 << 20
CHUNK_BYTES = 2 << 20
#: What a worker remembers of distinct units: their number, and bytes of groups and links.
REMEMBER, REMEMBER_BYTES = 400_000, 96 << 20

_DOC = ("struct<doc_id:long,n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string>")
_DOC_TYPE = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                       ("n_links", pa.int64()), ("groups_sha256", pa.string())])
#: kind 0: a document (key: its number in the block); kind 2: a posting (key: the pair, n: its documents).
ROWS = f"block long, kind int, key long, n long, bitmap binary, planes binary, doc {_DOC}"
_NAMES = ["block", "kind", "key", "n", "bitmap", "planes", "doc"]


class Pieces:
    """Ids by a piece vocabulary file and the bytes each id stands for."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.cuts = not units.inner_word_start(names)

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the space that the model puts before it."""
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


class Aligned:
    """Tokens of both sides over the same bytes: ids, ends, and what follows from them for each span."""

    def __init__(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, ends: np.ndarray):
        """``ends``: where the spans end; both sides have a token that ends there."""
        def per_span(at: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(at, ends, "right"), prepend=0)

        if not (np.isin(ends, a_ends).all() and np.isin(ends, b_ends).all()):
            raise ValueError("a token crosses the end of a unit")
        shared = a_ends[np.isin(a_ends, b_ends, assume_unique=True)]
        cuts = np.sort(np.concatenate([a_ends, b_ends[~np.isin(b_ends, shared, assume_unique=True)]]))
        # Two tokens overlap in one run of bytes without a cut inside, and each such run lies in one token of each side.
        self.links = (a[np.searchsorted(a_ends, cuts)].astype(np.int64) << 32) | b[np.searchsorted(b_ends, cuts)]
        self.n_a, self.n_b, self.n_groups, self.n_links = (per_span(x) for x in (a_ends, b_ends, shared, cuts))
        self.groups = _texts(a, a_ends, b, b_ends, shared, ends)


def _large(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


def _texts(a, a_ends, b, b_ends, shared, ends) -> list[bytes]:
    """Each span's groups as ``a1,a2|b1;a3|b2,b3``."""
    def runs(values: pa.Array, at: np.ndarray, stops: np.ndarray, mark: str) -> pa.Array:
        offsets = np.concatenate([[0], np.searchsorted(at, stops, "right")]).astype(np.int64)
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), values), _large(mark))

    def side(ids: np.ndarray, at: np.ndarray) -> pa.Array:
        return runs(pa.array(ids.astype(np.int64)).cast(pa.large_string()), at, shared, ",")

    groups = pc.binary_join_element_wise(side(a, a_ends), side(b, b_ends), _large("|"))
    return runs(groups, shared, ends, ";").cast(pa.large_binary()).to_pylist()


class Aligner:
    """Both tokenizers, and what each distinct unit gives."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = units.ByteLevel(path_a, special=False), Pieces(path_b)
        self.cuts = self.a.cuts and self.b.cuts
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[bytes | None] = []
        self.links, self.start = units.Growing(np.int64), units.Growing(np.int64)
        self.counts, self.held = [units.Growing(np.int64) for _ in range(4)], 0

    def _whole(self, text: bytes) -> Aligned | None:
        """One text (with its space), or None when a tokenizer doesn't give its bytes back."""
        s = text.decode()
        a, b = self.a.texts([s])[0], self.b.texts([s[1:]])[0]
        if b"".join([self.a.bytes[i] for i in a]) != text or b"".join([self.b.bytes[i] for i in b]) != text:
            return None
        return Aligned(a, np.cumsum(self.a.lengths[a]), b, np.cumsum(self.b.lengths[b]), np.array([len(text)]))

    def _pieces(self, texts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends, which texts came back) of joined texts, without the ``x`` before each."""
        got = self.b.texts(texts)
        count = np.array([len(x) for x in got])
        ids = np.concatenate(got)
        size = self.b.lengths[ids]
        at = np.cumsum(size)
        stop = np.cumsum(count)
        given = np.diff(at[stop - 1], prepend=0)
        joined = b"".join([self.b.bytes[i] for i in ids.tolist()])
        same = given == sizes + 2
        upto = np.concatenate([[0], at[stop - 1]])
        for k in np.flatnonzero(same).tolist():
            same[k] = joined[upto[k]:upto[k + 1]] == (" " + texts[k]).encode()
        own = np.repeat(same, count)
        text = np.repeat(np.arange(len(texts)), count)
        inside = at - np.repeat(upto[:-1], count) - 2  # ends within the text's units
        own &= inside > 0
        base = np.cumsum(np.where(same, sizes, 0)) - np.where(same, sizes, 0)
        return ids[own], inside[own] + base[text[own]], same

    def _learn(self, new: list[bytes]) -> None:
        """Remembers units; those that a tokenizer changes are remembered as changed."""
        words = [u.decode() for u in new]
        size = np.array([len(u) for u in new], np.int64)
        texts, n = units.joined(words, size.tolist())
        text = np.repeat(np.arange(len(texts)), n)
        per_text = np.bincount(text, size, len(texts)).astype(np.int64)
        b, b_ends, same = self._pieces(texts, per_text)
        good = np.flatnonzero(same[text])
        self._add([new[i] for i in good], b, b_ends)
        rest = np.flatnonzero(~same[text]).tolist()
        if len(rest) == 1 or rest and all(n[text[i]] == 1 for i in rest):
            for i in rest:
                self._enter([new[i]], [None], np.empty(0, np.int64), [np.zeros(1, np.int64)] * 4)
        elif rest:  # one by one
            for i in rest:
                b, b_ends, same = self._pieces(["x" + words[i]], size[i:i + 1])
                if same[0]:
                    self._add([new[i]], b, b_ends)
                else:
                    self._enter([new[i]], [None], np.empty(0, np.int64), [np.zeros(1, np.int64)] * 4)

    def _add(self, new: list[bytes], b: np.ndarray, b_ends: np.ndarray) -> None:
        if not new:
            return
        a, _ = self.a.units(new)
        found = Aligned(a, np.cumsum(self.a.lengths[a]), b, b_ends, np.cumsum([len(u) for u in new]))
        self._enter(new, found.groups, found.links, [found.n_a, found.n_b, found.n_groups, found.n_links])

    def _enter(self, new, groups, links, counts) -> None:
        self.start.extend(self.links.n + np.cumsum(counts[3]) - counts[3])
        self.links.extend(links)
        for held, x in zip(self.counts, counts):
            held.extend(x)
        self.held += sum(map(len, new)) + sum(len(g or b"") for g in groups) + 8 * len(links)
        self.number.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
        self.groups.extend(groups)

    def __call__(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of a chunk of texts with a space before each (or empty): the counts n_a, n_b, n_groups, n_links by document,
        the digests of their groups, all links, and each document's first link."""
        n = len(offs) - 1
        if len(self.number) > REMEMBER or self.held > REMEMBER_BYTES:
            self._clear()
        if not self.cuts:
            none, some = np.empty(0, np.int64), np.flatnonzero(np.diff(offs)).tolist()
            return self._mixed(raw, offs, some, np.zeros((4, n), np.int64), [""] * n, [none] * n)
        bounds, first = units.split(raw, offs)
        index, words = units.distinct(raw, bounds)
        new = [w for w in words if w not in self.number]
        if new:
            self._learn(new)
        unit = np.array([self.number[w] for w in words], np.int64)[index]
        totals = np.stack([np.diff(np.concatenate([[0], np.cumsum(c.view()[unit])])[first]) for c in self.counts])
        changed, digests = [], []
        groups, order = self.groups, unit.tolist()
        for d in range(n):
            a, b = first[d], first[d + 1]
            try:
                digests.append(hashlib.sha256(b";".join([groups[i] for i in order[a:b]])).hexdigest() if b > a else "")
            except TypeError:  # a unit that a tokenizer changes
                changed.append(d)
                digests.append("")
        count = self.counts[3].view()[unit]
        links = units.gather(self.links.view(), self.start.view()[unit], count)
        at = np.concatenate([[0], np.cumsum(count)])[first]
        if changed:
            return self._mixed(raw, offs, changed, totals, digests, [links[a:b] for a, b in zip(at, at[1:])])
        return totals, digests, links, at

    def _mixed(self, raw, offs, changed, totals, digests, links):
        """As above, with some documents aligned as a whole."""
        for d in changed:
            found = self._whole(raw[offs[d]:offs[d + 1]].tobytes())
            links[d] = found.links if found else links[d][:0]
            digests[d] = hashlib.sha256(found.groups[0]).hexdigest() if found else ""
            totals[:, d] = [x[0] for x in (found.n_a, found.n_b, found.n_groups, found.n_links)] if found else 0
        return totals, digests, np.concatenate(links), np.concatenate([[0], np.cumsum([len(x) for x in links])])


@functools.lru_cache(maxsize=1)
def shared_aligner(path_a: str, path_b: str) -> Aligner:
    """One for all tasks of a Python worker."""
    return Aligner(path_a, path_b)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets),
                                 pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))]).cast(pa.binary())


def plane_bits(links: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes of each posting): plane k holds binary digit k of every document's number of links."""
    start = np.cumsum(n) - n
    digits = np.frexp(np.maximum.reduceat(links, start))[1].astype(np.int64)
    width = (n + 7) // 8
    size = digits * width
    base = np.cumsum(size) - size
    bits = np.zeros(8 * int(size.sum()), np.uint8)
    rank = np.arange(len(links)) - np.repeat(start, n)
    for k in range(int(digits.max())):
        on = np.flatnonzero(links >> k & 1)
        row = np.searchsorted(start, on, "right") - 1
        bits[8 * (base[row] + k * width[row]) + rank[on]] = 1
    return np.packbits(bits, bitorder="little"), size


def plane_links(data: np.ndarray, size: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of links back from the planes."""
    bits = np.unpackbits(data, bitorder="little")
    width = (n + 7) // 8
    digits = size // width
    base = np.cumsum(size) - size
    start = np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.int64)
    for k in range(int(digits.max(initial=0))):
        row = np.flatnonzero(digits > k)
        at = np.repeat(start[row] - (np.cumsum(n[row]) - n[row]), n[row]) + np.arange(int(n[row].sum()))
        rank = at - np.repeat(start[row], n[row])
        out[at] += bits[np.repeat(8 * (base[row] + k * width[row]), n[row]) + rank].astype(np.int64) << k
    return out


class Block:
    """Documents and links of one block until it is written."""

    def __init__(self):
        self.docs: list[tuple] = []
        self.pairs, self.slots, self.links, self.entries = [], [], [], 0

    def add(self, ids: list, totals, digests, links, first) -> None:
        base, n = len(self.docs), len(ids)
        a, b, g, k = (x.tolist() for x in totals)
        self.docs.extend(zip(ids, a, b, g, k, digests))
        if len(links):
            doc = np.repeat(np.arange(n), np.diff(first))
            order = np.argsort(links, kind="stable")  # documents stay in order
            pair, doc = links[order], doc[order]
            start = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])]))
            self.pairs.append(pair[start])
            self.slots.append(base + doc[start])
            self.links.append(np.diff(np.append(start, len(pair))))
            self.entries += len(start)

    def batches(self, block: int) -> Iterator[pa.RecordBatch]:
        docs = len(self.docs)
        yield self._batch(block, 0, np.arange(docs), pa.nulls(docs, pa.int64()), pa.nulls(docs, pa.binary()),
                          pa.nulls(docs, pa.binary()),
                          pa.array([dict(zip(("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), d))
                                    for d in self.docs], _DOC_TYPE))
        if not self.entries:
            return
        pair, slot, links = (np.concatenate(x) for x in (self.pairs, self.slots, self.links))
        order = np.argsort(pair, kind="stable")  # documents stay in order
        pair, slot, links = pair[order], slot[order], links[order]
        start = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        n = np.diff(np.append(start, len(pair)))
        as_bits = 2 * n > (docs + 7) // 8
        for kind in (False, True):
            rows = np.flatnonzero(as_bits == kind)
            # Python workers send at most some thousand rows at a time.
            for part in np.array_split(rows, len(rows) // 20_000 + 1):
                if not len(part):
                    continue
                s, k = units.gather(slot, start[part], n[part]), n[part]
                if kind:
                    bits = np.zeros((len(part), docs), np.uint8)
                    bits[np.repeat(np.arange(len(part)), k), s] = 1
                    bits = np.packbits(bits, axis=1, bitorder="little")
                    bitmap = _binary(bits.reshape(-1), np.full(len(part), bits.shape[1]))
                else:
                    bitmap = _binary(s.astype("<u2"), 2 * k)
                planes, size = plane_bits(units.gather(links, start[part], k), k)
                yield self._batch(block, 2, pair[start[part]], pa.array(k), bitmap, _binary(planes, size),
                                  pa.nulls(len(part), _DOC_TYPE))

    @staticmethod
    def _batch(block, kind, key, n, bitmap, planes, doc) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), block, np.int64)), pa.array(np.full(len(key), kind, np.int32)),
             pa.array(key.astype(np.int64)), n, bitmap, planes, doc], _NAMES)


def invert(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_docs: int = BLOCK_DOCS,
           block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Documents and postings of all blocks (see ``ROWS``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        aligner = shared_aligner(path_a or public_tokenizers.path("byte_bpe_50k.json"),
                                 path_b or public_tokenizers.path("piece_bpe_32k.model"))
        task = TaskContext.get()
        number, block = (task.partitionId() if task else 0) << 32, Block()
        for batch in batches:
            text = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            text = pc.if_else(pc.equal(text, ""), text, pc.binary_join_element_wise(_large(" "), text, _large("")))
            raw, offs = tn.utf8(text)
            for i, j, r, o in tn.chunks(raw, offs, CHUNK_BYTES):
                totals, digests, links, first = aligner(r, o)
                ids = batch.column(0).slice(i, j - i).to_pylist()
                for a in range(0, j - i, block_docs):
                    b = min(a + block_docs, j - i)
                    if block.docs and len(block.docs) + b - a > block_docs:
                        yield from block.batches(number)
                        number, block = number + 1, Block()
                    block.add(ids[a:b], totals[:, a:b], digests[a:b], links[first[a]:first[b]],
                              first[a:b + 1] - first[a])
                if block.entries >= block_entries:
                    yield from block.batches(number)
                    number, block = number + 1, Block()
        if block.docs:
            yield from block.batches(number)

    return docs.select("doc_id", "text").mapInArrow(run, ROWS)


def pair_counts(postings: DataFrame) -> DataFrame:
    """pair, n_docs, best (whether no pair of the same A id is in more documents)."""
    counts = postings.where("kind = 2").groupBy(F.col("key").alias("pair")).agg(F.sum("n").alias("n_docs"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counts.withColumn("best", F.col("n_docs") == F.max("n_docs").over(of_a))


def scores(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs, weight, best, at = None, [], None, None, 0
        parts: list[pa.RecordBatch] = []

        def finish() -> pa.RecordBatch:
            whole = pa.concat_arrays(docs)
            return pa.RecordBatch.from_arrays(
                [whole.field(i) for i in range(5)] + [pa.array(n_best), pa.array(total), whole.field(5)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for a, b in _runs(blocks):
                part = batch.slice(a, b - a)
                if now != blocks[a]:
                    if now is not None:
                        yield finish()
                    now, docs, parts, at, weight = blocks[a], [], [], 0, None
                kind = part.column(1).to_numpy()
                for k, c, d in ((kind[c], c, d) for c, d in _runs(kind)):
                    rows = part.slice(c, d - c)
                    if k == 0:
                        docs.append(rows.column(6))
                        n_best = total = None
                    elif k == 1:
                        parts.append(rows.column(3))
                    else:
                        if weight is None:
                            found = pa.concat_arrays(parts).to_numpy()
                            weight, best, at = np.abs(found), found > 0, 0
                        if total is None:
                            size = sum(map(len, docs))
                            n_best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
                        _read(rows, weight[at:at + d - c], best[at:at + d - c], n_best, total)
                        at += d - c
                if total is None:
                    size = sum(map(len, docs))
                    n_best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if now is not None:
            yield finish()

    # The count of a pair that is not its A id's best goes as a negative number.
    back = (postings.where("kind = 2").select("block", F.col("key").alias("pair")).join(counts, "pair")
            .select("block", F.lit(1).alias("kind"), F.col("pair").alias("key"),
                    F.when(F.col("best"), F.col("n_docs")).otherwise(-F.col("n_docs")).alias("n")))
    rows = postings.unionByName(back, allowMissingColumns=True)
    return (rows.repartition("block").sortWithinPartitions("block", "kind", "key")
            .mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                             "count_sum long, groups_sha256 string"))


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    cut = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)]
    return [(a, b) for a, b in zip(cut, cut[1:]) if b > a]


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column."""
    a = column.cast(pa.large_binary())
    _, off, data = a.buffers()
    offs = np.frombuffer(off, np.int64)[a.offset:a.offset + len(a) + 1]
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def _read(rows: pa.RecordBatch, weight: np.ndarray, best: np.ndarray, n_best: np.ndarray, total: np.ndarray) -> None:
    """Adds the scores of some postings to their documents."""
    n = rows.column(3).to_numpy()
    raw, offs = _bytes(rows.column(4))
    listed = np.diff(offs) == 2 * n
    if listed.all():
        slot = raw.view("<u2").astype(np.int64)
    else:
        slot = np.concatenate([raw[a:b].view("<u2") if x else np.flatnonzero(np.unpackbits(raw[a:b], bitorder="little"))
                               for a, b, x in zip(offs[:-1].tolist(), offs[1:].tolist(), listed.tolist())])
    planes, p_offs = _bytes(rows.column(5))
    links = plane_links(planes, np.diff(p_offs), n)
    np.add.at(total, slot, links * np.repeat(weight, n))
    np.add.at(n_best, slot, links * np.repeat(best, n))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, **bounds) -> DataFrame:
    """See :func:`scores`; the postings are written once, so no text is tokenised again."""
    postings = materialize(invert(docs, path_a, path_b, **bounds), "align-postings")
    return scores(postings, pair_counts(postings))
