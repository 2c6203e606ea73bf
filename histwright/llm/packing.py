"""Cost-balanced packing of tokenised documents into training sequences.

Every document becomes its token ids plus the separator id 0. Documents are cut
into pieces and the pieces placed so that each sequence holds at most
``seq_len`` ids. A sequence's attention cost is estimated as
``linear * n + quadratic * n**2`` summed over its pieces. Documents go in
descending length to the sequence of lowest cost that still has room; a
document that fits in no sequence whole is cut at the end of the cheapest one and its
rest goes on in the same way.

Each task packs the documents of its own partition in buffers of
``buffer_tokens`` ids, so nothing is shuffled, no group exists that could be
hot, and memory is bounded by the buffer plus one document. A buffer opens as
many ``seq_len`` sequences as its ids fill completely; the remaining ids
(fewer than ``seq_len``) go to sequences whose sizes are powers of two, which
need no padding. Sequence ids are unique over the whole result: the partition
number in the upper bits, the sequence's number in the partition below.

Defined results: a NULL or empty text is the separator alone (one piece of
length 1); repeated rows are packed once for each row; an empty table gives no
rows; a NULL ``doc_id`` stays NULL; other input columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import textnum as tn
from . import units

SEQ_LEN = 1024
BUFFER_TOKENS = 2 << 20
SEPARATOR = 0
#: Bytes of text encoded at once, or one text.
CHUNK_BYTES = 1 << 20

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")


def id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    return np.asarray(ids, "<u4").tobytes()


class Encoder:
    """Token ids of whole texts through a byte-level BPE tokenizer file, by their distinct units (``units``)."""

    def __init__(self, path: str):
        self.ids = units.UnitIds(path)

    def __call__(self, text: str) -> bytes:
        raw = np.frombuffer(text.encode(), np.uint8)
        return id_bytes(self.ids(raw, np.array([0, len(raw)], np.int64))[0])


def sizes(total: int, seq_len: int) -> list[int]:
    """Sequence sizes that hold ``total`` ids exactly: full ones, then falling powers of two."""
    rest = total % seq_len
    return [seq_len] * (total // seq_len) + [1 << b for b in range(rest.bit_length() - 1, -1, -1)
                                             if rest >> b & 1]


def assign(lengths: list[int], seq_len: int = SEQ_LEN, linear: float = 1.0,
           quadratic: float = 1.0 / 256) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece.

    Documents in descending length (ties: the earlier first). Sequences of equal room stand in one
    heap, cheapest first; a tree over the rooms holds the cheapest of each range, so the cheapest
    one that holds a piece whole is found without looking at all of them.
    """
    room = sizes(sum(lengths), seq_len)
    size, cost = list(room), [0.0] * len(room)
    top = 1 << max(room, default=0).bit_length()
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(top)]
    none = (float("inf"), -1)
    tree = [none] * (2 * top)

    def renew(r: int) -> None:
        i = r + top
        tree[i] = heaps[r][0] if heaps[r] else none
        while i > 1:
            i >>= 1
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

    for s, r in enumerate(room):
        heaps[r].append((0.0, s))
    for r in set(room):
        renew(r)

    def cheapest(need: int) -> int | None:
        """The cheapest sequence with room for ``need`` ids; it leaves its heap."""
        best, i = none, need + top
        if need < top:
            best = tree[i]
            while i > 1:
                if not i & 1:
                    best = min(best, tree[i + 1])
                i >>= 1
        if best is none:
            return None
        heapq.heappop(heaps[room[best[1]]])
        renew(room[best[1]])
        return best[1]

    out = []
    for d in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
        start, left = 0, lengths[d]
        while left:
            s = cheapest(min(left, seq_len))
            if s is None:
                s = cheapest(1)
            n = min(left, room[s])
            out.append((d, start, n, s, size[s] - room[s]))
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            if room[s]:
                heapq.heappush(heaps[room[s]], (cost[s], s))
                renew(room[s])
            start, left = start + n, left - n
    return out


def _rows(doc_ids: list, ids: list[memoryview], first_sequence: int, seq_len: int,
          linear: float, quadratic: float) -> tuple[pa.RecordBatch, int]:
    lengths = [len(b) // 4 for b in ids]
    pieces = assign(lengths, seq_len, linear, quadratic)
    held = sizes(sum(lengths), seq_len)
    cols = list(zip(*pieces))
    d, start, n, s, off = cols
    crc = [zlib.crc32(ids[x][4 * a:4 * (a + k)]) for x, a, k in zip(d, start, n)]
    return pa.RecordBatch.from_arrays([
        pa.array([doc_ids[x] for x in d], pa.int64()), pa.array(start, pa.int64()),
        pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
        pa.array([lengths[x] for x in d], pa.int64()),
        pa.array([first_sequence + x for x in s], pa.int64()), pa.array(off, pa.int64()),
        pa.array([held[x] for x in s], pa.int64()),
    ], names=[c.split()[0] for c in SCHEMA.split(", ")]), len(held)


def pack(docs: DataFrame, tokenizer_path: str | None = None, seq_len: int = SEQ_LEN,
         buffer_tokens: int = BUFFER_TOKENS, linear: float = 1.0,
         quadratic: float = 1.0 / 256) -> DataFrame:
    """One row per piece (see ``SCHEMA``) of ``docs(doc_id, text)``.

    ``tokenizer_path`` names a byte-level BPE tokenizer file readable on every executor;
    by default the public 50k vocabulary found there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("byte_bpe_50k.json")
        encode = units.shared_ids(path)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 40
        doc_ids, ids, held = [], [], 0
        for batch in batches:
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs, CHUNK_BYTES):
                got, first = encode(r, o)
                all_ids = memoryview(np.insert(got, first[1:], SEPARATOR).astype("<u4")).cast("B")
                end = 4 * (first + np.arange(len(first)))
                for d, doc_id in enumerate(batch.column(0).slice(i, j - i).to_pylist()):
                    doc_ids.append(doc_id)
                    ids.append(all_ids[end[d]:end[d + 1]])
                    held += len(ids[-1]) // 4
                    if held >= buffer_tokens:
                        rows, n = _rows(doc_ids, ids, sequence, seq_len, linear, quadratic)
                        yield rows
                        sequence, doc_ids, ids, held = sequence + n, [], [], 0
        if ids:
            yield _rows(doc_ids, ids, sequence, seq_len, linear, quadratic)[0]

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
