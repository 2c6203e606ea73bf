"""Cross-entropy difference of a target and a background language model.

Both models are word bigram models of the same form over one vocabulary. The
score of a document is its mean loss per word under the target model minus that under the background model:
negative means closer to the target. What a word's bigrams leave of its probability goes to the
unigrams, so each context's probabilities add up to one.

``score_all`` keeps every word and every bigram, so the models grow with the corpus and are on
no machine as a whole. Documents are dealt to chunks of about ``PART`` bytes by a hash. A chunk asks
once for each of its distinct words and bigrams, with its own counts; keys are 64-bit hashes, dealt to
buckets by range. A bucket adds the counts up and answers every chunk that asked, and the chunk scores its documents
with the answers. A word of all documents is one key of a chunk, so no bucket gets more of it than there are chunks.

``fit`` and ``score`` are the small form for models that fit in memory: the words that make up
at least ``1 / VOCABULARY`` of the background's words (so there are at most ``VOCABULARY`` of them; all
others are one unknown word) and bigrams that make up at least ``1 / BIGRAMS`` of the
background's bigrams. Counts run over all words of all documents; what the share bounds let through is
collected and broadcast.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Defined results: a NULL or empty text has no
words and score 0; repeated rows count and score once each; an empty table gives no rows;
with no target rows the target model is uniform over the vocabulary; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import materialize

VOCABULARY, BIGRAMS = 100_000, 250_000
MIX, SMOOTH = 0.7, 0.5
#: Words that a task holds before it adds up its counts.
_HOLD = 4 << 20
#: Bytes of text for each chunk of documents and each bucket of keys.
PART = 4 << 20
_START, _STATS = np.uint64(0x2545F4914F6CDD1D), -1
_ODD = np.uint64(0xD1342543DE82EF95)


def _counted(keys: list[np.ndarray], flags: list[np.ndarray]) -> pa.RecordBatch:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    target = np.bincount(at, np.concatenate(flags), len(key)).astype(np.int64)
    total = np.bincount(at, minlength=len(key)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(target), pa.array(total)],
                                      ["key", "target", "background"])


def _counts(docs: DataFrame, extract) -> DataFrame:
    """(key, target, background) summed over ``docs(target, text)``; ``extract`` gives (keys, documents)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, flags, held = [], [], 0
        for batch in batches:
            target = batch.column(0).to_numpy(zero_copy_only=False)
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs):
                key, doc = extract(tn.Words(r, o, tn.NOT_SPACE))
                keys.append(key)
                flags.append(target[i:j][doc])
                held += len(key)
                if held >= _HOLD:
                    yield _counted(keys, flags)
                    keys, flags, held = [], [], 0
        if held:
            yield _counted(keys, flags)

    return (docs.select("target", "text").mapInArrow(run, "key long, target long, background long")
            .groupBy("key").agg(F.sum("target").alias("target"), F.sum("background").alias("background")))


@dataclass
class Vocabulary:
    """Sorted word hashes; a word's id is its place, unknown words have the next one, a start the one after."""
    words: np.ndarray

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, len(self.words))

    def pairs(self, w: tn.Words) -> tuple[np.ndarray, np.ndarray]:
        """(id of the word before, id) of every word as one key each, and the ids."""
        ids = self.ids(w.hash)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        starts = w.first[:-1][w.counts() > 0]
        before[starts] = len(self.words) + 1
        return (before << 32 | ids).astype(np.uint64), ids


@dataclass
class Models:
    """Loss tables of both models (rows: target, background)."""
    vocabulary: Vocabulary
    unigram: np.ndarray   # (2, ids) probabilities
    rest: np.ndarray      # (2, contexts) mass left to the unigrams
    pairs: np.ndarray     # kept bigram keys, sorted
    bigram: np.ndarray    # (2, kept) probability on top

    def losses(self, w: tn.Words) -> np.ndarray:
        """(2, words): minus log probability of each word."""
        key, ids = self.vocabulary.pairs(w)
        p = self.rest[:, (key >> np.uint64(32)).astype(np.int64)] * self.unigram[:, ids]
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = self.pairs[at] == key
            p[:, hit] += self.bigram[:, at[hit]]
        return -np.log(p)


def build(words: pa.Table, totals: tuple[int, int], pairs: pa.Table) -> Models:
    """Both models from the kept words' and bigrams' counts and the numbers of all words.

    ``words`` is sorted by the unsigned key.
    """
    vocabulary = Vocabulary(words.column("key").to_numpy().view(np.uint64))
    v = len(vocabulary.words)
    c = np.zeros((2, v + 1))
    for m, name in enumerate(("target", "background")):
        c[m, :v] = words.column(name).to_numpy()
        c[m, v] = max(0, totals[m] - c[m, :v].sum())
    unigram = (c + SMOOTH) / (c.sum(axis=1, keepdims=True) + SMOOTH * (v + 1))
    key = pairs.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    key = key[order]
    context = (key >> np.uint64(32)).astype(np.int64)
    n = np.stack([pairs.column(m).to_numpy()[order] for m in ("target", "background")]).astype(float)
    # A context's count: its word's, or for the start the number of its kept bigrams (a lower bound).
    of = np.zeros((2, v + 2))
    of[:, :v + 1] = c
    start = context == v + 1
    of[:, v + 1] = n[:, start].sum(axis=1)
    bigram = np.divide(MIX * n, of[:, context], out=np.zeros_like(n), where=of[:, context] > 0)
    rest = np.ones((2, v + 2))
    for m in range(2):
        rest[m] -= np.bincount(context, bigram[m], v + 2)
    return Models(vocabulary, unigram, np.maximum(rest, 1 - MIX), key, bigram)


def fit(docs: DataFrame, vocabulary: int = VOCABULARY, bigrams: int = BIGRAMS) -> Models:
    """Models of ``docs(text, target)``: the target rows, and all rows as background."""
    docs = docs.select(F.coalesce("target", F.lit(False)).alias("target"), F.coalesce("text", F.lit("")).alias("text"))
    counted = materialize(_counts(docs, lambda w: (w.hash, w.doc())), "lm-words")
    sums = counted.agg(F.sum("target"), F.sum("background")).first()
    totals = (sums[0] or 0, sums[1] or 0)
    # Unsigned order, as the search over word hashes needs it.
    words = (counted.where(F.col("background") * vocabulary >= totals[1]).toArrow())
    words = words.take(pa.array(np.argsort(words.column("key").to_numpy().view(np.uint64))))
    vocab = Vocabulary(words.column("key").to_numpy().view(np.uint64))
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def pairs(w: tn.Words):
        return sent.value.pairs(w)[0], w.doc()

    kept = (_counts(docs, pairs).where(F.col("background") * bigrams >= totals[1]).toArrow())
    return build(words, totals, kept)


def score(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss (means per word), score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs):
                w = tn.Words(r, o, tn.NOT_SPACE)
                n = w.counts()
                sums = [np.bincount(w.doc(), x, j - i) / np.maximum(n, 1) for x in sent.value.losses(w)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()),
                     pa.array(sums[0], pa.float64()), pa.array(sums[1], pa.float64()),
                     pa.array(sums[0] - sums[1], pa.float64())],
                    ["doc_id", "n_words", "target_loss", "background_loss", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, target_loss double, background_loss double, score double")


def _keys(w: tn.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the word before (or the start) and of the bigram, of every word."""
    before = np.empty_like(w.hash)
    before[1:] = w.hash[:-1]
    before[w.first[:-1][w.counts() > 0]] = _START
    return before, tn.mix(before * _ODD + w.hash)


def _packed(counts: np.ndarray) -> bytes:
    """Counts in the narrowest width that holds them all."""
    return counts.astype(f"<u{next(n for n in (1, 2, 4, 8) if counts.max(initial=0) < 1 << 8 * n)}").tobytes()


def _unpacked(raw: bytes | pa.Buffer, columns: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // (columns * n)}").reshape(columns, n)


def _key_bytes(key: np.ndarray) -> bytes:
    """Steps between sorted keys, byte by byte in planes: the high planes are zeros, which compress."""
    return np.diff(key, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _key_array(raw: pa.Buffer) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _cells(chunk: int, kind: int, parts: int, key: np.ndarray, counts: np.ndarray) -> pa.Table:
    """Sorted keys and their counts, one row for each bucket that has some; bigrams have the odd buckets."""
    # In two halves, as the product of a 64-bit key and the number of buckets is wider than 64 bits.
    part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    some, at = np.unique(part, return_index=True)
    ends = np.append(at, len(key))
    return pa.table([pa.array(np.full(len(some), chunk)), pa.array(some * 2 + kind),
                     pa.array([_key_bytes(key[i:j]) for i, j in zip(ends, ends[1:])], pa.binary()),
                     pa.array([_packed(counts[:, i:j]) for i, j in zip(ends, ends[1:])], pa.binary())],
                    names=["chunk", "bucket", "keys", "counts"])


def _chunk_words(docs: pa.Table) -> Iterator[tuple[int, int, tn.Words]]:
    raw, offs = tn.utf8(docs.column("text"))
    for i, j, r, o in tn.chunks(raw, offs):
        yield i, j, tn.Words(r, o, tn.NOT_SPACE)


def _unique(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their values (columns of equal length)."""
    key = np.concatenate([np.empty(0, np.uint64), *keys])
    value = np.concatenate(values, axis=1)
    key, at = np.unique(key, return_inverse=True)
    return key, np.stack([np.bincount(at, v, len(key)) for v in value]).astype(np.int64)


def _ask(parts: int):
    def run(docs: pa.Table, target_ids: pa.Table) -> pa.Table:
        """Words with their counts (target, all; and those as the last word), bigrams with theirs."""
        if not docs.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("chunk", pa.int64()), ("bucket", pa.int64()),
                                                             ("keys", pa.binary()), ("counts", pa.binary()))})
        target = pc.is_in(docs.column("doc_id"), value_set=target_ids.column("doc_id")).to_numpy()
        words, pairs = ([], [np.zeros((4, 0))]), ([], [np.zeros((2, 0))])
        for i, j, w in _chunk_words(docs):
            own = target[i:j]
            flag, none = own[w.doc()], np.zeros(len(w))
            last = none.copy()
            last[w.first[1:][w.counts() > 0] - 1] = 1
            any_words = own[w.counts() > 0]
            key, value = _unique(
                [w.hash, np.full(len(any_words), _START)],
                [np.stack([flag, none + 1, last * flag, last]),
                 np.stack([any_words, np.ones(len(any_words)), *np.zeros((2, len(any_words)))])])
            words[0].append(key)
            words[1].append(value)
            key, value = _unique([_keys(w)[1]], [np.stack([flag, none + 1])])
            pairs[0].append(key)
            pairs[1].append(value)
        chunk = docs.column("chunk")[0].as_py()
        return pa.concat_tables(_cells(chunk, kind, parts, *_unique(*x)) for kind, x in enumerate((words, pairs)))
    return run


def _answer(asked: pa.Table) -> pa.Table:
    """Corpus counts of the keys of each row; of words also a row of totals: distinct, target, all."""
    bucket = asked.column("bucket")[0].as_py()
    columns = 2 if bucket % 2 else 4
    keys = [_key_array(x.as_buffer()) for x in asked.column("keys")]
    counts = [_unpacked(x.as_py(), columns, len(k)) for x, k in zip(asked.column("counts"), keys)]
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.concatenate(counts, axis=1)
    total = np.stack([np.bincount(at, v, len(key)) for v in value]).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    chunks = asked.column("chunk").to_pylist()
    held = [_packed(total[:, at[e - len(k):e]]) for k, e in zip(keys, ends)]
    stats = [None] * len(held)
    if columns == 4:
        word = key != _START
        chunks.append(_STATS)
        held.append(b"")
        stats.append([int(word.sum()), int(total[0, word].sum()), int(total[1, word].sum())])
    return pa.table([pa.array(chunks, pa.int64()), pa.array([bucket] * len(held), pa.int64()),
                     pa.array([*map(len, keys), *[0] * (len(held) - len(keys))], pa.int64()),
                     pa.array(held, pa.binary()), pa.array(stats, pa.list_(pa.int64()))],
                    names=["chunk", "bucket", "n", "counts", "stats"])


def _counts_of(answers: pa.Table, kind: int, columns: int, n: int) -> np.ndarray:
    """(columns, n): the answers in the order of the chunk's sorted keys."""
    got = sorted(x for x in zip(*[answers.column(c).to_pylist() for c in ("bucket", "n", "counts")])
                 if x[0] % 2 == kind)
    out = np.concatenate([np.zeros((columns, 0), np.int64),
                          *[_unpacked(c, columns, k) for _, k, c in got]], axis=1)
    if out.shape[1] != n:
        raise ValueError(f"{n} keys asked, {out.shape[1]} answered")
    return out


def _score(distinct: int, totals: tuple[int, int]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        held = list(_chunk_words(docs))
        word = np.unique(np.concatenate([np.empty(0, np.uint64), *[w.hash for *_, w in held],
                                         *[_START[None] for *_, w in held if len(w)]]))
        pair = np.unique(np.concatenate([np.empty(0, np.uint64), *[_keys(w)[1] for *_, w in held]]))
        c = _counts_of(answers, 0, 4, len(word)).astype(float)
        n = _counts_of(answers, 1, 2, len(pair))
        c, last = c[:2], c[2:]
        unigram = (c + SMOOTH) / (np.array(totals, float)[:, None] + SMOOTH * (distinct + 1))
        # What a context's bigrams leave: all of them are kept, and a last word has none.
        share = np.divide(MIX, c, out=np.zeros_like(c), where=c > 0)
        rest = 1 - share * (c - last)
        out = []
        for i, j, w in held:
            before, key = _keys(w)
            u, x = np.searchsorted(word, before), np.searchsorted(word, w.hash)
            loss = -np.log(rest[:, u] * unigram[:, x] + share[:, u] * n[:, np.searchsorted(pair, key)])
            count = w.counts()
            sums = [np.bincount(w.doc(), v, j - i) / np.maximum(count, 1) for v in loss]
            out.append(pa.table([docs.column("doc_id").slice(i, j - i), pa.array(count, pa.int64()),
                                 *[pa.array(v, pa.float64()) for v in (*sums, sums[0] - sums[1])]],
                                names=["doc_id", "n_words", "target_loss", "background_loss", "score"]))
        return pa.concat_tables(out) if out else pa.table(
            {c: pa.array([], t) for c, t in (("doc_id", pa.int64()), ("n_words", pa.int64()), (
                "target_loss", pa.float64()), ("background_loss", pa.float64()), ("score", pa.float64()))})
    return run


def score_all(docs: DataFrame, target_ids: DataFrame, part: int = PART) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss (means per word), score of every row of ``docs(doc_id, text)``.

    Target: the documents of ``target_ids(doc_id)``; background: all. No word or bigram is left out.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part))

    def dealt(key):
        return F.pmod(key, F.lit(parts)).alias("chunk")

    own = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    own = own.select(dealt(F.coalesce(F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")), F.xxhash64("text"))),
                     "doc_id", "text").groupBy("chunk")
    target = (target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
              .select(dealt(F.xxhash64("doc_id")), "doc_id").groupBy("chunk"))
    asked = own.cogroup(target).applyInArrow(_ask(parts), "chunk long, bucket long, keys binary, counts binary")
    answers = materialize(asked.groupBy("bucket").applyInArrow(
        _answer, "chunk long, bucket long, n long, counts binary, stats array<long>"), "lm-answers")
    stats = (answers.where(F.col("chunk") == _STATS)
             .agg(*[F.sum(F.col("stats")[i]) for i in range(3)]).first())
    distinct, *totals = (x or 0 for x in stats)
    replies = answers.where(F.col("chunk") != _STATS).select("chunk", "bucket", "n", "counts").groupBy("chunk")
    return own.cogroup(replies).applyInArrow(
        _score(distinct, tuple(totals)),
        "doc_id long, n_words long, target_loss double, background_loss double, score double")
