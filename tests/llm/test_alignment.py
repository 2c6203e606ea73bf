"""Op 11: alignment and scores against a plain version on whole texts; bitmaps and planes; awkward rows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import odd
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from histwright.llm import alignment, units

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
A.encode_special_tokens = True
CHARS = {c: b for c, b in units.byte_alphabet().items()}


def tokens(text):
    """[(id, bytes)] of both sides, or None."""
    if not text:
        return None
    a = [(i, bytes(CHARS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        p = B.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else None


def plain(rows):
    """Per row (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest), by the definitions alone."""
    made, holders = [], defaultdict(set)
    for n, (doc_id, text) in enumerate(rows):
        got = tokens(text)
        if got is None:
            made.append((doc_id, 0, 0, 0, Counter(), ""))
            continue
        spans, ends = [], []
        for side in got:
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
            ends.append({e for _, e, _ in out})
        links = Counter((i, j) for s, e, i in spans[0] for t, f, j in spans[1] if max(s, t) < min(e, f))
        for pair in links:
            holders[pair].add(n)
        groups, start = [], 0
        for cut in sorted(ends[0] & ends[1]):
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s < cut) for side in spans))
            start = cut
        made.append((doc_id, len(got[0]), len(got[1]), len(groups), links,
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (i, _), docs in holders.items():
        top[i] = max(top[i], len(docs))
    return sorted(((d, a, b, g, sum(k.values()), sum(c for p, c in k.items() if len(holders[p]) == top[p[0]]),
                    sum(c * len(holders[p]) for p, c in k.items()), h) for d, a, b, g, k, h in made), key=repr)


def found(df):
    cols = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


EXTRA = ["it's we'll <s> </s> <unk> <|endoftext|> <0x41>", "a▁b plain", "  two  spaces \n\n and\ttabs ", "a\r\nb {\r\n}",
         "ends in space ", "\x00 nul", "ﬁ ½ é ñ 　 wide  x", "漢字 かな 한글 ไทย", "\n", " ", "x" * 3000,
         "the cat the cat the cat sat", "the cat sat", "The CAT sat!", "1,000.50 + 3"]


def test_scores_equal_plain_version(spark):
    short = [(d, t[:3000] if t else t) for d, t, *_ in odd.rows()]  # the plain version compares all pairs of tokens
    rows = short + [(100 + i, t) for i, t in enumerate(EXTRA)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = plain(rows)
    assert sum(r[1] > 0 for r in expected) > 15 and any(r[1] == 0 and r[0] == 101 for r in expected)
    assert found(alignment.align(docs)) == expected
    # Any size of block gives the same.
    assert found(alignment.align(docs, block_docs=2, block_entries=10)) == expected


def test_whole_texts_equal_units(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(EXTRA)]
    raw = [(" " + t).encode() if t else b"" for _, t in rows]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    by_units, whole = alignment.Aligner(PATH_A, PATH_B), alignment.Aligner(PATH_A, PATH_B)
    whole.cuts = False
    monkeypatch.setattr(alignment, "REMEMBER", 4)  # forgets before the second chunk
    for _ in range(2):
        for x, y in zip(by_units(data, offs), whole(data, offs)):
            assert np.array_equal(x, y)


def test_awkward_tables(spark):
    got = alignment.align(odd.table(spark))
    assert got.count() == len(odd.rows())
    long = got.where("doc_id = 9").first()
    assert (long.n_a, long.n_b) == tuple(len(x) for x in tokens(odd.LONG))
    empty = got.where("doc_id in (4, 5)").collect()
    assert [(r.n_a, r.n_links, r.count_sum, r.groups_sha256) for r in empty] == [(0, 0, 0, "")] * 2
    assert alignment.align(odd.none(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 300), min_size=1, max_size=40), min_size=1, max_size=8))
def test_planes_give_back_the_links(rows):
    n = np.array([len(r) for r in rows])
    links = np.array([x for r in rows for x in r])
    data, size = alignment.plane_bits(links, n)
    assert len(data) == size.sum()
    assert alignment.plane_links(data, size, n).tolist() == links.tolist()


def test_hot_pair_has_one_row_per_block(spark):
    """A pair in all documents: its bitmap is plain bits, and no row grows beyond a block."""
    docs = spark.range(4000).selectExpr("id as doc_id", "'same words here' as text").coalesce(1)
    rows = alignment.invert(docs, block_docs=1000)
    posted = rows.where("kind = 2").collect()
    assert {len(r.bitmap) for r in posted} == {125} and {r.n for r in posted} == {1000}
    got = alignment.align(docs, block_docs=1000)
    assert {r.count_sum for r in got.collect()} == {4000 * got.first().n_links}
