"""Op 9: ids against the tokenizer, pieces and sequences, awkward rows."""

import random
import zlib

import numpy as np
import odd
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from histwright.llm import packing, units

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER, WHOLE = packing.Encoder(PATH), Tokenizer.from_file(PATH)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB'sé漢.,!% \n\t  12<|>_ñ\U0001f600", max_size=30))
def test_word_cache_equals_whole_encoding(text):
    assert ENCODER(text) == packing.id_bytes(ids(text))


def test_special_cases_equal_whole_encoding():
    for text in ("it's we'll x's", "a <|endoftext|> b", "x<|endoftext|>", "don't, stop!!", " lead", "trail ", "a\n\nb",
                 "a b\nc d", "ﬁ ½ Ⅷ x²", "é combining", "a b c", "a\x1cb c", "a_b c_d 3.5 1,000",
                 " \n  x  y\n", "a\u2003 b\u3000\nc", "\u0e01\u0e33 \u0915\u094d\u0937 x", "x" * 9000, "\n\n", " "):
        assert ENCODER(text) == packing.id_bytes(ids(text)), text


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(units, "REMEMBER", 3)
    small = packing.Encoder(PATH)
    text = " ".join(f"word{i % 11} again" for i in range(50))
    assert small(text) == packing.id_bytes(ids(text)) == small(text)


def test_assignment_fills_and_balances():
    rnd = random.Random(1)
    lengths = [rnd.choice([1, 5, 60, 300, 900, 1024, 1025, 5000]) for _ in range(800)]
    pieces = packing.assign(lengths, 1024)
    done, filled, cost = [0] * len(lengths), {}, {}
    for d, start, n, s, off in pieces:
        assert start == done[d] and n > 0 and off == filled.get(s, 0)
        done[d] += n
        filled[s] = off + n
        cost[s] = cost.get(s, 0) + n + n * n / 256
    assert done == lengths
    size = packing.sizes(sum(lengths), 1024)
    assert sum(size) == sum(lengths) and [filled[s] for s in range(len(size))] == size
    assert all(n == 1024 or n & (n - 1) == 0 for n in size)
    # Against filling in order of arrival, the costs spread less.
    naive, at = [0.0] * len(size), 0
    for n in lengths:
        while n:
            k = min(n, 1024 - at % 1024)
            naive[min(at // 1024, len(size) - 1)] += k + k * k / 256
            at, n = at + k, n - k
    whole = [cost[s] for s, z in enumerate(size) if z == 1024]
    assert np.std(whole) <= np.std(naive[:len(whole)])
    assert packing.assign([], 1024) == []


def test_pieces_give_back_every_document(spark):
    docs = odd.table(spark)
    got = packing.pack(docs, buffer_tokens=5000).collect()
    texts = sorted((repr((r[0], len(ids(r[1])) + 1)) for r in odd.rows()))
    starts = sorted(repr((r.doc_id, r.doc_tokens)) for r in got if r.start == 0)
    assert starts == texts
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
    for pieces in by_sequence.values():
        at = 0
        for off, n, _ in sorted(pieces):
            assert off == at
            at += n
        assert at <= 1024 and at == pieces[0][2]
    long = sorted((r for r in got if r.doc_id == 9), key=lambda r: r.start)
    tokens = np.array([*ids(odd.LONG), 0], "<u4")
    at = 0
    for r in long:
        assert r.start == at and r.ids_crc32 == zlib.crc32(tokens[at:at + r.length].tobytes())
        at += r.length
    assert at == len(tokens)
    assert packing.pack(odd.none(spark)).count() == 0


def test_assignment_takes_the_cheapest_with_room():
    rnd = random.Random(4)
    # Some hundred sequences, of which more than 64 of one size class lack room for a piece.
    for spread in ((200, 560), (100, 900), (1, 3000)):
        lengths = [rnd.randint(*spread) for _ in range(1200)]
        size = packing.sizes(sum(lengths), 1024)
        room, cost, blocked = list(size), [0.0] * len(size), 0
        for d, start, n, s, _ in packing.assign(lengths, 1024):
            need = min(lengths[d] - start, 1024)
            fits = [x for x in range(len(size)) if room[x] >= need]
            assert s == min(fits or [x for x in range(len(size)) if room[x]], key=lambda x: (cost[x], x))
            blocked = max(blocked, sum(need.bit_length() == room[x].bit_length() and room[x] < need
                                       for x in range(len(size))))
            room[s] -= n
            cost[s] += n + n * n / 256
        assert blocked > 64 or spread[0] == 1
