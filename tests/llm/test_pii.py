"""Op 5: permutations, validity, links between documents, the way back, awkward rows."""

import datetime

import odd
from hypothesis import given, settings, strategies as st

from histwright.llm import pii

KEY = b"test"


def test_feistel_is_a_permutation():
    f = pii.Feistel(KEY)
    for size in (1, 2, 3, 10, 97, 1000):
        assert sorted(f.permute("k", size, x) for x in range(size)) == list(range(size))
    assert f.permute("k", 10**9, 5) != pii.Feistel(b"other").permute("k", 10**9, 5)
    assert f.permute("k", 10**9, 5) != f.permute("m", 10**9, 5)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 10**40), st.data())
def test_feistel_goes_back(size, data):
    x = data.draw(st.integers(0, size - 1))
    f = pii.Feistel(KEY)
    y = f.permute("k", size, x)
    assert 0 <= y < size and f.permute("k", size, y, back=True) == x


TEXT = ("card 4337 1665-9846 4399 and 4337166598464399, tel +1 (988) 555-2485 or (988) 555-2485, host 10.2.3.4, "
        "born 2021-02-28 or 28.02.2021 or 02/28/2021, ssn 123-45-6789, account DE89 3704 0044 0532 0130 00 or "
        "DE89370400440532013000, mail bosbt.42@mail8.example.com")


def test_values_stay_valid_linked_and_reversible():
    new, kinds = pii.pseudonymize(TEXT, KEY)
    assert kinds == {"card": 2, "phone": 2, "ip": 1, "date": 3, "ssn": 1, "iban": 2, "email": 1}
    assert pii.pseudonymize(new, KEY, back=True)[0] == TEXT
    for secret in ("4337 1665-9846 4399", "555-2485", "10.2.3.4", "2021-02-28", "123-45-6789", "0532 0130", "bosbt"):
        assert secret not in new
    words = new.split()
    card = new[5:24]
    assert card[4] == " " and card[9] == "-" and card.replace(" ", "").replace("-", "") == words[5].strip(",")
    assert pii.luhn_digit(words[5].strip(",")[:-1]) == words[5].strip(",")[-1]
    iso, dot, us = (words[words.index("born") + i] for i in (1, 3, 5))
    d = datetime.date.fromisoformat(iso)
    assert dot == d.strftime("%d.%m.%Y") and us.strip(",") == d.strftime("%m/%d/%Y")


def test_invalid_values_stay():
    text = "1234567812345678 256.1.1.1 1.2.3.4.5 30.02.2021 000-12-3456 DE00370400440532013000 version 4.0 19881-55"
    assert pii.pseudonymize(text, KEY) == (text, {})


def test_awkward_rows(spark):
    got = pii.pseudonyms(odd.table(spark), KEY).collect()
    key = lambda x: repr(x)
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == sorted(((r[0], r[1]) for r in odd.rows()), key=key)
    assert {r.n_replaced for r in got} == {0}
    assert pii.pseudonyms(odd.none(spark), KEY).count() == 0
    two = spark.createDataFrame([(1, "call +1 (988) 555-2485"), (2, "+1 988.555.2485 again"), (3, None)],
                                "doc_id long, text string").repartition(3)
    a, b, c = (r.text for r in pii.pseudonyms(two, KEY).orderBy("doc_id").collect())
    digits = lambda s: "".join(x for x in s if x.isdigit())
    assert digits(a) == digits(b) and c is None
    back = pii.pseudonyms(pii.pseudonyms(two, KEY), KEY, back=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == ["call +1 (988) 555-2485", "+1 988.555.2485 again", None]


def test_long_unbroken_texts_take_linear_time():
    """A run ten times as long takes about ten times as long, whatever it is made of."""
    import time

    for run in ("a", "1", "12.34+", "a+", "a.", "1-", "A1b2", "secret=" + "x" * 50 + "/", "a@b.", "é"):
        took = []
        for n in (60_000, 600_000):
            text = (run * (n // len(run)))[:n] + " 1"
            began = time.perf_counter()
            pii.pseudonymize(text, KEY)
            took.append(time.perf_counter() - began)
        assert took[1] < 30 * took[0] + 0.5, (run, took)


def test_long_values_go_in_blocks_and_back():
    long = "Ab3" * 700
    for text in (f"{long}@example.com end", f"password = {long}", f"x {long}.{long}@mail.example.org"):
        new, kinds = pii.pseudonymize(text, KEY)
        assert sum(kinds.values()) == 1 and new != text and len(new) == len(text)
        assert pii.pseudonymize(new, KEY, back=True)[0] == text


def test_mail_names_are_linked_whatever_their_case():
    a, b, c = (pii.pseudonymize(f"{x}@Example.com", KEY)[0] for x in ("bob.Smith7", "BOB.SMITH7", "bob.smith8"))
    assert a.lower() == b.lower() != c.lower() and a != "bob.Smith7@Example.com"
    assert [x.isupper() for x in a[:9]] == [x.isupper() for x in "bob.Smith"]


def expected_digits(digits, kind, back=False):
    """A permutation of 10**n written without the library: the same network, spelled out on one number."""
    import hashlib

    size, x = 10 ** len(digits), int(digits)
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = divmod(x, 1 << half)
        for i in range(8):
            need, out = (half + 7) // 8 + 8, b""
            while len(out) < need:
                out += hashlib.blake2b(f"{kind}|{size}|{i}|{right}|{len(out)}".encode(), key=KEY, digest_size=64).digest()
            left, right = right, left ^ (int.from_bytes(out[:need], "big") & mask)
        x = (left << half) + right
        if x < size:
            return str(x).zfill(len(digits))


def test_expected_texts():
    new, _ = pii.pseudonymize("call (988) 555-2485 now, card 4337166598464399", KEY)
    tel, middle = expected_digits("9885552485", "phone"), expected_digits("33716659846439", "card:4")
    card = "4" + middle
    assert new == f"call ({tel[:3]}) {tel[3:6]}-{tel[6:]} now, card {card}{pii.luhn_digit(card)}"
