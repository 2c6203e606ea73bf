"""Format-preserving pseudonyms by keyed Feistel permutations.

A value found in a text is validated (Luhn for cards, modulo 97 for IBANs, calendar for
dates, ranges for addresses and numbers), ranked as a whole number within all valid values of its
format, permuted there by a keyed Feistel network with cycle walking, and written
back in its own format. So the pseudonym is valid again, spaces and separators stay, the mapping can be undone
with the key, and equal values get equal pseudonyms in every document, however they are
punctuated (mail names: in whatever case). Names before an ``@`` and key-like secrets are permuted letter for letter in their classes.

Every pattern starts at a border and reads its run once, and long names and secrets are permuted in blocks of
``BLOCK`` characters, so a text of one unbroken run of any length takes linear time.

One scan with no shuffle; texts without digits or marks of a value skip the search.

Defined results: a NULL text stays NULL, an empty one empty, a text without valid values is
returned unchanged; repeated rows get equal results; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

ROUNDS = 8
#: A stand-in for tests and the registered query; real runs pass their own secret.
TEST_KEY = b"not-a-secret-test-key"
_DAY0, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # 1900-01-01 to 2099-12-31


@dataclass(frozen=True)
class Feistel:
    """A keyed permutation of 0..size-1 for every size; ``kind`` separates formats."""
    key: bytes

    def _round(self, kind: str, size: int, i: int, half: int, x: int) -> int:
        text = f"{kind}|{size}|{i}|{x}".encode()
        n = (half + 7) // 8 + 8
        out = b""
        while len(out) < n:
            out += hashlib.blake2b(text + b"|%d" % len(out), key=self.key[:64], digest_size=64).digest()
        return int.from_bytes(out[:n], "big") & ((1 << half) - 1)

    def _once(self, kind: str, size: int, x: int, back: bool) -> int:
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        a, b = x >> half, x & ((1 << half) - 1)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                a, b = b ^ self._round(kind, size, i, half, a), a
            else:
                a, b = b, a ^ self._round(kind, size, i, half, b)
        return a << half | b

    def permute(self, kind: str, size: int, x: int, back: bool = False) -> int:
        while True:  # cycle walking: the walk from a valid number ends at a valid number
            x = self._once(kind, size, x, back)
            if x < size:
                return x


Permute = Callable[[str, int, int], int]


def luhn_digit(digits: str) -> str:
    """The check digit that completes ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _fill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    left = iter(digits)
    return re.sub(r"\d", lambda _: next(left), shape)


#: Characters permuted as one whole number; longer values are permuted in blocks of so many.
BLOCK = 256


def _classes(text: str, p: Permute, kind: str, fold: bool = False) -> str:
    """Letters and digits permuted within their classes, all else in place; block by block, so any length
    takes linear time. ``fold``: letters that differ in case alone get the same letters, in their own case."""
    blocks = [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]
    return "".join(_block(b, p, kind if not i else f"{kind}:{i}", fold) for i, b in enumerate(blocks))


def _block(text: str, p: Permute, kind: str, fold: bool) -> str:
    radix = [10 if c in "0123456789" else 26 if "a" <= c <= "z" or "A" <= c <= "Z" else 1 for c in text]
    size, x = 1, 0
    for c, r in zip(text, radix):
        size *= r
        x = x * r + (int(c) if r == 10 else (ord(c) | 32) - 97 if r == 26 else 0)
    shape = "".join("0" if r == 10 else "a" if c.islower() or fold and r == 26 else "A" if r == 26 else c
                    for c, r in zip(text, radix))
    x = p(f"{kind}:{shape}", size, x)
    out = []
    for c, r in zip(reversed(text), reversed(radix)):
        x, d = divmod(x, r)
        out.append(str(d) if r == 10 else chr(d + (97 if c.islower() else 65)) if r == 26 else c)
    return "".join(reversed(out))


def card(m: str, p: Permute) -> str | None:
    d = re.sub(r"\D", "", m)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    n = len(d) - 2  # the first digit names the network and stays
    body = d[0] + str(p(f"card:{d[0]}", 10 ** n, int(d[1:-1]))).zfill(n)
    return _fill(m, body + luhn_digit(body))


def phone(m: str, p: Permute) -> str | None:
    d = re.sub(r"\D", "", m)
    if m.startswith("+"):
        land, own = d[:-10], d[-10:]
        if not land or len(land) > 3:
            return None
    else:
        land, own = "", d
    return _fill(m, land + str(p("phone", 10 ** 10, int(own))).zfill(10))


def ssn(m: str, p: Permute) -> str | None:
    a, g, s = map(int, m.split("-"))
    if a in (0, 666) or a >= 900 or not g or not s:
        return None
    x = p("ssn", 898 * 99 * 9999, ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1)
    x, s = divmod(x, 9999)
    a, g = divmod(x, 99)
    a += 1 + (a >= 665)
    return f"{a:03d}-{g + 1:02d}-{s + 1:04d}"


def address(m: str, p: Permute) -> str | None:
    parts = m.split(".")
    if any(int(x) > 255 or x != str(int(x)) for x in parts):
        return None
    x = 0
    for part in parts:
        x = x << 8 | int(part)
    x = p("ip", 1 << 32, x)
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


def iban(m: str, p: Permute) -> str | None:
    s = m.replace(" ", "")

    def number(t: str) -> int:
        return int("".join(str(int(c, 36)) for c in t))

    if not 15 <= len(s) <= 34 or number(s[4:] + s[:4]) % 97 != 1:
        return None
    body = _classes(s[4:], p, f"iban:{s[:2]}")
    check = f"{98 - number(body + s[:2] + '00') % 97:02d}"
    out = iter(s[:2] + check + body)
    return "".join(c if c == " " else next(out) for c in m)


#: How each date format is read: (year, month, day) groups.
_DATES = {"-": (0, 1, 2), ".": (2, 1, 0), "/": (2, 0, 1)}


def date(m: str, p: Permute) -> str | None:
    sep = next(c for c in m if c in _DATES)
    parts = m.split(sep)
    y, mo, d = (parts[i] for i in _DATES[sep])
    try:
        x = datetime.date(int(y), int(mo), int(d)).toordinal() - _DAY0
    except ValueError:
        return None
    if not 0 <= x < _DAYS:
        return None
    new = datetime.date.fromordinal(p("date", _DAYS, x) + _DAY0)
    out = [""] * 3
    for i, t in zip(_DATES[sep], (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")):
        out[i] = t
    return sep.join(out)


def email(m: str, p: Permute) -> str | None:
    local, _, domain = m.partition("@")
    return f"{_classes(local, p, f'email:{domain.lower()}', fold=True)}@{domain}"


def secret(m: str, p: Permute) -> str | None:
    head = re.match(r"AKIA|[A-Za-z_]+\s*[=:]\s*[\"']?", m)[0]
    return head + _classes(m[len(head):], p, "secret")


FORMATS: dict[str, tuple[str, Callable[[str, Permute], str | None]]] = {
    # It starts where its run of characters starts, and gives none back: a long run is read once.
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", email),
    "secret": (r"\bAKIA[0-9A-Z]{16}\b|\b(?:password|passwd|secret|token|api_key)\s*[=:]\s*[\"']?[A-Za-z0-9+/_-]{8,}",
               secret),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b", iban),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ssn),
    "date": (r"(?<![\d.-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d-])", date),
    "phone": (r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
              r"|(?<![\w+(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w+.-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d)", phone),
    "card": (r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])", card),
    "ip": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)", address),
}
_ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, (pattern, _) in FORMATS.items()))
#: Texts without a match of this hold no value of any format.
_HINT = r"[0-9@]|AKIA|(?:password|passwd|secret|token|api_key)\s*[=:]"


def pseudonymize(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with every valid value replaced, and how many there were of each kind."""
    network, kinds = Feistel(key), {}

    def permute(kind: str, size: int, x: int) -> int:
        return network.permute(kind, size, x, back)

    def replace(m: re.Match) -> str:
        new = FORMATS[m.lastgroup][1](m[0], permute)
        if new is None:
            return m[0]
        kinds[m.lastgroup] = kinds.get(m.lastgroup, 0) + 1
        return new

    return _ANY.sub(replace, text), kinds


def pseudonyms(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """doc_id, text, n_replaced, kinds (as ``kind:count`` in order of name) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            hint = pc.fill_null(pc.match_substring_regex(column, _HINT), False).to_pylist()
            texts, counts, kinds = [], [], []
            for i, h in enumerate(hint):
                text = column[i].as_py()
                found: dict[str, int] = {}
                if h:
                    text, found = pseudonymize(text, key, back)
                texts.append(text)
                counts.append(sum(found.values()))
                kinds.append(",".join(f"{k}:{n}" for k, n in sorted(found.items())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(kinds, pa.string())], ["doc_id", "text", "n_replaced", "kinds"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, text string, n_replaced long, kinds string")
