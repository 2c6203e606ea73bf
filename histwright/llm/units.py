"""Tokenising texts by their distinct units (a word with the white space before it).

A text is cut before every space or newline whose previous character is not white
space. The byte-level BPE splits there by its pattern, whatever follows, and a piece
vocabulary without an inner word start never merges across, so the ids of a text are the ids
of its units in order. Each distinct unit is tokenised once and remembered; new ones go to
the tokenizer many at a time, joined to a text that is cut at the same places.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa

#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of units joined for one call.
JOIN_BYTES = 4096
#: Distinct units, and bytes of them, that a worker remembers before it starts anew.
REMEMBER, REMEMBER_BYTES = 250_000, 8 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def _after_wide_blank(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is white space of two or three bytes (or may be)."""
    a, b, c = raw[at - 1], raw[at - 2], raw[at - 3]
    two = (b == 0xC2) & ((a == 0x85) | (a == 0xA0))
    general = (c == 0xE2) & (b == 0x80) & ((a <= 0x8A) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF))
    rest = ((c == 0xE1) & (b == 0x9A)) | ((c == 0xE2) & (b == 0x81)) | ((c == 0xE3) & (b == 0x80) & (a == 0x80))
    return two | general | rest


def split(raw: np.ndarray, offs: np.ndarray, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(unit bounds, each document's first unit) of a chunk; ``whole`` keeps every text as one unit."""
    cut = np.zeros(len(raw) + 1, bool)
    cut[offs[:-1]] = True
    if not whole:
        at = np.flatnonzero((raw == 32) | (raw == 10))
        at = at[at > 0]
        at = at[~_BLANK[raw[at - 1]]]
        wide = raw[at - 1] >= 0x80
        if wide.any():
            at = at[~(wide & _after_wide_blank(raw, at))]
        cut[at] = True
    cut[-1] = True
    bounds = np.flatnonzero(cut)
    return bounds, np.searchsorted(bounds, offs)


def distinct(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each unit's bytes, distinct bytes); exact, on the bytes themselves."""
    data = pa.py_buffer(np.ascontiguousarray(raw))
    units = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), data])
    found = units.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.to_pylist()


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet by rule: printable Latin-1 characters stand for their byte, the other
    bytes take the code points from 256 on, in order."""
    own = {b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)}
    rest = iter(range(256, 512))
    return {chr(b) if b in own else chr(next(rest)): b for b in range(256)}


def joined(units: list[str], sizes: list[int]) -> tuple[list[str], np.ndarray]:
    """Texts of ``x`` and some units each, and their number of units; a unit that ends in white space ends its text."""
    ends = np.cumsum(sizes) // JOIN_BYTES
    stop = {*(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(units)}
    stop.update(i for i, u in enumerate(units, 1) if u[-1] <= " " or u[-1] > "~" and u[-1].isspace())
    stops = [0, *sorted(stop)]
    return ["x" + "".join(units[a:b]) for a, b in zip(stops, stops[1:])], np.diff(stops)


class ByteLevel:
    """Ids by a byte-level BPE file; ``special``: its special tokens' strings are those tokens."""

    def __init__(self, path: str, special: bool):
        self.path, self.keep_special = path, special
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        self.special = [t["content"] for t in spec["added_tokens"]] if special else []
        alphabet = byte_alphabet()
        added = {t["content"] for t in spec["added_tokens"]}
        table = {t: t.encode() if t in added else bytes(alphabet.get(c, 63) for c in t)
                 for t in model["vocab"]} | {t: t.encode() for t in added}
        numbers = model["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (max(numbers.values()) + 1)
        for t, i in numbers.items():
            self.bytes[i] = table[t]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        #: Whether texts may be cut into units.
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not before.get("add_prefix_space") and not spec["normalizer"]
                     and not spec["post_processor"]
                     and not any(t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]))
        self.ranked = self._ranks(model, added, numbers) if self.cuts else None

    @functools.cached_property
    def tokenizer(self):
        """The tokenizer itself; read only when a unit needs it, as most go by rank."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        found = Tokenizer.from_file(self.path)
        found.encode_special_tokens = not self.keep_special
        return found

    def _ranks(self, model: dict, added: set, numbers: dict):
        """The same vocabulary merged by rank, if its ids stand in the order of its merges."""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [numbers.get(a + b, -1) for a, b in merges]
        if any(x >= y for x, y in zip(made, made[1:])) or min(made, default=0) < 256:
            return None
        import tiktoken
        return tiktoken.Encoding("vocabulary", pat_str=PATTERN, special_tokens={},
                                 mergeable_ranks={self.bytes[i]: i for t, i in model["vocab"].items()
                                                  if t not in added})

    def plain(self, units: list[str]) -> list[int]:
        """The units that are merged by rank: no special token, and only characters whose class has long been settled."""
        if self.ranked is None:
            return []
        found = [i for i, u in enumerate(units) if u.isascii() or max(u) < "\u0800"]
        for t in self.special:
            if t in "".join(units):
                found = [i for i in found if t not in units[i]]
        return found

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text, by the tokenizer itself."""
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each unit)."""
        words = [u.decode() for u in units]
        ranked = self.plain(words)
        plain = [i for i in ranked if words[i][0] in " \n"]  # these may be joined
        own = np.ones(len(units), bool)
        own[plain] = False
        other = np.flatnonzero(own).tolist()
        count = np.zeros(len(units), np.int64)
        ids = np.empty(0, np.uint32)
        if plain:
            size = [len(units[i]) for i in plain]
            texts, _ = joined([words[i] for i in plain], size)
            ids = np.concatenate([self.ranked.encode_to_numpy(t, disallowed_special=())[1:] for t in texts])
            ends = np.cumsum(size)
            at = np.cumsum(self.lengths[ids])
            stop = np.searchsorted(at, ends)
            if not np.array_equal(at[stop], ends):
                raise ValueError("a token crosses the end of a unit")
            count[plain] = np.diff(np.concatenate([[0], stop + 1]))
        if not other:
            return ids.astype(np.uint32), count
        alone = set(ranked)
        whole = [i for i in other if i not in alone]
        by_tokenizer = dict(zip(whole, self.texts([words[i] for i in whole]))) if whole else {}
        found = [self.ranked.encode_to_numpy(words[i], disallowed_special=()) if i in alone else by_tokenizer[i]
                 for i in other]
        count[other] = [len(x) for x in found]
        out, to = np.empty(count.sum(), np.uint32), np.concatenate([[0], np.cumsum(count)])
        out[np.repeat(~own, count)] = ids
        for i, x in zip(other, found):
            out[to[i]:to[i + 1]] = x
        return out, count


class Growing:
    """A numpy array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1 << 12, dtype), 0

    def extend(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.data):
            data = np.empty(max(2 * len(self.data), self.n + len(x)), self.data.dtype)
            data[:self.n] = self.data[:self.n]
            self.data = data
        self.data[self.n:self.n + len(x)] = x
        self.n += len(x)

    def view(self) -> np.ndarray:
        return self.data[:self.n]


def gather(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + count]`` one after the other."""
    before = np.cumsum(count) - count
    return values[np.repeat(start - before, count) + np.arange(int(count.sum()))]


class UnitIds:
    """Ids of whole texts by their remembered units."""

    def __init__(self, path: str):
        self.tokenizer = ByteLevel(path, special=True)
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.start, self.count, self.held = Growing(np.uint32), Growing(np.int64), Growing(np.int64), 0

    def __call__(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, each document's first id) of a chunk."""
        if len(self.number) > REMEMBER or self.held > REMEMBER_BYTES:
            self._clear()
        bounds, first = split(raw, offs, whole=not self.tokenizer.cuts)
        index, words = distinct(raw, bounds)
        number = self.number
        new = [w for w in words if w not in number]
        if new:
            ids, count = self.tokenizer.units(new)
            self.start.extend(self.ids.n + np.cumsum(count) - count)
            self.count.extend(count)
            self.ids.extend(ids)
            self.held += sum(map(len, new))
            number.update(zip(new, range(len(number), len(number) + len(new))))
        unit = np.array([number[w] for w in words], np.int64)[index]
        count = self.count.view()[unit]
        until = np.concatenate([[0], np.cumsum(count)])
        return gather(self.ids.view(), self.start.view()[unit], count), until[first]


@functools.lru_cache(maxsize=1)
def shared_ids(path: str) -> UnitIds:
    """One for all tasks of a Python worker, so they share what it remembers."""
    return UnitIds(path)


def inner_word_start(pieces: list[str]) -> bool:
    """Whether a piece goes on with a space or newline after another character."""
    return any(re.search("[^▁\\s][▁ \n]", p) for p in pieces)
