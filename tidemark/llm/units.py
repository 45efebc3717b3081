"""Texts cut into units that a tokenizer encodes independently.

A tokenizer first cuts a text into pre-tokens and encodes each alone, so the
ids of a unit that begins and ends at pre-token borders do not depend on its
neighbours and can be remembered. Units are "words" with their blank:

* byte-level BPE keeps one blank in front of a word. A unit is a word with the
  blank before it, or, at the start of a line or text, without. That holds
  for texts whose white space is single blanks and line breaks between words;
  any other text is cut only before a blank that a visible character follows.
* word BPE drops white space: a unit is what stands between blanks and line breaks.

Special strings of the tokenizer inside a text are cut out first and encoded
as the library does by default.

A unit of letters a-z, A-Z and of Latin-1 is one pre-token whatever stands around
it, and signs after such letters are another, so these go to the library's
BPE model without the normaliser and the pre-tokenizer.

Many texts at a time (``Encoder.encode_all``): the bytes of texts of plain blanks
are cut into units, blank included, by numpy, an Arrow dictionary leaves each unit
once, and words of letters go to the BPE model by the hundred, with a letter between
them that merges with nothing.
"""

from __future__ import annotations

import functools
import re
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.models import BPE

#: words remembered by a worker in one generation; of full ones, the latest is kept
MEMORY = 400_000
_ODD_BYTES = bytes([9, 11, 12, 13, 28, 29, 30, 31])
_ODD = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
_BEFORE_WORD = re.compile(r"(?= \S)")
_IDLE_END = ".,"
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"  # composed letters: NFC and lower case leave their number alone
#: letter between words of one call of the model: no text in UTF-8 has this byte
_BETWEEN = chr(255)
#: words of one call of the model
_TOGETHER = 100
#: bytes of texts that are cut together, and texts whose ids are put together
SLICE = 48 << 20
_GATHERED = 250
#: such letters, and marks that are no part of a contraction ('s)
_LETTERS = re.compile(f"([{_LATIN}]+)([!-&(-/:-@\\[-`{{-~]*)")


def plain_blanks(text: str) -> bool:
    """Whether all white space is single blanks or line breaks between words."""
    if not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return False
    raw = text.encode("utf-8")
    return len(raw.translate(None, _ODD_BYTES)) == len(raw) and not any(o in raw for o in _ODD)


def units(text: str) -> tuple[list[str], list[str]]:
    """(units without a blank before them, units whose blank was taken off)."""
    if plain_blanks(text):
        bare, spaced = [], []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            bare.append(first)
            spaced += rest
        bare += ["\n"] * (len(bare) - 1)
        return bare, spaced
    parts = [p for p in _BEFORE_WORD.split(text) if p]
    return [p for p in parts if p[0] != " " or len(p) < 2 or p[1].isspace()], \
        [p[1:] for p in parts if p[0] == " " and len(p) > 1 and not p[1].isspace()]


def _byte_letters() -> dict[int, int]:
    """The letter by which byte-level tokenizers write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


_AS_LETTERS = _byte_letters()
_LETTER_OF = np.array([_AS_LETTERS[b] for b in range(256)], "<u2")
_BYTES = np.arange(256)
_IS_SIGN = np.array([bool(_LETTERS.fullmatch("a" + chr(b))) and not chr(b).isalpha() for b in range(256)])
_IS_ODD = np.isin(_BYTES, list(_ODD_BYTES))
_ODD_PAIRS = [o[0] << 8 | o[1] for o in _ODD]
_MAY_BE_ODD = _IS_ODD | np.isin(_BYTES, [o[0] for o in _ODD])
_IS_ASCII_LETTER = (_BYTES | 32 >= 97) & (_BYTES | 32 <= 122) & (_BYTES < 128)
#: bytes of ``_LATIN`` letters, which are no other letter's if all of a word are such
_IS_LETTER = _IS_ASCII_LETTER | np.isin(_BYTES, list(re.sub("[^" + _LATIN + "]", "", "".join(map(chr, range(192, 256)))).encode("utf-8")))


class _Ids(dict):
    """unit -> little-endian 32-bit ids, encoded on first sight."""

    def __init__(self, tokenizer: Tokenizer, before: str, model, lower: bool):
        super().__init__()
        self.tokenizer, self.before, self.model, self.lower = tokenizer, before, model, lower
        self.first = before.translate(_AS_LETTERS)
        self.old: dict[str, bytes] = {}
        self.end = {c: self.encode(c) for c in _IDLE_END}
        self.signs: dict[str, bytes] = {}

    def next_generation(self):
        self.old = dict(self)
        self.clear()
        self.signs.clear()

    def encode(self, unit: str) -> bytes:
        return np.array(self.tokenizer.encode(unit, add_special_tokens=False).ids, "<u4").tobytes()

    def letters(self, word: str) -> bytes:
        """Ids of one pre-token of letters."""
        if not word.isascii():
            word = word.encode("utf-8").decode("latin-1").translate(_AS_LETTERS)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(self.first + word)])

    def __missing__(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            m = self.model and _LETTERS.fullmatch(unit)
            if m:
                word, signs = m.groups()
                if signs:
                    ids = self.signs.get(signs)
                    if ids is None:
                        ids = self.signs[signs] = self.encode(signs)
                    ids = self[word] + ids
                elif self.lower and (low := word.lower()) != word:
                    ids = self[low]
                else:
                    ids = self.letters(word)
            # a full stop or comma after a letter is a pre-token of its own, unless
            # the letter is normalised into one and a mark (İ)
            elif unit[-1:] in self.end and (normalize("NFC", unit[-2:-1]).lower()[-1:] if self.lower else unit[-2:-1]).isalpha():
                ids = self[unit[:-1]] + self.end[unit[-1]]
            else:
                ids = self.encode(self.before + unit)
        self[unit] = ids
        return ids


class Encoder:
    """Ids of whole texts by a ``.json`` tokenizer of the ``tokenizers`` library."""

    def __init__(self, path: str):
        self.tokenizer = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        added = t.get_added_tokens_decoder().values()
        exact = all(not (a.lstrip or a.rstrip or a.single_word or a.normalized) for a in added)
        kind = repr(t.pre_tokenizer)
        self.byte_level = kind.startswith("ByteLevel(add_prefix_space=False") and t.normalizer is None
        self.word_level = "behavior=Removed, invert=True" in kind and "ByteLevel(add_prefix_space=False" in kind
        if not exact or not (self.byte_level or self.word_level) or any(re.search(r"\s", a.content) for a in added):
            raise ValueError(f"{path}: pre-tokens of this tokenizer are not known")
        self.specials = {a.content for a in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len)[::-1])) + ")") if added else None
        plain = ["NFC()", r'Replace(pattern=Regex("\s+"), content=" ")', "Lowercase()"]  # leave composed letters, but their case
        normal = repr(t.normalizer) in ("None", f"Sequence(normalizers=[{', '.join(plain)}])")
        # a tokenizer that also keeps whole words, or strings of letters, as added tokens goes the plain path
        alone = isinstance(t.model, BPE) and not t.model.dropout and normal and not any(_LETTERS.fullmatch(a.content) for a in added)
        self.model = model = t.model if alone else None
        # words side by side stay apart if no piece of the vocabulary but itself has the letter between them
        self.between = None
        if model and self.byte_level and not (model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix):
            if [k for k in t.get_vocab(False) if _BETWEEN in k] == [_BETWEEN]:
                self.between = t.token_to_id(_BETWEEN)
        lower = t.normalizer is not None
        self.bare, self.spaced = _Ids(t, "", model, lower), _Ids(t, " " if self.byte_level else "", model, lower)

    def segments(self, text: str) -> list[str]:
        """The text around special strings, and the special strings."""
        if self.cut is None or not any(s in text for s in self.specials):
            return [text]
        return [s for s in self.cut.split(text) if s]

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of the text."""
        if not text:
            return b""
        if len(self.bare) + len(self.spaced) > MEMORY:
            self.bare.next_generation()
            self.spaced.next_generation()
        out: list[bytes] = []
        for s in self.segments(text):
            if s in self.specials:
                out.append(self.bare[s])
            elif self.word_level:
                out += map(self.bare.__getitem__, s.replace("\n", " ").split(" "))
            elif plain_blanks(s):
                for n, line in enumerate(s.split("\n")):
                    first, *rest = line.split(" ")
                    if n:
                        out.append(self.bare["\n"])
                    out.append(self.bare[first])
                    out += map(self.spaced.__getitem__, rest)
            else:
                out += [self.bare[p] for p in _BEFORE_WORD.split(s) if p]
        return b"".join(out)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` of every text."""
        if self.between is None:
            return [self.encode(t) for t in texts]
        out: list[bytes] = [b""] * len(texts)
        held: list[bytes] = []  # texts, and their places
        places: list[int] = []
        size = 0
        for k, t in enumerate(texts):
            if t:
                places.append(k)
                held.append(t.encode("utf-8"))
                size += len(held[-1])
            if held and (size >= SLICE or k + 1 == len(texts)):
                odd = self._odd(held)
                for i in np.flatnonzero(odd).tolist():
                    out[places[i]] = self.encode(texts[places[i]])
                plain = [h for h, o in zip(held, odd, strict=True) if not o]
                where = [p for p, o in zip(places, odd, strict=True) if not o]
                held, places, size = [], [], 0
                if plain:
                    self._plain(plain, where, out)
        return out

    def _odd(self, held: list[bytes]) -> np.ndarray:
        """Of every text, whether it has more than plain blanks (at least where
        ``plain_blanks`` says so) or a special string."""
        ends = np.cumsum([len(h) + 1 for h in held])
        joined = b"\n".join([b"", *held, b""])  # a line break in front of each text and behind the last
        data = np.frombuffer(joined, np.uint8)
        space = (data == 32) | (data == 10)
        twice = np.flatnonzero(space[1:] & space[:-1])  # in a text: single blanks never meet
        lead = np.flatnonzero(_MAY_BE_ODD[data])  # a line break is behind each
        kind = data[lead].astype(np.int64)
        at = [twice, lead[_IS_ODD[kind] | np.isin(kind << 8 | data[lead + 1], _ODD_PAIRS)]]
        for s in self.specials:
            at.append(np.array([m.start() for m in re.finditer(re.escape(s.encode("utf-8")), joined)], np.int64))
        # the line break in front of a text counts to it
        odd = np.zeros(len(held) + 1, bool)
        odd[np.searchsorted(ends, np.concatenate(at), "right")] = True
        return odd[:-1]

    def _plain(self, held: list[bytes], places: list[int], out: list[bytes]) -> None:
        """Put the ids of texts of plain blanks into ``out``; empties ``held``."""
        ends = np.cumsum([len(h) for h in held])
        data = np.frombuffer(b"".join(held) + b" ", np.uint8)  # a blank behind all texts
        held.clear()
        begins = (data == 32) | (data == 10)
        edge = np.zeros(len(data), bool)
        edge[0] = edge[ends] = True
        # signs between a letter and white space or the end of a text
        sign = np.flatnonzero(_IS_SIGN[data])
        if len(sign):
            new = (np.diff(sign) > 1) | edge[sign[1:]]
            behind = sign[np.append(new, True)] + 1
            sign = sign[np.append(True, new)]
            before = data[sign - 1]  # of the first byte: the blank
            letter = _IS_ASCII_LETTER[before] | (_IS_LETTER[before] & (data[sign - 2] == 0xC3))
            sign = sign[letter & ~edge[sign] & (begins[behind] | edge[behind])]
        begins[np.flatnonzero(data == 10) + 1] = True
        begins[sign] = True
        begins |= edge
        starts = np.flatnonzero(begins)  # of units; the last is the end of all texts
        del begins, edge
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1,
                                               [None, pa.py_buffer(starts), pa.py_buffer(data)])
        cut = cut.dictionary_encode()
        ids, at, n = self._units(cut.dictionary)
        unit = cut.indices.to_numpy()
        first = [0, *np.searchsorted(starts, ends).tolist()]  # unit of each text
        del starts, cut, data
        for lo in range(0, len(places), _GATHERED):
            hi = min(lo + _GATHERED, len(places))
            u = unit[first[lo]:first[hi]]
            m = n[u]
            done = np.cumsum(m)
            got = ids[np.repeat(at[u] - (done - m), m) + np.arange(done[-1])]
            upto = [0, *done[np.array(first[lo + 1:hi + 1]) - first[lo] - 1].tolist()]
            for k in range(lo, hi):
                out[places[k]] = got[upto[k - lo]:upto[k - lo + 1]].tobytes()

    def _units(self, units: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct units, with their blank: the ids, and where each unit's begin and how many they are."""
        offsets, data = np.frombuffer(units.buffers()[1], np.int64)[:len(units) + 1], np.frombuffer(units.buffers()[2], np.uint8)
        size = np.diff(offsets)
        letters = np.concatenate(([0], np.cumsum(_IS_LETTER[data], dtype=np.int64)))[offsets]
        blank = data[offsets[:-1]] == 32
        plain = (np.diff(letters) == size - blank) & (size > blank)
        words, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        at, n = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        ids = []
        if len(words):
            every = pa.LargeListArray.from_arrays([0, len(words)], units.take(pa.array(words)))
            joined = pc.binary_join(every, pa.scalar(_BETWEEN.encode("latin-1"), pa.large_binary()))[0].as_buffer()
            joined = _LETTER_OF[np.frombuffer(joined, np.uint8)]
            ends = [*np.flatnonzero(joined == ord(_BETWEEN))[_TOGETHER - 1::_TOGETHER].tolist(), len(joined)]
            start = 0
            for end in ends:
                some = self.model.tokenize(joined[start:end].tobytes().decode("utf-16-le"))
                ids.append(np.array([t.id for t in some] + [self.between], np.uint32))
                start = end + 1
            ids = [np.concatenate(ids)]
            ends = np.flatnonzero(ids[0] == self.between)
            at[words] = np.concatenate(([0], ends[:-1] + 1))
            n[words] = ends - at[words]
        rest = [self.bare.encode(u.decode("utf-8")) for u in units.take(pa.array(others)).to_pylist()]
        n[others] = [len(r) // 4 for r in rest]
        at[others] = np.cumsum(n[others]) - n[others] + sum(map(len, ids))
        return np.concatenate([*ids, np.frombuffer(b"".join(rest), "<u4")]), at, n

    def counts(self, units: list[str]) -> list[int]:
        """Numbers of ids of units, a blank in front of those that have one. Only
        the units of this call and of the one before are remembered."""
        self.bare.next_generation()
        self.spaced.next_generation()
        return [len(self.spaced[u[1:]] if self.byte_level and len(u) > 1 and u[0] == " " and not u[1].isspace()
                    else self.bare[u]) // 4 for u in units]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder for this file (kept between tasks)."""
    return Encoder(path)
