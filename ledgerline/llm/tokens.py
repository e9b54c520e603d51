"""Whole-text encoding with the tokenizers library, with work on repeated words saved.

Shared by the length histogram and the binary writer. A text is cut where white space follows a
non-white character; neither vocabulary's splitter ever joins text across such a place, so the ids
of a text are the ids of its units in order. Each unit goes through the library once per memo.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np

from ledgerline.llm.bpe import byte_letters

_UNIT = re.compile(r"\s*\S+|\s+")
_ODD = re.compile("[\x1c-\x1f]")  # white space to ``re`` but not to the library's patterns
# Letters that no normal form or splitter divides, and signs after them, which split off as one piece.
_PLAIN = re.compile('([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.;:!?)"]*)').fullmatch
_LETTER_OF = byte_letters()  # byte -> its letter in byte-level vocabularies


class _Codes(dict):
    """unit -> number; a unit not yet known gets the next number and is noted as new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        self.new.append(unit)
        return n


class UnitEncoder:
    """ids of texts by the library's tokenizer; ``memo`` bounds the remembered units."""

    def __init__(self, spec: str, memo: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tok, self.limit = Tokenizer.from_str(spec), memo
        self.tok.no_truncation()
        self.tok.no_padding()
        # a vocabulary that drops white space: a word and the same word after a space have equal ids
        self.bare = not self._ids([" ", "\n "])[0].size
        # a vocabulary of lower case: ASCII text may be lowered first, unless a special text would arise
        self.folds = np.array_equal(self._ids(["ABCDEFGHIJKLM", "NOPQRSTUVWXYZ"])[0], self._ids(["abcdefghijklm", "nopqrstuvwxyz"])[0])
        self.special = [x.content.lower() for x in self.tok.get_added_tokens_decoder().values()]
        self.signs: dict[str, list[int]] = {"": []}
        # whether the library's model alone, without normal form and splitter, does for plain words
        trial = ["word", "Straße,", "NAÏVE", "ÿ", "señor.)", "a" * 40]
        self.direct = self.bare and [self._plain(*_PLAIN(u).groups()) for u in trial] == [self._ids([u])[0].tolist() for u in trial]
        self._clear()

    def _clear(self) -> None:
        self.code = _Codes()
        self.flat, self.begin, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tok.encode_batch_fast(units, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.int32, int(size.sum())), size

    def _plain(self, word: str, signs: str) -> list[int]:
        if signs not in self.signs:
            self.signs[signs] = self._ids([signs])[0].tolist()
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_LETTER_OF)
        return [t.id for t in self.tok.model.tokenize(word)] + self.signs[signs]

    def _learn(self) -> None:
        new, self.code.new = self.code.new, []
        got: list[list[int] | None] = [None] * len(new)
        if self.direct:
            got = [self._plain(*m.groups()) if (m := _PLAIN(u)) else None for u in new]
        rest = [i for i, g in enumerate(got) if g is None]
        for at in range(0, len(rest), 8192):
            part = rest[at : at + 8192]
            for i, e in zip(part, self.tok.encode_batch_fast([new[i] for i in part], add_special_tokens=False)):
                got[i] = e.ids
        count = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(itertools.chain.from_iterable(got), np.int32, int(count.sum()))
        begin = len(self.flat) + np.cumsum(count) - count
        self.flat = np.concatenate([self.flat, ids])
        self.begin, self.count = np.concatenate([self.begin, begin]), np.concatenate([self.count, count])

    def _look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of each unit, where each text's units end)."""
        if len(self.code) > self.limit:
            self._clear()
        units: list[str] = []
        n_units = [0]
        for t in texts:
            if self.folds and t.isascii():
                low = t.lower()
                t = t if any(x in low for x in self.special) else low
            got = [t] if _ODD.search(t) else t.split() if self.bare else _UNIT.findall(t)
            units += got
            n_units.append(len(got))
        codes = np.fromiter(map(self.code.__getitem__, units), np.int64, len(units))
        if self.code.new:
            self._learn()
        return codes, np.cumsum(n_units)

    def lengths(self, texts: list[str]) -> np.ndarray:
        """ids per text."""
        codes, marks = self._look_up(texts)
        if not len(codes):
            return np.zeros(len(texts), np.int64)
        return np.diff(np.concatenate(([0], np.cumsum(self.count[codes])))[marks])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of some texts; pass groups of bounded size."""
        codes, marks = self._look_up(texts)
        if not len(codes):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        count = self.count[codes]
        ends = np.cumsum(count)
        ids = self.flat[np.repeat(self.begin[codes] - (ends - count), count) + np.arange(int(ends[-1]))]
        return ids, np.diff(np.concatenate(([0], ends))[marks])


_ENCODERS: dict[int, UnitEncoder] = {}  # one per Python worker and vocabulary


def unit_encoder(spec: str) -> UnitEncoder:
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = UnitEncoder(spec)
    return _ENCODERS[key]
