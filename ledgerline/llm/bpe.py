"""Operator 10: BPE encoding and decoding as a bounded-lookahead streaming transducer.

``MergeTable`` holds a byte-level merge list and computes its *sufficient lookahead*: the number of
bytes after which nothing that follows can change the tokens before them. ``BpeStream`` keeps only
the bytes that are not yet stable and emits tokens as soon as they are; ``TextStream`` puts the
pre-tokeniser in front of it (also incremental, so a run of a million letters is held in constant
memory); ``Decoder`` turns ids back into text byte by byte.

Why a lookahead exists. Run the merge list rank by rank over a text and over the same text with
something appended. At the start both agree on every boundary up to the end of the shorter one. A
rank with parts (x, y) can move the last agreed boundary left only by merging an ``x`` that stands
right before it with a ``y`` right after it, and then by ``len(x)`` bytes. The ``y`` of the next such
move must begin with that ``x``: the ``x`` is on the left spine of ``y``'s own derivation. So the
furthest move is the heaviest chain of merges of rising rank in which each part ``x`` lies on the
left spine of the next merge's ``y``; one pass over the merge list finds it.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerline.llm.common import runs, slices

# Fixed value: the published split pattern of byte-level BPE vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_UNIT = re.compile(r"\s*\S+|\s+")
_ODD = re.compile("[\x1c-\x1f]")  # white space to ``re`` but not to the split pattern
_CLASSES = [("l", regex.compile(r" ?\p{L}+")), ("n", regex.compile(r" ?\p{N}+")), ("s", regex.compile(r"\s+"))]
_MORE = {k: regex.compile(p) for k, p in (("l", r"\p{L}+"), ("n", r"\p{N}+"), ("s", r"\s+"), ("o", r"[^\s\p{L}\p{N}]+"))}
_PRETOKEN = regex.compile(SPLIT)
PIECE = 4096  # characters fed to the transducer, and ids to the decoder, at once


def byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in byte-level vocabularies: printable bytes stand for
    themselves, the others take the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class MergeTable:
    """A byte-level merge list: ids of bytes, (id, id) -> (rank, id), bytes of ids, special texts."""

    def __init__(self, spec: str):
        """``spec``: the text of a tokenizer JSON file with a byte-level BPE model."""
        doc = json.loads(spec)
        model, letter = doc["model"], byte_letters()
        vocab = model["vocab"]
        byte_of = {c: b for b, c in letter.items()}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in doc.get("added_tokens") or []}
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.byte_id = np.array([vocab[letter[b]] for b in range(256)], dtype=np.int64)
        self._byte = self.byte_id.tolist()
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            x, y = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault((vocab[x], vocab[y]), (rank, vocab[x + y]))
        self.lookahead = self._lookahead()
        self.longest = max((len(b) for b in self.bytes_of.values()), default=1)

    def _lookahead(self) -> int:
        size = {int(i): 1 for i in self.byte_id}
        left: dict[int, int] = {}
        for (x, y), (_, t) in self.merge.items():  # in rank order
            size[t] = size[x] + size[y]
            left.setdefault(t, x)
        reach: dict[int, int] = {}  # part x -> heaviest chain that ended with a merge of x so far
        most = 0
        for x, y in self.merge:
            far, t = 0, y
            while t is not None:
                far = max(far, reach.get(t, 0))
                t = left.get(t)
            reach[x] = max(reach.get(x, 0), far + size[x])
            most = max(most, reach[x])
        return most

    def tokenize(self, data: bytes) -> list[int]:
        """All tokens of one pre-token: lowest rank first, leftmost among equals."""
        return self._scanned(data) if len(data) <= 64 else self._queued(data)

    def _scanned(self, data: bytes) -> list[int]:
        """For short data: look over the ranks of all neighbours for each merge."""
        one, merge, top = self._byte, self.merge, (1 << 60, -1)
        ids = [one[x] for x in data]
        found = [merge.get(pair, top) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is top:
                break
            i = found.index(best)
            ids[i : i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = merge.get((ids[i - 1], ids[i]), top)
            if i < len(found):
                found[i] = merge.get((ids[i], ids[i + 1]), top)
        return ids

    def _queued(self, data: bytes) -> list[int]:
        """For long data: neighbours in a heap."""
        ids = self.byte_id[np.frombuffer(data, dtype=np.uint8)].tolist()
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if m := self.merge.get((ids[i], ids[i + 1])):
                heap.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, t = heapq.heappop(heap)
            j = nxt[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = t, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if m := self.merge.get((t, ids[nxt[i]])):
                    heapq.heappush(heap, (m[0], i, t, ids[nxt[i]], m[1]))
            if prv[i] >= 0 and (m := self.merge.get((ids[prv[i]], t))):
                heapq.heappush(heap, (m[0], prv[i], ids[prv[i]], t, m[1]))
        return [t for t in ids if t >= 0]


class BpeStream:
    """Tokens of one pre-token fed in pieces; holds at most ``lookahead`` + ``slack`` bytes and a piece."""

    def __init__(self, merges: MergeTable, slack: int = 4096):
        self.merges, self.held = merges, b""
        self.limit = merges.lookahead + max(slack, merges.longest)

    def feed(self, data: bytes) -> list[int]:
        """The tokens that have become stable: nothing that may still come can change them."""
        out: list[int] = []
        for at in range(0, len(data), self.limit):
            self.held += data[at : at + self.limit]
            if len(self.held) > self.limit:
                stable, end = len(self.held) - self.merges.lookahead, 0
                for t in self.merges.tokenize(self.held):
                    if end + len(self.merges.bytes_of[t]) > stable:
                        break
                    end += len(self.merges.bytes_of[t])
                    out.append(t)
                self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        data, self.held = self.held, b""
        return self.merges.tokenize(data)


class TextStream:
    """Text in pieces -> token ids: special texts, pre-tokens and merges, all incremental.

    A pre-token is closed once three more characters are known (the longest contraction); one that
    grows past ``long`` characters is handed to the ``BpeStream`` while it is still open. The last
    white-space character of an open run is always kept back, since it may belong to the next word.
    Short pre-tokens that were closed before are remembered, up to ``memo`` of them.
    """

    def __init__(self, merges: MergeTable, long: int = 4096, slack: int = 4096, memo: int = 100_000):
        self.merges, self.long = merges, long
        self.buf, self.run, self.bpe = "", "", BpeStream(merges, slack)
        self.known: dict[str, list[int]] = {}
        self.memo = memo
        s = sorted(merges.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, s))) if s else None
        self.prefixes = {t[:n] for t in s for n in range(1, len(t))}
        self.keep = max(map(len, self.prefixes), default=0)

    def feed(self, text: str) -> list[int]:
        self.buf += text
        return self._step(False)

    def finish(self, text: str = "") -> list[int]:
        """The rest, with ``text`` as the last piece."""
        self.buf += text
        return self._step(True)

    def _step(self, final: bool) -> list[int]:
        out: list[int] = []
        while self.special and (m := self.special.search(self.buf)):
            seg, rest = self.buf[: m.start()], self.buf[m.end() :]
            self._split(seg, True, out)
            out.append(self.merges.special[m.group()])
            self.buf = rest
        end = len(self.buf)
        if not final:
            for n in range(min(self.keep, end), 0, -1):
                if self.buf[end - n :] in self.prefixes:
                    end -= n
                    break
        rest = self.buf[end:]
        self.buf = self._split(self.buf[:end], final, out) + rest
        return out

    def _closed(self, p: str) -> list[int]:
        """A whole pre-token through the ``BpeStream``."""
        got = self.known.get(p)
        if got is None:
            data = p.encode()
            got = self.bpe.feed(data) + self.bpe.finish()
            if len(p) <= 64:
                if len(self.known) >= self.memo:
                    self.known.clear()
                self.known[p] = got
        return got

    def _split(self, seg: str, final: bool, out: list[int]) -> str:
        """Emit what is closed in ``seg``; returns what must wait (nothing, when ``final``)."""
        if self.run:
            m = _MORE[self.run].match(seg)
            end = m.end() if m else 0
            if end == len(seg) and not final:
                keep = min(end, 1) if self.run == "s" else 0
                out += self.bpe.feed(seg[: end - keep].encode())
                return seg[end - keep :]
            if self.run == "s" and end < len(seg):
                end -= 1  # the last white-space character goes with what follows
            out += self.bpe.feed(seg[:end].encode())
            out += self.bpe.finish()
            self.run, seg = "", seg[end:]
        if final:
            for p in _PRETOKEN.findall(seg):
                out += self._closed(p)
            return ""
        at = 0
        for m in _PRETOKEN.finditer(seg):
            if m.end() + 3 > len(seg):
                break
            out += self._closed(m.group())
            at = m.end()
        left = seg[at:]
        if len(left) > self.long:
            self.run = next((k for k, p in _CLASSES if p.fullmatch(left)), "o" if _MORE["o"].fullmatch(left.removeprefix(" ")) else "")
            if self.run:
                keep = 1 if self.run == "s" else 0
                out += self.bpe.feed(left[: len(left) - keep].encode())
                left = left[len(left) - keep :]
        return left


class Decoder:
    """Ids in pieces -> text. The state is the unfinished UTF-8 sequence (at most three bytes);
    bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.machine = bytes_of, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


class Encoder:
    """``TextStream`` over whole texts, with its output remembered per unit.

    A unit is a run of white space and the non-white run after it. A pre-token always ends where
    white space follows a non-white character, and there the transducer holds nothing: its output
    for a unit depends on that unit alone. Every unit not remembered is fed to the transducer, in pieces of
    ``PIECE`` characters; ``fed`` counts these units and ``held`` is the most that the transducer has held, in
    characters and bytes. The memo is bounded and only saves repeated work.
    """

    def __init__(self, merges: MergeTable, memo: int = 500_000, long: int = PIECE):
        self.merges, self.limit = merges, memo
        self.stream = TextStream(merges, long)
        self.fed, self.held = 0, 0
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.empty(0, dtype=np.int32)
        self.offset = np.zeros(1, dtype=np.int64)
        self.count = 0

    def _run(self, unit: str) -> Iterator[list[int]]:
        """The transducer's output for a unit; it holds nothing before and after."""
        s, at = self.stream, 0
        while len(unit) - at > PIECE:
            yield s.feed(unit[at : at + PIECE])
            self.held = max(self.held, len(s.buf) + len(s.bpe.held))
            at += PIECE
        yield s.finish(unit[at:])

    def _learn(self, units: list[str]) -> None:
        """Feed units not yet known to the transducer and append their ids to the memo."""
        flat: list[int] = []
        ends = np.empty(len(units), np.int64)
        for i, u in enumerate(units):
            for ids in self._run(u):
                flat += ids
            ends[i] = len(flat)
        start = self.offset[self.count]
        self.flat = np.concatenate([self.flat[:start], np.array(flat, dtype=np.int32)])
        self.offset = np.concatenate([self.offset[: self.count + 1], start + ends])
        self.code.update(zip(units, range(self.count, self.count + len(units))))
        self.count += len(units)
        self.fed += len(units)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of some texts; pass groups of bounded size."""
        if self.count > self.limit:
            self._clear()
        units: list[str] = []
        n_units = []
        for t in texts:
            if _ODD.search(t):  # rare: the whole text is one unit, never remembered beyond the memo
                got = [t]
            else:
                got = _UNIT.findall(t)
            units += got
            n_units.append(len(got))
        missing = [u for u in dict.fromkeys(units) if u not in self.code]
        self._learn(missing)
        codes = np.fromiter(map(self.code.__getitem__, units), np.int64, len(units))
        begin = self.offset[codes]
        count = self.offset[codes + 1] - begin
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(begin - (ends - count), count) + np.arange(total)]
        by_unit = np.concatenate(([0], ends))
        marks = by_unit[np.concatenate(([0], np.cumsum(n_units, dtype=np.int64)))]
        return ids, np.diff(marks)


def encode_stream(merges: MergeTable, pieces: Iterable[str], long: int = 4096, slack: int = 4096) -> Iterator[int]:
    """Token ids of a text that arrives in pieces, in constant memory."""
    s = TextStream(merges, long, slack)
    for p in pieces:
        yield from s.feed(p)
    yield from s.finish()


_ENCODERS: dict[int, Encoder] = {}  # one per Python worker and vocabulary


def encoder(spec: str) -> Encoder:
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(MergeTable(spec))
    return _ENCODERS[key]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(id, ids array<int>, decoded string) for every row, and its ``text`` if ``keep_text``.

    ``tokenizer``: path of a tokenizer JSON file, read once on the driver and sent to the tasks (a
    vocabulary, so of fixed size). A null text counts as empty: no ids, decoded to the empty text.
    Repeated rows and null ids give rows of their own; other columns are ignored, whatever their
    names; an empty table gives an empty result. One narrow pass, no shuffle.
    """
    spec = docs.sparkSession.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        enc = encoder(spec.value)
        bytes_of = enc.merges.bytes_of
        for b in slices(batches, 1024):
            for rows in runs(zip(b["id"].to_pylist(), b["text"].to_pylist()), lambda r: len(r[1] or ""), 1 << 20):
                ids, n = enc.encode([t or "" for _, t in rows])
                texts, at = [], 0
                for k in n.tolist():
                    d = Decoder(bytes_of)
                    texts.append("".join([*(d.feed(ids[i : min(i + PIECE, at + k)].tolist()) for i in range(at, at + k, PIECE)), d.finish()]))
                    at += k
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(ids))
                cols = [pa.array([r[0] for r in rows], b.schema.field("id").type), lists, pa.array(texts, pa.string())]
                if keep_text:
                    cols.append(pa.array([r[1] for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[id_col, "ids", "decoded", "text"][: len(cols)])

    return src.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string" + ", text string" * keep_text)
