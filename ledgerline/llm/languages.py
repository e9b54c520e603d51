"""Operator 11: language identification with a blended-spectrum string kernel.

The kernel of two texts is the number of distinct character n-grams (n = 1, 2, 3) that stand in both, over
the root of the product of their own numbers. Texts are lower-cased; characters that are no letters count
as one separator. The ``ALPHABET`` commonest characters of the landmarks stand for themselves, rarer letters
for the block of 256 code points they lie in; n-grams that no landmark has are not counted.

``LANDMARKS`` texts span the Nystrom approximation: with K the kernel among them, the features of a text are
K^(-1/2) times its kernel values with the landmarks. One-versus-rest ridge regression on a sample of at most
``SAMPLE`` texts a language (``SAMPLE_ALL`` in all) gives a value per language; its penalty has the lowest leave-one-out error of
``PENALTIES``. A batch of texts is scored by two matrix products: presence times landmarks, the
kernel values, times the regression's coefficients. Texts of any length are read whole, in slices.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

LANDMARKS, LANGUAGES = 256, 256  # landmarks in all, languages learned (the commonest)
SAMPLE, SAMPLE_ALL = 1024, 8192  # sample texts of a language, and in all
ALPHABET, BLOCKS = 192, 32  # characters, and classes of the rarer ones
MAX_GRAMS = 32_768  # n-grams of the landmarks that count: those of most landmarks
PENALTIES = (1e-4, 1e-3, 1e-2, 1e-1, 1.0)
UNKNOWN = "und"
SLICE, ROWS = 1 << 20, 512  # characters and texts handled at once


def held_out(id_col: Column | str) -> Column:
    """The fold that is never learned from; rows without an id are neither learned from nor held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter, for all of Unicode; made once per worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@dataclass(frozen=True)
class Grams:
    """The n-grams that count: ``codes`` over the classes of characters, sorted, in one range per n."""

    alphabet: np.ndarray  # code points with a class of their own
    codes: np.ndarray

    @property
    def base(self) -> int:
        return 1 + len(self.alphabet) + BLOCKS

    def classes(self) -> np.ndarray:
        """Class of every code point: 0 for what is no letter."""
        point = np.arange(0x110000)
        out = np.where(_letters(), 1 + len(self.alphabet) + (point >> 8) % BLOCKS, 0).astype(np.int32)
        out[self.alphabet] = 1 + np.arange(len(self.alphabet))
        return out


def _codes(c: np.ndarray, base: int) -> list[np.ndarray]:
    """Codes of the 1-, 2- and 3-grams of a text's classes, each n in its own range."""
    one = c
    two = one[:-1] * base + c[1:] if len(c) > 1 else one[:0]
    three = two[:-1] * base + c[2:] if len(c) > 2 else one[:0]
    return [one, two + base, three + (base + base * base)]


class Presence:
    """Rows of 0 and 1: which of the counted n-grams stand in a text."""

    def __init__(self, grams: Grams):
        self.grams, self.classes, self.base = grams, grams.classes(), grams.base
        self.number = np.full(self.base + self.base**2 + self.base**3, -1, dtype=np.int32)
        self.number[grams.codes] = np.arange(len(grams.codes))
        # n-grams without a letter say nothing
        self.number[[0, self.base, self.base + self.base**2]] = -1

    def __call__(self, texts: list[np.ndarray], begins: bool = True, ends: bool = True) -> np.ndarray:
        """``texts``: code points. Two separators stand before and after a text, but where it is a slice that does
        not begin or end there."""
        width = len(self.grams.codes)
        out = np.zeros(len(texts) * width, dtype=np.float32)
        gap = np.zeros(2, dtype=np.uint32)
        joined = [x for t in texts for x in ((gap, t) if begins else (t,))] + [gap] * ends
        size = np.array([len(t) + 2 * begins for t in texts], dtype=np.int64)
        row = np.repeat(np.arange(len(texts), dtype=np.int64) * width, size)
        for code in _codes(self.classes[np.concatenate(joined)], self.base):
            at = self.number[code[: len(row)]]  # an n-gram belongs to the text that it starts in
            hit = np.flatnonzero(at >= 0)
            out[row[hit] + at[hit]] = 1
        return out.reshape(len(texts), width)


def _kernel(x: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Normalised kernel values of presence rows with those of the landmarks (columns, already normalised)."""
    return (x @ marks) / np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None]


@dataclass(frozen=True)
class Model:
    grams: Grams
    marks: np.ndarray  # (n-grams, landmarks), columns normalised
    weights: np.ndarray  # (landmarks, languages)
    bias: np.ndarray
    languages: list[str]

    def scorer(self):
        p = Presence(self.grams)
        return lambda texts: _kernel(_joined(p, texts), self.marks) @ self.weights + self.bias


def _joined(p: Presence, texts: list[str]) -> np.ndarray:
    """Presence of whole texts: those beyond ``SLICE`` are read slice by slice into one row."""
    rows = [_points(t) for t in texts]
    if all(len(r) <= SLICE for r in rows):
        return p(rows)
    out = []
    for r in rows:
        parts = range(0, max(1, len(r)), SLICE)
        out.append(np.maximum.reduce([p([r[max(0, at - 2) : at + SLICE]], at == 0, at + SLICE >= len(r)) for at in parts]))
    return np.concatenate(out)


def _groups(batch: pa.RecordBatch):
    """(begin, texts) of a batch, bounded in texts and in characters."""
    begin, held, n = 0, [], 0
    for i, t in enumerate(batch["text"].to_pylist()):
        t = t or ""
        if held and (n + len(t) > SLICE or len(held) == ROWS):
            yield begin, held
            begin, held, n = i, [], 0
        held.append(t)
        n += len(t)
    if held:
        yield begin, held


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, languages: int, marks: int) -> DataFrame:
    """(lang, text, place, mark): at most ``per_language`` different texts with a letter of each language learned,
    in order of a hash of the text; the first of each language are landmarks, ``marks`` in all."""
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")
    ident = F.col(f"`{id_col}`")
    learn = docs.where(ident.isNotNull() & ~held_out(ident)).select(lang.alias("lang"), text.alias("text"))
    learn = learn.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    # copies are one: only hashes are grouped and ordered, and the few chosen ones joined to their texts
    keys = learn.groupBy("lang", "h").agg(F.count("*").alias("copies"))
    common = keys.groupBy("lang").agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).select("lang")
    common = [r.lang for r in common.collect()]
    place = Window.partitionBy("lang").orderBy("h")
    keys = keys.where(F.col("lang").isin(common)).withColumn("place", F.row_number().over(place))
    share = max(1, len(common))
    keys = keys.where(F.col("place") <= min(per_language, max(1, SAMPLE_ALL // share)))
    keys = stored(keys.select("lang", "h", "place"), "language_sample_keys")
    each = max(1, marks // share)
    found = learn.join(F.broadcast(keys), ["lang", "h"])  # at most SAMPLE_ALL keys of a few bytes
    one = found.groupBy("lang", "h", "place").agg(F.min("text").alias("text"))
    return stored(one.select("lang", "text", "place", (F.col("place") <= each).alias("mark")), "language_sample")


def _alphabet(texts: DataFrame, size: int) -> np.ndarray:
    """The commonest letters of some texts."""

    def count(batches):
        for b in batches:
            for _, group in _groups(b):
                for t in group:
                    point, n = np.unique(_points(t), return_counts=True)
                    own = _letters()[point]
                    yield pa.RecordBatch.from_arrays([pa.array(point[own].astype(np.int64)), pa.array(n[own].astype(np.int64))], names=["point", "n"])

    got = texts.select("text").mapInArrow(count, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r.point for r in got.orderBy(F.desc("n"), "point").limit(size).collect()], dtype=np.int64))


def _landmarks(texts: DataFrame, alphabet: np.ndarray, limit: int) -> tuple[Grams, list[np.ndarray]]:
    """The n-grams of the landmarks (those of most landmarks, if more than ``limit``), and each landmark's own."""
    sent = texts.sparkSession.sparkContext.broadcast(alphabet)

    def codes(batches):
        g = Grams(sent.value, np.empty(0, np.int64))
        classes, base = g.classes(), g.base
        for b in batches:
            for lang, place, text in zip(b["lang"].to_pylist(), b["place"].to_pylist(), b["text"].to_pylist()):
                c = np.concatenate([[0, 0], classes[_points(text)], [0, 0]]).astype(np.int64)
                found = np.unique(np.concatenate(_codes(c, base)))
                found = found[~np.isin(found, [0, base, base + base * base])]
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([place], pa.int32()), pa.array([found], pa.list_(pa.int64()))], names=["lang", "place", "codes"])

    got = texts.mapInArrow(codes, "lang string, place int, codes array<long>").orderBy("lang", "place").toArrow()
    own = [np.asarray(c.values) for c in got["codes"]]
    code, n = np.unique(np.concatenate(own), return_counts=True)
    if len(code) > limit:
        code = np.sort(code[np.lexsort((code, -n))[:limit]])
    return Grams(alphabet, code), own


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE, marks: int = LANDMARKS) -> Model | None:
    """The model learned from the rows of ``docs`` outside the held-out fold; None if no row can be learned from."""
    chosen = sample(docs, id_col, text_col, lang_col, per_language, LANGUAGES, marks)
    first = chosen.where("mark").select("lang", "place", "text")
    alphabet = _alphabet(first, ALPHABET)
    if not len(alphabet):
        return None
    grams, own = _landmarks(first, alphabet, MAX_GRAMS)
    marks_ = np.zeros((len(grams.codes), len(own)), dtype=np.float32)
    for i, codes in enumerate(own):
        at = np.minimum(np.searchsorted(grams.codes, codes), len(grams.codes) - 1)
        marks_[at[grams.codes[at] == codes], i] = 1
    marks_ /= np.sqrt(np.maximum(marks_.sum(axis=0), 1))
    sent = docs.sparkSession.sparkContext.broadcast((grams, marks_))

    def values(batches):
        g, m = sent.value
        p = Presence(g)
        for b in batches:
            for at, texts in _groups(b):
                k = _kernel(_joined(p, texts), m).astype(np.float64)
                yield pa.RecordBatch.from_arrays([b["lang"].slice(at, len(texts)), b["place"].slice(at, len(texts)), pa.array(list(k), pa.list_(pa.float64()))], names=["lang", "place", "k"])

    rows = chosen.select("lang", "place", "text").mapInArrow(values, "lang string, place int, k array<double>").orderBy("lang", "place").toArrow()
    k = np.stack([np.asarray(v.values) for v in rows["k"]])
    langs = rows["lang"].to_pylist()
    languages = sorted(set(langs))
    y = (np.array(langs)[:, None] == np.array(languages)).astype(np.float64)
    weights, bias = _regress(marks_.astype(np.float64).T @ marks_.astype(np.float64), k, y)
    return Model(grams, marks_, weights.astype(np.float32), bias.astype(np.float32), languages)


def _regress(among: np.ndarray, k: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of kernel values and constants: ridge regression of ``y`` on the Nystrom features."""
    value, vector = np.linalg.eigh(among)
    good = value > value.max() * 1e-6
    root = vector[:, good] / np.sqrt(value[good])
    x = k @ root
    # each language weighs the same
    w = 1 / y.sum(axis=0)
    w = np.sqrt((y * w).sum(axis=1) * len(y) / y.shape[1])[:, None]
    mean_x, mean_y = (w**2 * x).mean(axis=0), (w**2 * y).mean(axis=0)
    u, s, vt = np.linalg.svd(w * (x - mean_x), full_matrices=False)
    target = w * (y - mean_y)
    best = None
    for penalty in PENALTIES:
        shrink = s**2 / (s**2 + penalty * len(y))
        left = target - u @ (shrink[:, None] * (u.T @ target))
        out = left / np.maximum(1 - ((u**2) @ shrink)[:, None] - w**2 / len(y), 1e-9)  # leave one out
        error = float((out**2).mean())
        if best is None or error < best[0]:
            best = error, vt.T @ ((s / (s**2 + penalty * len(y)))[:, None] * (u.T @ target))
    return root @ best[1], mean_y - mean_x @ best[1]


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row: the language of the highest value, and that value held to 0..1.

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text if nothing could be
    learned. Of equal values the language first in byte order wins. One narrow pass over whole texts; repeated rows
    and null ids give rows of their own, and other columns are ignored, whatever their names.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        values = m.scorer() if m else None
        for b in batches:
            for at, texts in _groups(b):
                read = np.array([any(map(str.isalpha, t)) for t in texts]) & (m is not None)
                names, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
                if read.any():
                    v = values([t for t, r in zip(texts, read) if r])
                    best = v.argmax(axis=1)
                    names[read] = [m.languages[i] for i in best]
                    score[read] = np.clip(v[np.arange(len(best)), best], 0, 1)
                yield pa.RecordBatch.from_arrays([b["id"].slice(at, len(texts)), pa.array(names, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])

    return src.mapInArrow(run, f"id {kind}, lang_pred string, score double")
