"""Language identification with hyperdimensional profiles.

Every letter class has a random vector of +1 and -1. A letter trigram is the product (binding) of its letters' vectors,
each rotated by its place; a text or a language is the sum (bundle) of its trigrams, and a text gets the language whose
bundle has the greatest cosine with its own. Sums over distinct trigrams with their counts equal sums over all of them.

Only text is an input of a prediction. Null text, or text without a letter, is ``und`` with score 0, and so is every
text when nothing was learned. Ties go to the smaller language name. Repeated rows and null ids are predicted alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.llm.chunks import small_batches

DIM = 1024
CLASSES = 64  # letter classes; 0 is a gap between words
SLICE_CHARS = 1 << 18
SLICE_ROWS = 256

_letters: np.ndarray | None = None


def letter_classes() -> np.ndarray:
    """Class of every code point: 0 for other than letters; the 63 others by the lower-cased letter."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint8)
        for c in range(0x34000):
            if not 0xD800 <= c < 0xE000 and (ch := chr(c)).isalpha():
                low = ch.lower()
                table[c] = ord(low) - 96 if len(low) == 1 and "a" <= low <= "z" else 27 + zlib.crc32(low.encode()) % (CLASSES - 27)
        _letters = table
    return _letters


def letter_vectors() -> np.ndarray:
    return np.where(np.random.default_rng(20_24).random((CLASSES, DIM)) < 0.5, -1, 1).astype(np.int8)


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of trigram codes."""
    base = letter_vectors()
    return np.roll(base, 2, 1)[codes // CLASSES**2] * np.roll(base, 1, 1)[codes // CLASSES % CLASSES] * base[codes % CLASSES]


def text_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, trigram code) for every trigram of letters and single gaps, whole texts."""
    table = letter_classes()
    chars = np.frombuffer("\0\0".join(f" {t or ''} " for t in texts).encode("utf-32-le", "replace"), np.uint32)
    classes = table[np.minimum(chars, 0x10FFFF)]
    owner = np.cumsum(np.concatenate(([0], (chars[1:] == 0) & (chars[:-1] == 0)))) if len(texts) > 1 else np.zeros(len(chars), np.int64)
    if owner[-1] + 1 != len(texts):  # texts hold null characters themselves
        sizes = np.array([len(t or "") + 4 for t in texts])
        sizes[-1] -= 2
        owner = np.repeat(np.arange(len(texts)), sizes)
    letter = classes > 0
    keep = letter.copy()  # and the gaps beside a letter
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    classes, owner = classes[keep].astype(np.int64), owner[keep]
    code = (classes[:-2] * CLASSES + classes[1:-1]) * CLASSES + classes[2:]
    ok = (owner[2:] == owner[:-2]) & (classes[1:-1] > 0)
    return owner[:-2][ok], code[ok]


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE_CHARS or i + 1 - start >= SLICE_ROWS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Profiles of all languages of ``docs``: trigram counts are summed over all rows before any vector is made.

    Counts become vectors and are added up on the executors; what reaches the driver is one vector of DIM whole numbers
    per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in _slices(texts):
                owner, code = text_grams(texts[i:j])
                for name in set(langs[i:j]):
                    own = np.array([x == name for x in langs[i:j]])
                    sums.setdefault(name, np.zeros(CLASSES**3, np.int64))
                    sums[name] += np.bincount(code[own[owner]], minlength=CLASSES**3)
        for name, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(s[at])], names=["lang", "code", "n"])

    known = small_batches(docs).where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("t"))
    counts = known.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs, codes, n = np.array(b.column(0).to_pylist(), object), b.column(1).to_numpy(), b.column(2).to_numpy()
            for name in set(langs.tolist()):
                own = np.flatnonzero(langs == name)
                bundle = sums.setdefault(name, np.zeros(DIM, np.int64))
                for at in range(0, len(own), 4096):
                    part = own[at : at + 4096]
                    bundle += n[part] @ gram_vectors(codes[part]).astype(np.int64)
        for name, bundle in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * DIM), pa.array(np.arange(DIM, dtype=np.int32)), pa.array(bundle)], names=["lang", "place", "value"])

    bundles = counts.mapInArrow(add_up, "lang string, place int, value long").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = bundles.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("bundle")).collect()
    return {r["lang"]: np.array([x["value"] for x in r["bundle"]], float) for r in sorted(rows, key=lambda r: r["lang"])}


def predict_texts(texts: list[str | None], names: list[str], profiles: np.ndarray) -> tuple[list[str], list[float]]:
    """``profiles``: unit rows, one per name."""
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    owner, code = text_grams(texts)
    if not len(code) or not names:
        return langs, scores
    used, at = np.unique(code, return_inverse=True)
    counts = np.bincount(owner * len(used) + at, minlength=len(texts) * len(used)).reshape(len(texts), len(used)).astype(np.float32)
    bundle = np.zeros((len(texts), DIM), np.float32)
    for i in range(0, len(used), 2048):
        bundle += counts[:, i : i + 2048] @ gram_vectors(used[i : i + 2048]).astype(np.float32)
    norm = np.sqrt((bundle.astype(float) ** 2).sum(1))
    cosine = bundle.astype(float) @ profiles.T / np.where(norm > 0, norm, 1)[:, None]
    best = cosine.argmax(1)
    some = counts.sum(1) > 0
    for i in np.flatnonzero(some).tolist():
        langs[i], scores[i] = names[best[i]], float(min(1.0, max(0.0, cosine[i, best[i]])))
    return langs, scores


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score)`` of every row: a map, no exchange."""
    names = list(profiles)
    unit = np.array([v / max(np.linalg.norm(v), 1e-12) for v in profiles.values()]).reshape(len(names), DIM)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in _slices(texts):
                langs, scores = predict_texts(texts[i:j], names, unit)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    rows = small_batches(docs).select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double").withColumnRenamed("id", key)


def held_out(key: str = "doc_id") -> Column:
    """The fold that isn't learned from; a null id belongs to no fold and isn't learned from either."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1
