"""Language identification with hyperdimensional profiles.

Every letter slot has a random +-1 vector.  A trigram's vector binds (multiplies)
its three letter vectors, permuted (rolled) by their place.  A document's vector
bundles (adds) its trigrams' vectors; a language's prototype bundles those of all
its training documents.  The language of the nearest prototype by cosine wins.

Letters are lower-cased code points for which ``str.isalpha`` holds, put into
``SLOTS`` slots by code point; everything else separates words.  Any script
works; letters that share a slot share a vector.

Text of no learned language is told by its cosine.  A text's vector is its language's
direction, which grows with its trigrams n, plus noise, which grows with the root of
the sum of their squared counts, so the cosine is about sqrt(m / (m + b)) with
m = n^2 / sum of squared counts and some b.  ``learn_bound`` takes b from all training
documents, each against the others of its language, as the quantile ``KEPT_SHARE``;
``accepted`` keeps a text whose cosine is that of this b or better.

Training takes one row of sums per task and language through a shuffle; the
driver holds the prototypes only (languages x DIM numbers).

Defined results: a null text, or one without letters, is ``und`` with score 0;
so is every text when nothing was learned; ties go to the first language in
order; null languages teach nothing; rows without an id are held out; repeated
rows count each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.common import held_out
from sacctlens.llm.textkit import SMALL_STEP, lean, record, steps

DIM = 512
#: Letter slots; prime, so that the alphabets in use keep their letters apart.
SLOTS = 101
BASE = SLOTS + 1
UNKNOWN = "und"
SEED = 20240501
#: Trigram vectors kept per task.
KEPT = 16384
#: Trigrams whose vectors are summed at once.
BOUND_AT_ONCE = 2048
#: Share of the training documents that the bound of ``accepted`` lets pass, and bins per power of two for finding it.
KEPT_SHARE = 0.995
BINS = 64

_slot_table: np.ndarray | None = None


def slot_table() -> np.ndarray:
    """Slot of every code point: 0 for what is no letter."""
    global _slot_table
    if _slot_table is None:
        _slot_table = np.array([1 + c % SLOTS if chr(c).isalpha() else 0 for c in range(0x110000)], dtype=np.uint8)
    return _slot_table


def letter_vectors(dim: int = DIM) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 2, size=(BASE, dim)) * 2 - 1).astype(np.int8)


def bind(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """+-1 vectors of trigram codes."""
    first, second, third = codes // (BASE * BASE), codes // BASE % BASE, codes % BASE
    return np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second] * letters[third]


def trigrams(text: str) -> np.ndarray:
    """Codes of the trigrams of a text; runs of non-letters are one gap, also at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    slots = np.zeros(len(points) + 2, np.int32)
    slots[1:-1] = slot_table()[points]
    solid = slots > 0
    keep = solid.copy()
    keep[0] = True
    keep[1:] |= solid[:-1]  # the first gap after a letter stays
    slots = slots[keep]
    if len(slots) < 3:
        return np.zeros(0, np.int32)
    return (slots[:-2] * BASE + slots[1:-1]) * BASE + slots[2:]


class Vectors:
    """Trigram vectors of one task, kept by code."""

    def __init__(self, dim: int = DIM, kept: int = KEPT):
        self.letters, self.kept = letter_vectors(dim), kept
        self.row = np.full(BASE ** 3, -1, np.int32)
        self.rows = np.zeros((kept, dim), np.int8)
        self.n = 0

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of counts x vectors; exact while counts are below 2^24."""
        at = self.row[codes]
        new = codes[at < 0]
        if len(new):
            if self.n + len(new) > self.kept:
                self.row[:], self.n = -1, 0
                if len(codes) > self.kept:
                    half = len(codes) // 2
                    return self.bundle(codes[:half], counts[:half]) + self.bundle(codes[half:], counts[half:])
                new = codes
            self.rows[self.n:self.n + len(new)] = bind(new, self.letters)
            self.row[new] = np.arange(self.n, self.n + len(new), dtype=np.int32)
            self.n += len(new)
            at = self.row[codes]
        return counts.astype(np.float32) @ self.rows[at].astype(np.float32)


def _labelled(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null and text is not null")


def totals(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages in order and the sums of their labelled texts' vectors."""
    rows = _labelled(docs, text_col, lang_col)

    @lean
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, total = letter_vectors(dim), {}
        for batch in batches:
            for lo, hi in steps(batch, most=SMALL_STEP):
                part = batch.slice(lo, hi - lo)
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                texts = part.column("text")
                for lang in sorted(set(langs)):
                    found = [trigrams(texts[int(i)].as_py()) for i in np.flatnonzero(langs == lang)]
                    codes, n = np.unique(np.concatenate(found), return_counts=True)
                    acc = total.setdefault(lang, np.zeros(dim, np.int64))
                    for at in range(0, len(codes), BOUND_AT_ONCE):
                        acc += (n[at:at + BOUND_AT_ONCE].astype(np.float64) @ bind(codes[at:at + BOUND_AT_ONCE], letters).astype(np.float64)).astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    parts = rows.mapInArrow(sums, "lang string, v array<long>")
    got = (parts.select("lang", F.posexplode("v").alias("pos", "x")).groupBy("lang", "pos").agg(F.sum("x").alias("x"))
           .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("v")).orderBy("lang").collect())
    langs = [r.lang for r in got]
    return langs, np.array([[x.x for x in r.v] for r in got], np.float64).reshape(len(langs), dim)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes (unit length) from labelled texts."""
    langs, sums = totals(docs, text_col, lang_col, dim)
    return langs, _unit(sums)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of a text's trigrams."""
    codes = np.sort(trigrams(text or ""))
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(first, append=len(codes))


def evidence(counts: np.ndarray) -> float:
    """The number of trigrams, as far as they are not repetitions."""
    n = counts.astype(np.float64)
    return float(n.sum() ** 2 / (n @ n))


def learn_bound(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM,
                share: float = KEPT_SHARE) -> tuple[list[str], np.ndarray, float]:
    """As ``learn``, and the bound for ``accepted``: infinite when no document has others of its language."""
    langs, sums = totals(docs, text_col, lang_col, dim)
    place = {lang: k for k, lang in enumerate(langs)}

    @lean
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, found = Vectors(dim), {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                codes, counts = counted(text.as_py())
                if not len(codes):
                    continue
                v = vectors.bundle(codes, counts).astype(np.float64)
                others = sums[place[lang.as_py()]] - v
                size = np.linalg.norm(others) * np.linalg.norm(v)
                if size > 0:
                    cosine = min(1.0, max(1e-3, float(others @ v) / size))
                    b = math.ceil(BINS * math.log2(max(1.0, evidence(counts) * (1 / cosine ** 2 - 1))))
                    found[b] = found.get(b, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["bin", "n"])

    got = sorted(_labelled(docs, text_col, lang_col).mapInArrow(bins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect())
    upto = np.cumsum([r.n for r in got])
    bound = 2.0 ** (got[int(np.searchsorted(upto, share * upto[-1]))].bin / BINS) if got else math.inf
    return langs, _unit(sums), bound


def nearest_prototype(text: str | None, vectors: Vectors, langs: list[str], matrix: np.ndarray) -> tuple[str, float]:
    """The language whose prototype (column of ``matrix``) is nearest, and the cosine (0 to 1)."""
    return _nearest(*counted(text), vectors, langs, matrix)


def _nearest(codes: np.ndarray, counts: np.ndarray, vectors: Vectors, langs: list[str], matrix: np.ndarray) -> tuple[str, float]:
    if not len(codes) or not langs:
        return UNKNOWN, 0.0
    v = vectors.bundle(codes, counts)
    norm = float(np.sqrt(v.astype(np.float64) @ v))
    if norm == 0:
        return UNKNOWN, 0.0
    cosines = v @ matrix / norm
    best = int(np.argmax(cosines))
    return langs[best], min(1.0, max(0.0, float(cosines[best])))


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: the nearest prototype and its cosine (0 to 1)."""
    dim = prototypes.shape[1] if len(langs) else DIM
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    @lean
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, matrix = Vectors(dim), prototypes.T.astype(np.float32)
        for batch in batches:
            names, scores = zip(*(nearest_prototype(t.as_py(), vectors, langs, matrix) for t in batch.column("text"))) if len(batch) else ((), ())
            yield record(schema, doc_id=batch.column("doc_id"), lang_pred=list(names), score=list(scores))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        nearest, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that are not held out."""
    langs, prototypes = learn(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs, langs, prototypes).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, langs: list[str], prototypes: np.ndarray, text_col: str = "text", least: float = 0.0, bound: float = math.inf) -> DataFrame:
    """The documents, all columns, whose nearest prototype has a cosine above ``least`` and not below that of ``bound``."""
    @lean
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, matrix = Vectors(prototypes.shape[1]), prototypes.T.astype(np.float32)
        for batch in batches:
            for lo, hi in steps(batch, text_col, SMALL_STEP):
                part, kept = batch.slice(lo, hi - lo), []
                for text in part.column(text_col):
                    codes, counts = counted(text.as_py())
                    label, score = _nearest(codes, counts, vectors, langs, matrix)
                    kept.append(label != UNKNOWN and score > least and score ** 2 * (1 + bound / evidence(counts)) >= 1)
                yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
