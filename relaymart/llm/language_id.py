"""Language ID with hyperdimensional n-gram profiles.

Every letter has a random vector of +1/-1 (seeded by its code point, so any
script works without a table). An n-gram is its letters' vectors, the first
rolled furthest, bound by multiplication; a text is the bundle (sum) of its
n-grams, a language the bundle of its texts at unit length. A text's language
is the prototype of largest cosine, which is also the score (at least 0).

Prototypes and limits are learned from every labelled text; the prototypes'
sums are of integers, so that they do not depend on the order of tasks. Every document is scored over its whole text; a text longer than a
block is bundled block by block.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as are all texts if nothing could be learned; ties go to the first language by
name; rows with a null id are neither held out nor learned from; repeated
documents each have their row.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import map_frames, map_texts, remainder

DIM = 1024
GRAM = 3
UNKNOWN = "und"
#: Texts bundled together, in letters.
BLOCK = 200_000
#: A text of any length whose best cosine is at least this is in a learned language.
MIN_SCORE = 0.08
#: Share of labelled texts that may lie below what their length's limit is taken from.
LOWEST = 0.01
_SCALE = 1 << 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point's lower-case letter, or a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


@functools.lru_cache(maxsize=200_000)
def _letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng(code).integers(0, 2, DIM, dtype=np.int8) * 2 - 1


def _gram_keys(text: str | None) -> np.ndarray | None:
    """The text's n-grams as numbers; None without a letter. Runs of anything
    but letters are one blank, also before and after the text."""
    if not text:
        return None
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate(([32], codes, [32])).astype(np.int64)
    blank = codes == 32
    codes = codes[~(blank & np.concatenate(([False], blank[:-1])))]
    if len(codes) < GRAM:
        return None
    keys = np.zeros(len(codes) - GRAM + 1, np.int64)
    for i in range(GRAM):
        keys = keys << 21 | codes[i:len(codes) - GRAM + 1 + i]
    return keys


def _gram_vectors(keys: np.ndarray) -> np.ndarray:
    out = np.ones((len(keys), DIM), np.int8)
    for i in range(GRAM):
        codes, at = np.unique(keys >> 21 * (GRAM - 1 - i) & 0x1FFFFF, return_inverse=True)
        rolled = np.stack([np.roll(_letter_vector(c), GRAM - 1 - i) for c in codes.tolist()])
        out *= rolled[at]
    return out.astype(np.float32)


def bundles(texts: list[str | None]) -> np.ndarray:
    """Unit vectors of the texts; zero where there is no letter."""
    out = np.zeros((len(texts), DIM), np.float32)
    rows, keys, size = [], [], 0

    def add() -> None:
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        row = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
        for low in range(0, len(distinct), 8192):
            part = distinct[low:low + 8192]
            here = (at >= low) & (at < low + len(part))
            cells = row[here] * len(part) + at[here] - low
            counts = np.bincount(cells, minlength=len(rows) * len(part)).reshape(len(rows), -1)
            np.add.at(out, rows, counts.astype(np.float32) @ _gram_vectors(part))

    for i, text in enumerate(texts):
        found = _gram_keys(text)
        if found is None:
            continue
        for at in range(0, len(found), BLOCK):
            part = found[at:at + BLOCK]
            if size and (size + len(part) > BLOCK or len(rows) >= 64):
                add()
                rows, keys, size = [], [], 0
            rows.append(i)
            keys.append(part)
            size += len(part)
    if keys:
        add()
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def _labelled(docs: DataFrame, learnable: Column) -> DataFrame:
    """lang and text of every row to learn from."""
    return docs.filter(learnable & F.col("lang").isNotNull()).select("lang", "text")


def learn(docs: DataFrame, learnable: Column) -> tuple[list[str], np.ndarray]:
    """Languages by name and their prototypes (unit rows), from all rows of
    which ``learnable`` is true and lang is not null."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, group in frame.groupby("lang"):
                whole = np.rint(bundles(list(group["text"])) * _SCALE).astype(np.int64).sum(axis=0)
                total[lang] = total.get(lang, 0) + whole
        yield pd.DataFrame([(lang, v.tolist()) for lang, v in total.items()], columns=["lang", "v"])

    parts = _labelled(docs, learnable).mapInPandas(sums, "lang string, v array<long>")
    summed = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    by_language = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    rows = by_language.select("lang", F.transform("v", lambda s: s["x"]).alias("v")).orderBy("lang").collect()  # a row a language
    names = [r.lang for r in rows]
    out = np.array([r.v for r in rows], np.float64).reshape(len(rows), DIM)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return names, (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def _length(text: str | None) -> int:
    """The power of two of a text's n-grams; -1 without a letter."""
    keys = _gram_keys(text)
    return -1 if keys is None else len(keys).bit_length() - 1


def limits(docs: DataFrame, learnable: Column, names: list[str], prototypes: np.ndarray) -> np.ndarray:
    """The least cosine of a text in a learned language, by :func:`_length`, from
    the cosines of all labelled texts."""
    shared = docs.sparkSession.sparkContext.broadcast((names, prototypes))

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            _, scores = identify(list(frame["text"]), *shared.value)
            yield pd.DataFrame({"length": [_length(t) for t in frame["text"]], "score": scores})

    measured = _labelled(docs, learnable).select("text").mapInPandas(measure, "length int, score double")
    low = measured.filter("length >= 0").groupBy("length").agg(
        F.percentile_approx("score", LOWEST, 1000).alias("low"), F.count(F.lit(1)).alias("n"))
    out = np.zeros(64)
    for r in low.collect():  # a row a power of two
        out[r.length] = min(MIN_SCORE, r.low / 2 * min(1.0, r.n * LOWEST))
    return np.maximum.accumulate(out)


def identify(texts: list[str | None], names: list[str], prototypes: np.ndarray) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if names:
        vectors = bundles(texts)
        cosines = vectors @ prototypes.T
        for i in np.flatnonzero(vectors.any(axis=1)).tolist():
            k = int(cosines[i].argmax())
            langs[i], scores[i] = names[k], float(min(1.0, max(0.0, cosines[i, k])))
    return langs, scores


def predict(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)) if held_out is None else held_out
    names, prototypes = learn(docs, ~held_out & F.col("doc_id").isNotNull())
    shared = docs.sparkSession.sparkContext.broadcast((names, prototypes))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            langs, scores = identify(list(frame.pop("text")), *shared.value)
            yield frame.assign(lang_pred=langs, score=scores)

    return map_frames(docs.select("doc_id", held_out.alias("held_out"), "text"), "doc_id", run,
                      "doc_id long, held_out boolean, lang_pred string, score double")


def in_known_language(docs: DataFrame) -> DataFrame:
    """The documents without those that have no letter or are like no learned
    language for texts of their length. All columns as they are."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    learnable = ~held_out & F.col("doc_id").isNotNull()
    names, prototypes = learn(docs, learnable)
    least = limits(docs, learnable, names, prototypes)
    shared = docs.sparkSession.sparkContext.broadcast((names, prototypes, least))

    def make():
        def of_texts(texts: list[str | None]) -> list[tuple | None]:
            names, prototypes, least = shared.value
            _, scores = identify(texts, names, prototypes)
            lengths = map(_length, texts)
            return [(t,) if n >= 0 and (not names or s >= least[n]) else None for t, n, s in zip(texts, lengths, scores)]

        return of_texts

    return map_texts(docs, "text", make)
