"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

score(x) = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pairwise
sum is computed in time linear in the features present by
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Features: counts of the words hashed to ``BUCKETS`` places (unit length in all),
one place each for the bin of every structure statistic, and for the size class
of the metadata n_chars and whether it agrees with the text. Labels, lang,
source and doc_id are no features.

Learning takes at most about ``SAMPLE`` labelled rows, chosen by hash. Each of
``SHARDS`` tasks descends on its share from common parameters, the driver
averages the parameters (a fixed size), ``ROUNDS`` times. Scoring streams every
whole text.

Defined results: a null text is an empty one, which has a score as any other; a
null n_chars is a class of its own; with nothing to learn from every score is
0.5; a null doc_id is neither held out nor learned from; label rows that are
null are left out, repeated ones and repeated documents are learned from once;
each document row has its row.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import map_frames, remainder, words, written

BUCKETS = 1 << 15
BINS = 12
FACTORS = 8
SAMPLE = 8192
SHARDS = 4
ROUNDS = 3
EPOCHS = 2
RATE = 0.1
DECAY = 1e-4
BIN_WEIGHT = 0.35

_KINDS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (32, 9),
          "mark": b"!?", "bar": b"|", "sign": b"#$%&*+<=>@[]^_`{}~\\/", "stop": b".,;:", "wide": range(128, 256)}
_KIND_OF = np.array([[b in kind for kind in _KINDS.values()] for b in range(256)], np.float64)
STATISTICS = (*_KINDS, "lines", "same_lines", "distinct", "repeat", "top_word", "word_length", "length")
PLACES = BUCKETS + BINS * len(STATISTICS) + 64


def _bin(share: float) -> int:
    """Finer towards 0: 0, then bins of doubling shares from 1/512 on."""
    return 0 if share <= 0 else min(BINS - 1, max(1, 11 + math.floor(math.log2(min(share, 1)))))


def features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the features present."""
    text = text or ""
    ws = words(text)
    counts = Counter(ws)
    hashed: dict[int, int] = {}
    for w, c in counts.items():
        place = zlib.crc32(w) % BUCKETS
        hashed[place] = hashed.get(place, 0) + c
    values = np.log1p(np.fromiter(hashed.values(), np.float64, len(hashed)))
    norm = float(np.linalg.norm(values))
    values = values / norm if norm else values
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shares = (np.bincount(raw, minlength=256) @ _KIND_OF / max(1, len(raw))).tolist()
    lines = [line for line in text.split("\n") if line]
    n = len(ws)
    shares += [
        min(1.0, 20 * len(lines) / max(1, len(text))),
        1 - len(set(lines)) / max(1, len(lines)),
        len(counts) / max(1, n),
        sum(map(operator.eq, ws, ws[1:])) / max(1, n - 1),
        max(counts.values(), default=0) / max(1, n),
        min(1.0, sum(map(len, ws)) / max(1, n) / 32),
        min(1.0, math.log2(len(text) + 1) / 24),
    ]
    binned = [BUCKETS + BINS * i + (round(s * (BINS - 1)) if STATISTICS[i] in _EVEN else _bin(s))
              for i, s in enumerate(shares)]
    known = n_chars is not None and n_chars == n_chars and n_chars >= 0
    size = min(31, int(n_chars).bit_length()) if known else 32
    agrees = 33 + (int(n_chars) == len(text)) if known else 35
    binned += [PLACES - 64 + size, PLACES - 64 + agrees]
    return (np.array([*hashed, *binned], np.int64),
            np.concatenate((values, np.full(len(binned), BIN_WEIGHT))))


_EVEN = {"upper", "lower", "blank", "wide", "lines", "same_lines", "distinct", "word_length", "length"}


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    @classmethod
    def start(cls) -> Machine:
        v = np.random.default_rng(7).normal(0, 0.02, (PLACES, FACTORS))
        return cls(0.0, np.zeros(PLACES), v)

    def margin(self, places: np.ndarray, values: np.ndarray) -> float:
        v = self.v[places]
        total = values @ v
        pairs = 0.5 * float(total @ total - (values * values) @ (v * v).sum(axis=1))
        return self.w0 + float(self.w[places] @ values) + pairs

    def score(self, text: str | None, n_chars: float | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.margin(*features(text, n_chars))))))

    def descend(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, seed: int) -> None:
        """Stochastic descent of the log loss with per-place step sizes."""
        rng, g0 = np.random.default_rng(seed), 1.0
        gw, gv = np.ones(PLACES), np.ones((PLACES, FACTORS))
        for _ in range(epochs):
            for i in rng.permutation(len(rows)).tolist():
                places, x, label = rows[i]
                v = self.v[places]
                total = x @ v
                margin = self.w0 + float(self.w[places] @ x) \
                    + 0.5 * float(total @ total - (x * x) @ (v * v).sum(axis=1))
                d = 1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))) - label
                g0 += d * d
                self.w0 -= RATE * d / math.sqrt(g0)
                step = d * x + DECAY * self.w[places]
                gw[places] += step * step
                self.w[places] -= RATE * step / np.sqrt(gw[places])
                step = d * (x[:, None] * total - v * (x * x)[:, None]) + DECAY * v
                gv[places] += step * step
                self.v[places] -= RATE * step / np.sqrt(gv[places])


def _trainer(shared, seed: int):
    """Descends on one shard's rows from the shared machine."""

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "label"])
        own = Machine(shared.value.w0, shared.value.w.copy(), shared.value.v.copy())
        data = [(np.asarray(p, np.int64), np.asarray(x), y) for p, x, y in
                zip(frame["places"], frame["vals"], frame["label"])]
        own.descend(data, EPOCHS, seed)
        flat = np.concatenate(([own.w0], own.w, own.v.ravel())).astype(np.float32)
        return pd.DataFrame({"n": [len(frame)], "p": [flat.tobytes()]})

    return train


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE) -> Machine:
    """A machine learned from labelled documents for which ``learnable`` (of
    doc_id) holds."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label")).filter(
        learnable & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    total = known.count()
    if not total:
        return Machine(0.0, np.zeros(PLACES), np.zeros((PLACES, FACTORS)))
    machine = Machine.start()
    share = int(min(1.0, sample / total) * 2**31)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < F.lit(share))
    # at most about `sample` ids: bounded by the parameter
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id").distinct()

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(int(doc_id), *map(np.ndarray.tolist, features(text, n)), label) for doc_id, text, n, label in
                   zip(frame["doc_id"], frame["text"], frame["n_chars"], frame["label"])]
            yield pd.DataFrame(out, columns=["doc_id", "places", "vals", "label"])

    found = rows.mapInPandas(extract, "doc_id long, places array<long>, vals array<double>, label int")
    found = written(found.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS))), "fm-sample")
    for r in range(ROUNDS):
        train = _trainer(spark.sparkContext.broadcast(machine), r)
        parts = found.groupBy("shard").applyInPandas(train, "n long, p binary").collect()  # SHARDS rows
        if not parts:  # no label meets a document of the sample
            return Machine(0.0, np.zeros(PLACES), np.zeros((PLACES, FACTORS)))
        parts.sort(key=lambda p: bytes(p.p))
        flat = sum(np.frombuffer(p.p, np.float32).astype(np.float64) * p.n for p in parts) / sum(p.n for p in parts)
        machine = Machine(float(flat[0]), flat[1:1 + PLACES].copy(), flat[1 + PLACES:].reshape(PLACES, FACTORS).copy())
    return machine


def classify(docs: DataFrame, labels: DataFrame, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)) if held_out is None else held_out
    machine = learn(docs, labels, ~held_out)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scores = [shared.value.score(t, n) for t, n in zip(frame.pop("text"), frame.pop("n_chars"))]
            yield frame.assign(score=scores, predicted=[int(s >= 0.5) for s in scores])

    rows = docs.select("doc_id", held_out.alias("held_out"), "text", F.col("n_chars").cast("double"))
    return map_frames(rows, "doc_id", run, "doc_id long, held_out boolean, score double, predicted int")
