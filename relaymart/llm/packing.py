"""Packing token sequences by best-fit decreasing.

A document's ids are cut into full windows; what is left over (shorter than a
window) is placed whole, longest first, into the open window whose remaining
capacity fits tightest.

All leftovers of one length are alike, so the placement needs only how many
there are of each length: at most ``window`` numbers, whatever the corpus. The
driver runs best-fit decreasing over these counts with a segment tree indexed
by remaining capacity (a leaf holds the windows open at that capacity) and gets
a plan of straight-line runs: the k-th leftover of length s goes to window
w0 + (k - k0) // q at offset o + (k - k0) % q * s. The result is that of the
item-by-item method on the whole corpus. Pieces are numbered within their
length by a running count per task and a window sum of the tasks' counts, so
no length, however frequent, meets in one task.

Defined results: a null or empty text is the end id alone; each row of repeated
documents is packed for itself; an empty table gives no pieces. The plan's size
is bounded by the window length, not by the data.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import map_frames, tokenizer_path, written

WINDOW = 4096
END_ID = 2
#: Words whose ids a process remembers; beyond that it forgets and starts anew.
REMEMBERED = 1_200_000


#: Text of characters whose lower case, composition and kind are settled one by
#: one: blanks, printable ASCII and the Latin-1 letters.
_PLAIN = re.compile("[\n -~À-ÖØ-öø-ÿ]*")
#: The tokenizer's own cuts (a fixed value of its file), for such characters.
_RUN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \n]+")


class WordIds:
    """A text's ids (little-endian unsigned 32-bit), each word encoded once.

    The tokenizer drops white space and treats runs of letters, single digits
    and runs of other signs each for itself, so a text's ids are those of its
    runs in order. What a process has encoded it remembers, up to a bound.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            parts = _RUN.findall(text.lower())
            self._learn(set(parts).difference(self.known))
        else:  # other scripts and special tokens: stretches between blanks
            parts = text.replace("\n", " ").split(" ")
            for part in set(parts).difference(self.known):
                self.known[part] = self._encode(part)
        return b"".join(map(self.known.__getitem__, parts))

    def _learn(self, new: set[str]) -> None:
        if not new:
            return
        runs = list(new)
        encoded = self.tokenizer.encode(" ".join(runs), add_special_tokens=False)
        ids, word = np.array(encoded.ids, "<u4"), np.array(encoded.word_ids)
        ends = np.flatnonzero(np.diff(word, append=-1)) + 1
        assert len(ends) == len(runs)
        start = 0
        for run, end in zip(runs, ends.tolist()):
            self.known[run] = ids[start:end].tobytes()
            start = end

    def _encode(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One per worker process, kept from task to task."""
    return WordIds(path)


def pieces(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Full windows and leftovers of each document; task and nth number the
    pieces of one length within the task that made them."""
    path = path or tokenizer_path()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        ids_of, task = word_ids(path), TaskContext.get().partitionId()
        made = np.zeros(window + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = ids_of.of(text) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    rows.append((doc_id, start, length, crc, total, task, made[length]))
                    made[length] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"])

    return map_frames(
        docs.select("doc_id", "text"), "doc_id", cut,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long")


class OpenWindows:
    """Windows by remaining capacity: stacks of (first window, count) at the
    leaves of a segment tree that finds the tightest capacity in O(log)."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.stacks: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def _set(self, capacity: int) -> None:
        node = capacity + self.leaves
        self.tree[node] = len(self.stacks[capacity])
        while node > 1:
            node //= 2
            self.tree[node] = self.tree[2 * node] + self.tree[2 * node + 1]

    def add(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.stacks[capacity].append((first, count))
            self._set(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        group = self.stacks[capacity].pop()
        self._set(capacity)
        return group

    def tightest(self, size: int) -> int | None:
        """The smallest capacity of at least ``size`` at which a window is open."""
        node = size + self.leaves
        if self.tree[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit(counts: dict[int, int], window: int = WINDOW) -> pd.DataFrame:
    """Best-fit decreasing over counts of lengths, as a plan of runs: length,
    rank0 (the run's first piece), window0, per_window, offset0."""
    openings, used, plan = OpenWindows(window), 0, []
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            capacity = openings.tightest(size)
            if capacity is None:
                first, count, capacity = used, -(-left // (window // size)), window
                used += count
            else:
                first, count = openings.take(capacity)
            each = capacity // size
            full = min(count, left // each)
            last = min(each, left - full * each) if full < count else 0
            plan.append((size, rank, first, each, window - capacity))
            placed = full * each + last
            openings.add(capacity - each * size, first, full)
            if last:
                openings.add(capacity - last * size, first + full, 1)
            rest = full + (last > 0)
            openings.add(capacity, first + rest, count - rest)
            rank, left = rank + placed, left - placed
    return pd.DataFrame(plan, columns=["length", "rank0", "window0", "per_window", "offset0"])


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset (gapless from 0 within a sequence)."""
    spark = docs.sparkSession
    made = written(pieces(docs, window, path), "pieces")
    by_task = made.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    by_task = written(by_task, "piece-counts")
    # at most `window` rows
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(best_fit(counts, window))
    from pyspark.sql import Window as W

    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    base = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = made.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = shared.value.sort_values(["length", "rank0"], ignore_index=True)
        of_length = {n: (g.index[0], g["rank0"].to_numpy()) for n, g in plan.groupby("length")}
        columns = {c: plan[c].to_numpy() for c in plan.columns}
        for frame in frames:
            lengths, ranks = frame["length"].to_numpy(), frame["rank"].to_numpy()
            run = np.zeros(len(frame), np.int64)
            for n in np.unique(lengths):
                first, starts = of_length[n]
                here = lengths == n
                run[here] = first + np.searchsorted(starts, ranks[here], "right") - 1
            k = ranks - columns["rank0"][run]
            each = columns["per_window"][run]
            frame["sequence_id"] = columns["window0"][run] + k // each
            frame["offset"] = columns["offset0"][run] + k % each * lengths
            yield frame[OUTPUT]

    return map_frames(
        ranked.select(*OUTPUT[:5], "rank"), "doc_id", place,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


OUTPUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
