"""Alignment of two tokenizers' ids over a corpus, with an identity-map fast path.

A text is encoded by a byte-level BPE (A, of a space and the text) and a piece
BPE (B, which adds the space itself). Both cut the same bytes, so the offsets at
which tokens of both end cut a text into groups; the A and the B token that end a
group are linked.

Before any text is read, an array gives for each A id the B id of the same bytes
(``identity``). Nearly all groups are one A token and that B token. They never
meet a shuffle as pairs: each task counts them in a vector as long as A's
vocabulary. Only what other groups link, irregular pairs, is counted by pair:
first in the task, then in one shuffle. No irregular pair has the same bytes on
both sides (its group would have been cut before it), so the two counts are of
different pairs, and a one-to-one group of another B id with equal bytes counts as
irregular.

For figures by document, both vectors (counts of identities, best count by B id)
and the most frequent irregular pairs, at most ``HOT`` whatever the corpus, go to
every task; links of rarer pairs are joined by shuffle with their counts, where no
pair has more than a small part of the rows. Encoding happens once; what it gives
is written.

Defined results: a text that is null or empty, or of which either side's token
bytes do not give back the space and the text (e.g. U+2581 in it), has no tokens:
zeros and an empty string. Special tokens' strings in texts are plain text.
Repeated documents each have their row and each count; equal counts are all best;
an empty table gives no rows. Extra columns are not read. Texts are encoded whole;
memory is linear in the longest.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import map_frames, tokenizer_path, written

#: Irregular pairs whose counts every task holds.
HOT = 1 << 18
#: Irregular pairs a task gathers before it hands them on.
GATHERED = 1 << 20
#: Characters of texts that are encoded by one call.
CALL = 1 << 18

# How the byte-level tokenizer cuts a text before merging, and the
# letters on which all versions of the character tables agree.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SETTLED = re.compile("[\x00-\u024f]*")
#: The quick encoder's cuts recurse over white space; longer runs go the other way.
_BLANK_RUN = re.compile(r"(?<!\s)\s{1000}")

_ENCODED = ("row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
            "pairs binary, times binary")


class Vocabularies:
    """Both tokenizers, the bytes of their ids and the map between equal ones."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letter = _byte_letters()
        by_id = {i: s for s, i in self.a.get_vocab().items()}
        self.bytes_a = [bytes(letter.get(c, 63) for c in by_id.get(i, "")) for i in range(max(by_id) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.quick = self._quick(path_a)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        of_bytes: dict[bytes, int] = {}
        for i in sorted(range(len(self.bytes_b)), key=lambda i: (self.b.is_byte(i), i)):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                of_bytes.setdefault(self.bytes_b[i], i)
        self.identity = np.array([of_bytes.get(x, -1) for x in self.bytes_a], np.int64)
        # an id as it stands in the text of the groups: before a neighbour, before the other side
        self.written_a = np.array([[f"{i},", f"{i}|"] for i in range(len(self.bytes_a))], object)
        self.written_b = np.array([[f"{i},", f"{i};"] for i in range(len(self.bytes_b))], object)

    def _quick(self, path: str):
        """A faster encoder of the same vocabulary for texts of settled letters;
        None if the file's merges are not in the order of their ids."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut, merges = spec.get("pre_tokenizer") or {}, [
            m if isinstance(m, list) else m.split(" ") for m in spec["model"].get("merges", [])]
        vocab = spec["model"]["vocab"]
        plain = (spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                 and not cut.get("add_prefix_space") and all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)))
        if not plain:
            return None
        ranks = {self.bytes_a[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("a", pat_str=_CUTS, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(merges) else None

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        quick = [self.quick is not None and _SETTLED.fullmatch(t) is not None and not _BLANK_RUN.search(t)
                 for t in texts]
        slow = iter(self.a.encode_batch([t for t, q in zip(texts, quick) if not q], add_special_tokens=False))
        return [self.quick.encode_ordinary(t) if q else next(slow).ids for t, q in zip(texts, quick)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides of each text; None where they do not give its bytes."""
        done = 0
        while done < len(texts):
            n, size = done, 0
            while n < len(texts) and (n == done or size + len(texts[n]) <= CALL):
                size += len(texts[n])
                n += 1
            spaced = [" " + t for t in texts[done:n]]
            side_a = self._encode_a(spaced)
            side_b = self.b.encode(texts[done:n], num_threads=1)
            for text, ids, b in zip(spaced, side_a, side_b):
                raw = text.encode()
                if b"".join([self.bytes_a[i] for i in ids]) == raw == b"".join([self.bytes_b[i] for i in b]):
                    yield np.array(ids, np.int64), np.array(b, np.int64)
                else:
                    yield None
            done = n

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the A and the B token that end each group."""
        return _common(np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]))

    def text_of(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: each group's ids of both sides in order."""
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        out = np.empty(len(a) + len(b), object)
        before_b = np.concatenate(([0], last_b[:-1] + 1))  # B tokens of earlier groups
        out[np.arange(len(a)) + before_b[group_a]] = self.written_a[a, ends_a]
        out[np.arange(len(b)) + last_a[group_b] + 1] = self.written_b[b, ends_b]
        return "".join(out.tolist())[:-1]


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the two rising sequences have the same values."""
    at = np.searchsorted(b, a)
    both = at < len(b)
    both[both] = b[at[both]] == a[both]
    return np.flatnonzero(both), at[both]


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable
    bytes stand for themselves, all others follow from U+0100 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@functools.lru_cache(maxsize=1)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    """One per process, kept from task to task."""
    return Vocabularies(path_a, path_b)


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model")


def encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document (numbered by ``row``): sizes, the digest of its groups, and
    its distinct links (a * B's size + b) with how often each occurs, packed as
    little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(path_a, path_b)
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                            ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()),
                            ("times", pa.binary())])
        size_b = len(v.bytes_b)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            of_text = v.encode([t for t in texts if t])
            rows: list[tuple] = []
            for text in texts:
                ids = next(of_text) if text else None
                if ids is None:
                    rows.append((0, 0, 0, "", b"", b""))
                    continue
                a, b = ids
                last_a, last_b = v.groups(a, b)
                digest = hashlib.sha256(v.text_of(a, b, last_a, last_b).encode()).hexdigest()
                pairs, times = np.unique(a[last_a] * size_b + b[last_b], return_counts=True)
                rows.append((len(a), len(b), len(last_a), digest, pairs.astype("<u4").tobytes(),
                             times.astype("<u4").tobytes()))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 6, list(schema)[2:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=schema)

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       "text").mapInArrow(run, _ENCODED)


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4").astype(np.int64)


def counted(made: DataFrame, identity: np.ndarray, size_b: int) -> DataFrame:
    """Partial counts by task: ``a`` of an identity, or ``pair`` of an irregular
    pair, and ``n``."""
    shared = made.sparkSession.sparkContext.broadcast(identity)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        identity = shared.value
        of_id = np.zeros(len(identity), np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            pairs = np.concatenate([p for p, _ in held]) if held else np.zeros(0, np.int64)
            found, at = np.unique(pairs, return_inverse=True)
            n = np.zeros(len(found), np.int64)
            np.add.at(n, at, np.concatenate([t for _, t in held]) if held else np.zeros(0, np.int64))
            return found, n

        def rows(name, keys, n):
            return pd.DataFrame({"a": None, "pair": None, "n": n} | {name: keys}).astype(
                {"a": "Int64", "pair": "Int64"})

        for frame in frames:
            for packed, times in zip(frame["pairs"], frame["times"]):
                pairs, n = _numbers(packed), _numbers(times)
                same = identity[pairs // size_b] == pairs % size_b
                of_id[pairs[same] // size_b] += n[same]  # distinct within a document
                held.append((pairs[~same], n[~same]))
                size += len(held[-1][0])
                if size > GATHERED:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > GATHERED // 2:
                        yield rows("pair", *held[0])
                        held, size = [], 0
        yield rows("pair", *merged())
        seen = np.flatnonzero(of_id)
        yield rows("a", seen, of_id[seen])

    return made.select("pairs", "times").mapInPandas(run, "a long, pair long, n long")


def _counts(made: DataFrame, paths: tuple[str, str]):
    """The vector of identity counts and the table of irregular pairs' counts."""
    v = vocabularies(*paths)
    partial = written(counted(made, v.identity, len(v.bytes_b)), "link-counts")
    of_id = np.zeros(len(v.bytes_a), np.int64)
    for r in partial.filter("a is not null").groupBy("a").agg(F.sum("n").alias("n")).collect():  # A's vocabulary at most
        of_id[r.a] = r.n
    pairs = written(partial.filter("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    return of_id, pairs


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The corpus-wide table of links: a, b, n, and whether they are the same bytes by the map."""
    paths = _paths(path_a, path_b)
    v = vocabularies(*paths)
    of_id, pairs = _counts(written(encoded(docs, *paths), "aligned"), paths)
    size_b = len(v.bytes_b)
    same = [(int(a), int(v.identity[a]), int(of_id[a]), True) for a in np.flatnonzero(of_id)]
    irregular = pairs.select(F.expr(f"pair div {size_b}").alias("a"), (F.col("pair") % size_b).alias("b"), "n",
                             F.lit(False).alias("same"))
    return irregular.unionByName(docs.sparkSession.createDataFrame(same, "a long, b long, n long, same boolean"))


def report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, hot: int = HOT) -> DataFrame:
    """One row per document: its tokens, groups and links with corpus-wide figures."""
    spark = docs.sparkSession
    paths = _paths(path_a, path_b)
    v = vocabularies(*paths)
    size_b = len(v.bytes_b)
    made = written(encoded(docs, *paths), "aligned")
    of_id, pairs = _counts(made, paths)

    best = np.zeros(size_b, np.int64)
    np.maximum.at(best, v.identity[of_id > 0], of_id[of_id > 0])
    for r in pairs.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("n")).collect():  # B's vocabulary at most
        best[r.b] = max(best[r.b], r.n)
    # the least power of two that at most `hot` pairs reach; a row a power
    reach, by_power = 0, {r.p: r["count"] for r in pairs.groupBy(F.floor(F.log2("n")).alias("p")).count().collect()}
    limit = max(by_power, default=0) + 1
    while limit > 0 and reach + by_power.get(limit - 1, 0) <= hot:
        limit -= 1
        reach += by_power.get(limit, 0)
    frequent = pairs.filter(F.floor(F.log2("n")) >= limit).orderBy("pair").toPandas()  # `hot` rows at most
    shared = spark.sparkContext.broadcast((v.identity, of_id, best, frequent["pair"].to_numpy(np.int64),
                                           frequent["n"].to_numpy(np.int64)))

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        identity, of_id, best, hot_pairs, hot_n = shared.value
        for frame in frames:
            rows = []
            for packed, packed_times in zip(frame.pop("pairs"), frame.pop("times")):
                codes, times = _numbers(packed), _numbers(packed_times)
                a, b = codes // size_b, codes % size_b
                n = np.where(identity[a] == b, of_id[a], 0)
                known = n > 0
                if len(hot_pairs):
                    at = np.minimum(np.searchsorted(hot_pairs, codes), len(hot_pairs) - 1)
                    hit = hot_pairs[at] == codes
                    n, known = np.where(hit, hot_n[at], n), known | hit
                rows.append((times[known & (n == best[b])].sum(), (times * n).sum(), codes[~known], times[~known]))
            yield frame.assign(**{c: list(x) for c, x in zip(("n_best", "count_sum", "rare", "rare_times"),
                                                             zip(*rows) if rows else [()] * 4)})

    head = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    names = [c.split()[0] for c in head.strip(", ").split(", ")]
    weighed = map_frames(made, "doc_id", weigh, head + "n_best long, count_sum long, rare array<long>, rare_times array<long>")
    if limit > 0:  # pairs beyond the hot ones
        weighed = written(weighed, "weighed")
        top = np.flatnonzero(best)
        bests = spark.createDataFrame(pd.DataFrame({"b": top, "best": best[top]}), "b long, best long")
        rare = weighed.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("x")).select(
            "row", F.col("x.rare").alias("pair"), F.col("x.rare_times").alias("times"))
        counts = pairs.filter(F.floor(F.log2("n")) < limit).withColumn("b", F.col("pair") % size_b).join(
            F.broadcast(bests), "b")  # a row a B id
        sums = rare.join(counts, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"))
        weighed = weighed.join(sums, "row", "left").select(
            *names, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))
    return weighed.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum",
                          "groups_sha256")
