"""Benchmark decontamination with a generalised suffix automaton of the items.

The items' normalised words build one automaton; each document's words stream
through it while the length of the longest match ending at every word is kept.
A match of at least ``window`` words marks its last ``window`` words as hit (so
a longer match marks all of its words, step by step); an item shorter than the
window is hit where it occurs whole.

Cost: one dictionary step per document word (amortised), no candidate pairs.
Size: words are numbered, and a state is a few integers in arrays; only states with
several ways on have a table. The automaton holds at most ``max_words`` item words
(checked). A larger benchmark is split into several automata of that bound, each
applied in its own scan of the texts, which gives only the spans and items of those
that are hit; they merge by text before anything is cut, so no scan writes texts.

Defined results: a null or empty text has no words and no hits; a null item
text gives no window; items with equal texts all count; items with the same id
count once, a null id counts as the id "null"; repeated documents each keep
their row; with no items nothing is hit.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import map_text, word_spans, words, written

WINDOW = 10
#: Item words in one automaton (40 to 100 bytes each).
MAX_WORDS = 2_000_000


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes], bool]], window: int):
        """items: (id, words, whole); whole is False for a cut of a longer item."""
        self.window = window
        self.number: dict[bytes, int] = {}
        # a state's one way on (word, state; -1 for none), or -2 and its table
        self.word, self.to = array("i", [-2]), array("i", [0])
        self.table: dict[int, dict[int, int]] = {0: {}}
        self.link, self.length = array("i", [-1]), array("i", [0])
        numbered = [(item, [self.number.setdefault(w, len(self.number)) for w in ws], whole) for item, ws, whole in items]
        for _, ws, _ in numbered:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        self._mark(numbered)

    def _go(self, v: int, w: int) -> int | None:
        one = self.word[v]
        if one == w:
            return self.to[v]
        return self.table[v].get(w) if one == -2 else None

    def _put(self, v: int, w: int, to: int) -> None:
        one = self.word[v]
        if one == -1 or one == w:
            self.word[v], self.to[v] = w, to
        elif one == -2:
            self.table[v][w] = to
        else:
            self.table[v] = {one: self.to[v], w: to}
            self.word[v] = -2

    def _state(self, length: int, link: int, like: int | None = None) -> int:
        new = len(self.link)
        self.link.append(link)
        self.length.append(length)
        self.word.append(-1 if like is None else self.word[like])
        self.to.append(0 if like is None else self.to[like])
        if like is not None and self.word[like] == -2:
            self.table[new] = dict(self.table[like])
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        """The state of p's longest string plus w, apart from q's longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], q)
        self.link[q] = clone
        while p >= 0 and self._go(p, w) == q:
            self._put(p, w, clone)
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if (q := self._go(last, w)) is not None:
            return self._split(last, q, w)
        new = self._state(self.length[last] + 1, 0)
        p = last
        while p >= 0 and (q := self._go(p, w)) is None:
            self._put(p, w, new)
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, q, w)
        return new

    def _mark(self, items: list[tuple[str, list[int], bool]]) -> None:
        n, window, link, length = len(self.link), self.window, self.link, self.length
        order = sorted(range(n), key=length.__getitem__)
        #: for a match of at least a window's length: the state of its last window
        self.at_window = array("i", bytes(4 * n))
        for v in order:
            if length[v] >= window:
                self.at_window[v] = v if length[link[v]] < window else self.at_window[link[v]]
        found: dict[int, set[str]] = {}
        short: dict[int, dict[tuple[int, str], None]] = {}
        for item, ws, whole in items:
            v = 0
            for i, w in enumerate(ws):
                v = self._go(v, w)
                if i + 1 >= window:
                    # v holds the item's whole prefix, so its last window is a suffix of it
                    found.setdefault(self.at_window[v], set()).add(item)
            if whole and 0 < len(ws) < window:
                short.setdefault(v, {})[len(ws), item] = None
        if short:
            for v in order[1:]:  # suffixes of a match are on its links
                if link[v] in short:
                    short[v] = {**short[link[v]], **short.get(v, {})}
        same: dict[frozenset[str], frozenset[str]] = {}
        self.items_at = {v: same.setdefault(f := frozenset(s), f) for v, s in found.items()}
        self.short_at = {v: tuple(s) for v, s in short.items()}

    def scan(self, ws: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """The hit word ranges [start, end) in order, and the ids that occur."""
        word, to, table, link, length = self.word, self.to, self.table, self.link, self.length
        at_window, items_at, short_at, window = self.at_window, self.items_at, self.short_at, self.window
        root, spans, items = table[0], [], set()
        v = matched = 0
        for i, w in enumerate(map(self.number.get, ws)):
            if w is None:
                v = matched = 0
                continue
            if v == 0:
                t = root.get(w)
            elif word[v] == w:
                t = to[v]
            else:
                t = table[v].get(w) if word[v] == -2 else None
                while t is None:
                    v = link[v]
                    matched = length[v]
                    t = to[v] if word[v] == w else table[v].get(w) if word[v] == -2 else None
                    if v == 0:
                        break
            if t is None:
                continue
            v = t
            matched += 1
            if matched >= window:
                _cover(spans, i + 1 - window, i + 1)
                items |= items_at[at_window[v]]
            if v in short_at:
                for size, item in short_at[v]:
                    if size <= matched:
                        _cover(spans, i + 1 - size, i + 1)
                        items.add(item)
        return spans, items


def _cover(spans: list[list[int]], start: int, end: int) -> None:
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append([start, end])


def _merged(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted([*a, *b]):
        if out and out[-1][1] >= s:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


@dataclass
class Items:
    """Benchmark items as bounded shards of (id, words, whole)."""

    pieces: DataFrame
    shards: int

    def automata(self, window: int) -> Iterator[SuffixAutomaton]:
        for k in range(self.shards):
            rows = self.pieces.filter(F.col("shard") == k).select("item", "words", "whole").collect()
            yield SuffixAutomaton([(r.item, bytes(r.words).split(b" "), r.whole) for r in rows if r.words], window)


def load_items(benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> Items:
    """Cut items into pieces that overlap by a window less one word (no window
    is lost) and deal them to shards of at most ``max_words`` words each."""
    step = max(window, max_words // 8)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for item, text in zip(frame["item"], frame["text"]):
                ws = words(text)
                for at in range(0, len(ws), step):
                    part = ws[at:at + step + window - 1]
                    if at == 0 or len(part) >= window:
                        rows.append((item, b" ".join(part), len(part), len(part) == len(ws)))
            yield pd.DataFrame(rows, columns=["item", "words", "n", "whole"])

    pieces = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text",
    ).mapInPandas(cut, "item string, words binary, n long, whole boolean")
    pieces = written(pieces, "benchmark-pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = 1 if total <= max_words else -(-2 * total // max_words)
    while True:
        dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)))
        largest = dealt.groupBy("shard").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= max_words:
            return Items(dealt, shards)
        # equal pieces go to one shard and must not keep it full
        pieces = pieces.distinct()
        shards *= 2


def match(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """Add bench_words long (words of the text), bench_spans (hit word ranges)
    and bench_items (ids that occur, sorted as strings) to each document."""
    items = load_items(benchmark, window, max_words)
    if items.shards > 1:
        found = _hit_by_several(docs, items, window, "bench_spans", "bench_items")
        n = F.coalesce(F.regexp_count("text", F.lit(_WORDS)), F.lit(0)).cast("long")
        return found.select(*docs.columns, n.alias("bench_words"), "bench_spans", "bench_items")
    (automaton,) = items.automata(window)
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    return map_text(docs, "text", lambda: _matcher(shared.value),
                    "bench_words long, bench_spans array<array<int>>, bench_items array<string>")


#: The words of a text that is not lowered yet, for the JVM.
_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _matcher(automaton: SuffixAutomaton):
    def one(text: str | None):
        ws = words(text)
        spans, items = automaton.scan(ws)
        return text, len(ws), spans, sorted(items)

    return one


def _hit_by_several(docs: DataFrame, items: Items, window: int, spans: str, ids: str) -> DataFrame:
    """Add the merged hits of all of a benchmark's automata, each of which scans
    the texts by itself and gives (text hash, spans, items) of those it hits."""
    spark, parts = docs.sparkSession, []
    text = docs.select(F.sha2("text", 256).alias("key"), "text").filter("text is not null")
    for automaton in items.automata(window):
        shared = spark.sparkContext.broadcast(automaton)

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = []
                for key, text in zip(frame["key"], frame["text"]):
                    spans, found = shared.value.scan(words(text))
                    if spans:
                        rows.append((key, spans, sorted(found)))
                yield pd.DataFrame(rows, columns=["key", "spans", "items"])

        hits = text.mapInPandas(run, "key string, spans array<array<int>>, items array<string>")
        hits = hits.groupBy("key").agg(F.min(F.struct("spans", "items")).alias("hit"))  # a text once, however often it stands
        parts.append(written(hits.select("key", "hit.*"), "benchmark-hits"))
        shared.unpersist()
    hits = functools.reduce(DataFrame.unionAll, parts).groupBy("key").agg(  # a row an automaton at most
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    key = "key_" + "_".join(docs.columns)  # longer than any column's name
    merged = hits.select(F.col("key").alias(key), _joined("spans").alias(f"{key}_spans"),
                         F.array_sort(F.array_distinct("items")).alias(f"{key}_items"))
    none = {f"{key}_spans": F.array().cast("array<array<int>>"), f"{key}_items": F.array().cast("array<string>")}
    found = docs.withColumn(key, F.sha2("text", 256)).join(merged, key, "left")
    return found.select(*docs.columns, *[F.coalesce(c, empty).alias(name)
                                         for (c, empty), name in zip(none.items(), (spans, ids))])


def _joined(spans: str) -> Column:
    """A list of spans with those that meet made one."""

    @F.pandas_udf("array<array<int>>")
    def merge(spans: pd.Series) -> pd.Series:
        return pd.Series([_merged([[int(a), int(b)] for a, b in x], []) for x in spans])

    return merge(spans)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: how much of it stands in benchmark windows."""
    found = match(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("bench_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        F.col("bench_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("bench_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _cut_out(text: str, spans: list) -> str:
    """The text without the words of the spans and what stands between them."""
    raw, at = word_spans(text)
    kept, last = [], 0
    for s, e in spans:
        kept.append(raw[last:at[s][0]])
        last = at[e - 1][1]
    return b"".join([*kept, raw[last:]]).decode("utf-8", "surrogatepass")


def cleaned(text: str | None, automaton: SuffixAutomaton, max_share: float) -> str | None:
    """The text without its hit spans; None if their share of its words is
    above ``max_share``. Cut edges may join into a window, so the rest is
    scanned until nothing is hit."""
    if text is None:
        return text
    spans, _ = automaton.scan(words(text))
    if not spans:
        return text
    n, cut = len(words(text)), sum(e - s for s, e in spans)
    while spans:
        if cut > max_share * n:
            return None
        text = _cut_out(text, spans)
        spans, _ = automaton.scan(words(text))
        cut += sum(e - s for s, e in spans)
    return text


def _without(text: str, spans: str) -> Column:
    """The text column without the words of the spans column."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut_out(t, [(int(s), int(e)) for s, e in x]) for t, x in zip(text, spans)], dtype=object)

    return cut(text, spans)


def _cleaned_by_several(docs: DataFrame, items: Items, window: int, max_share: float) -> DataFrame:
    """:func:`cleaned` with the items dealt to several automata: in each round
    all of them read the same text, their spans are merged, the share is judged
    by the original words, and the cut texts go to the next round. Only texts that
    were hit are written."""
    name = {k: "_".join(["bench", k, *["x"] * sum(map(len, docs.columns))])  # longer than any column's
            for k in ("spans", "items", "total", "cut")}
    hit = F.aggregate(name["spans"], F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    n = F.coalesce(F.regexp_count("text", F.lit(_WORDS)), F.lit(0)).cast("long")
    rest, done = docs.withColumn(name["total"], n).withColumn(name["cut"], F.lit(0).cast("long")), []
    while True:
        found = _hit_by_several(rest, items, window, name["spans"], name["items"])
        found = found.withColumn(name["cut"], F.col(name["cut"]) + hit)
        done.append(found.filter(F.size(name["spans"]) == 0).select(docs.columns))
        rest = found.filter((F.size(name["spans"]) > 0) & (F.col(name["cut"]) <= F.lit(max_share) * F.col(name["total"])))
        rest = written(rest.withColumn("text", _without("text", name["spans"])).drop(name["spans"], name["items"]),
                       "decontaminated")
        if rest.isEmpty():
            return functools.reduce(DataFrame.unionAll, done)


def remove_spans(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.5,
                 window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """Documents without the benchmark passages in them, all columns kept.

    Spans that reach the length limit (``window`` words, or a shorter item
    whole) are cut out of the text; a document of whose words more than
    ``max_share`` lie in such spans goes. n_chars follows the text.
    """
    items = load_items(benchmark, window, max_words)
    if items.shards == 1:
        (automaton,) = items.automata(window)
        shared = docs.sparkSession.sparkContext.broadcast(automaton)

        def make():
            def one(text: str | None):
                new = cleaned(text, shared.value, max_share)
                return None if new is None and text is not None else (new,)

            return one

        out = map_text(docs, "text", make)
    else:
        out = _cleaned_by_several(docs, items, window, max_share)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(
            F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out
