"""Secret scans: fixed patterns, and formats learned by grammar inference.

Three patterns give the base spans. Their values are labelled credentials: a
bounded sample of them (``SAMPLE`` per kind, dealt to slots by hash, the
smallest hash of a slot stays) becomes one prefix tree per kind. States whose
continuations agree within a Hoeffding bound are merged, which leaves a
probabilistic automaton of the kind's format. Every run of credential
characters of a text, or the parts of it beside base spans, is scored from its
start and behind each separator in it, to its end and each separator, by the
likelihood a symbol under each automaton; values as likely as nearly all
labelled ones and no shorter than the shortest are spans of kind ``format``.

Both passes over the documents stream rows; the driver sees at most SAMPLE
values a kind and the automata, whatever the corpus.

Defined results: a null or empty text has no spans; repeated documents each
have their row; with no labelled credential (an empty table) only base patterns
count. Extra columns pass through.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import map_text, written

KINDS = ("assign", "access", "hex", "format")
#: Labelled values a kind's automaton is learned from.
SAMPLE = 1024
#: Their symbols a kind, all in all; values of more than an eighth are not learned from, but scored as any.
SAMPLE_SYMBOLS = 1 << 19
#: Confidence of the merge test.
ALPHA = 0.05
#: Share of labelled values that a kind's threshold lets pass.
ACCEPT = 0.99
REDACTED = "[SECRET]"

# Fixed values of the base patterns.
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_ASSIGN_MIN, _ACCESS_MIN, _HEX_MIN = 8, 16, 32
#: Both other patterns' matches lie in such runs; what the automata score in ones of any length.
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_SEPARATORS = "+/_.=-"
_SEPARATED, _PADDING = re.compile(r"[+/_.=-]+"), re.compile("=+")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

Span = tuple[str, int, int, int]  # kind, start, end, start of the value


def base_spans(text: str | None) -> tuple[list[Span], list[re.Match]]:
    """Base spans by start then kind, and the runs they were looked for in."""
    if not text:
        return [], []
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        found += [("assign", *m.span(), m.start(2)) for m in _ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= _ASSIGN_MIN]
    runs = list(_RUN.finditer(text))
    for run in runs:
        for kind, pattern, least in (("access", _ACCESS, _ACCESS_MIN), ("hex", _HEX, _HEX_MIN)):
            found += [(kind, *m.span(), m.start()) for m in pattern.finditer(text, *run.span())
                      if m.end() - m.start() >= least]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]))), runs


def _symbol(c: str) -> str:
    if c.isdigit():
        return "0"
    if "a" <= c <= "z":
        return "a" if c <= "f" else "g"
    if "A" <= c <= "Z":
        return "A" if c <= "F" else "G"
    return c


class FormatAutomaton:
    """A probabilistic automaton merged from the prefix tree of some values."""

    END = "end"

    def __init__(self, values: list[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]
        self.alpha = alpha
        strings = ["".join(map(_symbol, v)) for v in values]
        for s in strings:
            q = 0
            for c in s:
                if c not in self.next[q]:
                    self.next[q][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                self.count[q][c] += 1
                q = self.next[q][c]
            self.count[q][self.END] += 1
        self._merge_all()
        self._drop_unreached()
        self.least = min(map(len, values))
        #: log probability of a symbol, and of the end (None: none ends there), by state
        totals = [c.total() for c in self.count]
        self.cost = [{c: math.log(self.count[q][c] / totals[q]) for c in out} for q, out in enumerate(self.next)]
        self.end = [math.log(c[self.END] / n) if c[self.END] else None for c, n in zip(self.count, totals)]
        scores = sorted(self.likelihood(s) for s in strings)
        self.threshold = scores[int(len(scores) * (1 - ACCEPT))] - 1e-9

    def _merge_all(self) -> None:
        kept, border = [0], []
        border = [(0, c) for c in sorted(self.next[0])]
        while border:
            parent, c = border.pop(0)
            q = self.next[parent][c]
            if q in kept:
                continue
            for k in kept:
                if self._compatible(k, q):
                    self.next[parent][c] = k
                    self._fold(k, q)
                    break
            else:
                kept.append(q)
            border = sorted({(k, c) for k in kept for c, t in self.next[k].items() if t not in kept})

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self.count[a].total(), self.count[b].total()
            if not na or not nb or a == b:
                continue
            bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (na ** -0.5 + nb ** -0.5)
            for c in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a][c] / na - self.count[b][c] / nb) > bound:
                    return False
            todo += [(self.next[a][c], t) for c, t in self.next[b].items() if c in self.next[a]]
        return True

    def _fold(self, a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a == b:
                continue
            self.count[a] += self.count[b]
            for c, t in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], t))
                else:
                    self.next[a][c] = t

    def _drop_unreached(self) -> None:
        number, order = {0: 0}, [0]
        for q in order:
            for t in self.next[q].values():
                if t not in number:
                    number[t] = len(order)
                    order.append(t)
        self.next = [{c: number[t] for c, t in self.next[q].items()} for q in order]
        self.count = [self.count[q] for q in order]

    def likelihood(self, symbols: str) -> float:
        """Mean log probability of a symbol; minus infinity off the format."""
        q, total = 0, 0.0
        for c in symbols:
            if c not in self.next[q]:
                return -math.inf
            total += math.log(self.count[q][c] / self.count[q].total())
            q = self.next[q][c]
        end = self.count[q][self.END] / self.count[q].total()
        return (total + math.log(end)) / (len(symbols) + 1) if end else -math.inf

    def accepts(self, value: str) -> bool:
        return len(value) >= self.least and self.likelihood("".join(map(_symbol, value))) >= self.threshold

    def longest(self, symbols: str, starts: set[int], ends: set[int]) -> dict[int, int]:
        """For each end at which a value ends that is accepted from one of the
        starts: the first such start. One pass: starts that have come to the
        same state stay together, as what follows adds the same to each, and a
        start is forgotten once an earlier one in its state is at least as likely.
        """
        groups: dict[int, tuple[float, list[int], list[float]]] = {}  # state: what to add, starts, their sums
        found: dict[int, int] = {}
        for i in range(len(symbols) + 1):
            if i in ends:
                for q, (add, at, sums) in groups.items():
                    if self.end[q] is not None:
                        k = bisect.bisect_left(sums, self.threshold - self.end[q] - add)
                        if k < len(at) and i - at[k] >= self.least:
                            found[i] = min(found.get(i, i), at[k])
            if i == len(symbols):
                return found
            if i in starts:
                groups[0] = _joined(groups.get(0), (0.0, [i], [0.0]))
            moved: dict[int, tuple[float, list[int], list[float]]] = {}
            for q, (add, at, sums) in groups.items():
                if (t := self.next[q].get(symbols[i])) is not None:
                    moved[t] = _joined(moved.get(t), (add + self.cost[q][symbols[i]] - self.threshold, at, sums))
            groups = moved
        return found


def _joined(a, b):
    """Two groups of starts as one, first starts first, later ones only if likelier."""
    if a is None or b is None:
        return a or b
    if len(a[1]) < len(b[1]):
        a, b = b, a
    add, at, sums = a
    for start, value in zip(b[1], b[2]):
        value += b[0] - add
        k = bisect.bisect_left(at, start)
        if k and sums[k - 1] >= value:
            continue
        gone = k
        while gone < len(at) and sums[gone] <= value:
            gone += 1
        at[k:gone], sums[k:gone] = [start], [value]
    return a


def learn(docs: DataFrame, sample: int = SAMPLE) -> dict[str, FormatAutomaton]:
    """An automaton a kind, from a bounded sample of all documents' base values."""

    def labelled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                spans, _ = base_spans(text)
                rows += [(kind, text[value:end]) for kind, _, end, value in spans]
            yield pd.DataFrame(rows, columns=["kind", "value"])

    values = docs.select("text").mapInPandas(labelled, "kind string, value string")
    order = F.xxhash64("value")
    slots = values.filter(F.length("value") <= SAMPLE_SYMBOLS // 8).groupBy(
        "kind", F.pmod(order, F.lit(sample)).alias("slot")).agg(F.min(F.struct(order.alias("h"), "value")).alias("one"))
    slots = written(slots.select("kind", F.col("one.h").alias("h"), "one.value", F.length("one.value").alias("n")), "labelled")
    last: dict[str, int] = {}  # the last hash a kind whose values SAMPLE_SYMBOLS hold
    read: Counter[str] = Counter()
    for r in slots.select("kind", "h", "n").orderBy("kind", "h", "n").collect():  # at most `sample` rows a kind
        read[r.kind] += r.n
        if read[r.kind] <= SAMPLE_SYMBOLS:
            last[r.kind] = r.h
    within = F.lit(False)
    for kind, h in last.items():
        within = within | (F.col("kind") == kind) & (F.col("h") <= h)
    chosen = slots.filter(within).select("kind", "value")
    by_kind: dict[str, list[str]] = {}
    for r in chosen.collect():  # at most `sample` values and SAMPLE_SYMBOLS symbols a kind
        by_kind.setdefault(r.kind, []).append(r.value)
    return {kind: FormatAutomaton(sorted(by_kind[kind])) for kind in KINDS if kind in by_kind}


def _formats(part: str, automata: dict[str, FormatAutomaton]) -> Iterator[tuple[int, int]]:
    """The values in a part of a run, from its last to its first: they begin at
    the part's start or behind separators and end before separators, behind "="
    or at the part's end; the longest to an end counts."""
    if not _DIGIT.search(part) or not _LETTER.search(part):
        return
    n = len(part)
    starts = {0} | {m.end() for m in _SEPARATED.finditer(part) if m.end() < n}
    ends = {m.start() for m in _SEPARATED.finditer(part)} | {m.end() for m in _PADDING.finditer(part)}
    if part[-1] not in _SEPARATORS:
        ends.add(n)
    symbols, first = "".join(map(_symbol, part)), {}
    for a in automata.values():
        for end, start in a.longest(symbols, starts, ends).items():
            first[end] = min(first.get(end, start), start)
    before = n
    for end in sorted(first, reverse=True):
        value = part[first[end]:end]
        if end <= before and _DIGIT.search(value) and _LETTER.search(value):
            yield first[end], end
            before = first[end]


def all_spans(text: str | None, automata: dict[str, FormatAutomaton]) -> list[Span]:
    """Base spans and format spans, by start then kind."""
    found, _ = base_spans(text)
    if not text or not automata:
        return found
    base, k, reach = sorted((s, e) for _, s, e, _ in found), 0, 0
    least = min(a.least for a in automata.values())
    for run in re.finditer(rf"[A-Za-z0-9+/_.=-]{{{least},}}", text):
        at, end = run.span()
        at = max(at, reach)  # a base span can begin in an earlier run
        while k < len(base) and base[k][0] < end:  # the parts beside base spans
            if base[k][0] - at >= least:
                found += [("format", at + s, at + e, at + s) for s, e in _formats(text[at:base[k][0]], automata)]
            reach = max(reach, base[k][1])
            at = max(at, reach)
            k += 1
        if end - at >= least:
            found += [("format", at + s, at + e, at + s) for s, e in _formats(text[at:end], automata)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, automata: dict[str, FormatAutomaton]) -> DataFrame:
    """Add secret_spans (kind, start, end in code points) to each document."""
    shared = docs.sparkSession.sparkContext.broadcast(automata)

    def make():
        def one(text: str | None):
            return text, [{"kind": k, "start": s, "end": e} for k, s, e, _ in all_spans(text, shared.value)]

        return one

    return map_text(docs, "text", make, "secret_spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, automata: dict[str, FormatAutomaton]) -> DataFrame:
    """Documents with every span's value replaced; all columns and rows kept,
    n_chars follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(automata)

    def make():
        def one(text: str | None):
            if not text:
                return (text,)
            kept, last = [], 0
            for _, _, end, start in sorted(all_spans(text, shared.value), key=lambda s: (s[3], -s[2])):
                if start >= last:
                    kept += [text[last:start], REDACTED]
                last = max(last, end)
            return ("".join([*kept, text[last:]]),)

        return one

    out = map_text(docs, "text", make)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(
            F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans."""
    docs = docs.select("doc_id", "text")
    found = scan(docs, learn(docs))
    text_of = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("secret_spans", lambda s: s["kind"] != "format")
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, text_of), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("secret_spans", text_of), ",").alias("spans"))
