"""Personal data: fixed patterns, and a skip-chain conditional random field.

Four patterns give the base spans. The field labels a document's tokens that
hold a digit or "@" (all others are O, so they only serve as context) with
B/I tags of the four kinds. Its factors: one a token over hashed shape, check
digit and context features, one a pair of adjacent tokens, and skip factors that
tie each token to the last one before it with the same text, and to the last one
with the same seven final digits, however far back. All skip factors of a kind
share one potential, so labels of repeated or similar tokens pull each other
over the whole document; as each token has at most two links back, their number
grows with the tokens, not with the pairs.

Loopy message passing (log domain, all messages at once, ``ROUNDS`` at most or
until they stand still) gives the marginals. Tokens of base spans are clamped to
their kind and so act as evidence. Spans whose tokens are each of one kind with
probability ``ACCEPT`` are added, e.g. the phone and the card that the patterns
miss because they stand side by side, or a number written a second time without
its prefix.

Weights are learned by ascent on the Bethe likelihood, the base spans of a
bounded sample as labels: at most ``SAMPLE`` documents with base spans and as
many with candidate tokens but none (dealt to slots by hash, the least hash of a
slot stays) of at most ``SAMPLE_TOKENS`` tokens and without a match that numbers
side by side made fail (:func:`doubtful`). All else covers every document.

Defined results: a null or empty text has no spans; repeated documents each have
their row; with no base span anywhere (or an empty table) only patterns count.
Extra columns pass through. Work and memory are linear in a text's length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import map_texts

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 1024
SAMPLE_TOKENS = 512
#: Least probability of a kind for each token of an added span.
ACCEPT = 0.9
ROUNDS = 30
#: Documents are labelled together up to about so many tokens.
BLOCK = 20_000
#: Weights of hashed features.
FEATURES = 4096
STEPS = 150
#: Prior mean of the skip potential and strength of the weights' priors.
AGREE, RIDGE = 4.0, 0.02

# labels: O, then B and I of each kind
LABELS = 1 + 2 * len(KINDS)
_KIND_OF = np.array([0] + [1 + k for k in range(len(KINDS)) for _ in "BI"])
_INSIDE = np.array([False] + [tag == "I" for _ in KINDS for tag in "BI"])
_FORBIDDEN = -1e9
#: I of a kind only behind B or I of that kind.
_ALLOWED = ~_INSIDE[None, :] | (_KIND_OF[:, None] == _KIND_OF[None, :])
_ALLOWED[0, _INSIDE] = False

Span = tuple[str, int, int]

# Fixed values of the base patterns (each written so that its search is linear).
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else 2 * v - 9 * (v > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    reach, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > reach and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
        reach = domain.end() if domain else at + 1
        at = text.find("@", at + 1)


def _address(parts: list[str]) -> bool:
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in parts))


def base_spans(text: str | None) -> list[Span]:
    """Matches of the four patterns that hold, by start then kind."""
    if not text:
        return []
    found = list(_emails(text))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _address(m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def doubtful(text: str) -> bool:
    """Whether numbers that stand side by side may have made a match fail: the
    base spans of such a text are no labels to learn from."""
    if any(not 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15 for m in _PHONE.finditer(text)):
        return True
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if len(digits) > 19 or (14 <= len(digits) < m.end() - m.start() and not luhn(digits)):
                return True
    return False


# --- tokens and their graph -------------------------------------------------

_CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_CORE = re.compile(r"[0-9A-Za-z+(]")
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")
_WORD_BEFORE = re.compile(r"([^\W\d_]{1,24})\W{0,3}\Z")
_WORD_AFTER = re.compile(r"\W{0,3}([^\W\d_]{1,24})")


def _shape(core: str, exact: bool) -> str:
    if len(core) > 64:
        return "long"
    return _RUNS.sub(lambda m: (f"d{min(len(m[0]), 20)}" if exact else "d") if m[0][0] in "0123456789" else "a", core)


@dataclass
class Tokens:
    """Candidate tokens of some documents, one after the other."""

    start: list[int]
    end: list[int]
    features: list[list[int]]
    chain: list[int]  # the adjacent token before, or -1
    same: list[int]  # the last one with the same text, or -1
    tail: list[int]  # the last one with the same final digits, or -1

    @staticmethod
    def none() -> Tokens:
        return Tokens([], [], [], [], [], [])

    def add(self, text: str) -> tuple[int, int]:
        """Append a document's tokens; their range."""
        first, by_text, by_tail = len(self.start), {}, {}
        raw_end, shapes = -9, []
        for m in _CANDIDATE.finditer(text):
            core = _CORE.search(text, *m.span())
            if core is None:
                continue
            start, end = core.start(), m.end()
            while not text[end - 1].isalnum() and text[end - 1] != ")" and end > start + 1:
                end -= 1
            word, n = text[start:end], len(self.start)
            gap = m.start() - raw_end
            adjacent = 0 < gap <= 3 and n > first
            raw_end = m.end()
            digits = _NOT_DIGIT.sub("", word)
            low = word.lower()
            tail = digits[-7:] if len(digits) >= 7 else None
            self.start.append(start)
            self.end.append(end)
            self.chain.append(n - 1 if adjacent else -1)
            same = by_text.get(low, -1) if len(low) >= 4 else -1
            self.same.append(same)
            near = by_tail.get(tail, -1) if tail else -1
            self.tail.append(near if near != same else -1)
            by_text[low] = n
            if tail:
                by_tail[tail] = n
            exact, coarse = _shape(word, True), _shape(word, False)
            before = _WORD_BEFORE.search(text[max(0, m.start() - 28):m.start()])
            after = _WORD_AFTER.match(text, m.end())
            names = ["bias", "s " + exact, "c " + coarse, f"n {min(len(digits), 20)}", f"l {min(len(word), 40) // 4}",
                     "p " + (shapes[-1] if adjacent else ""), "w " + (before[1].lower() if before else ""),
                     "v " + (after[1].lower() if after else "")]
            if 14 <= len(digits) <= 19:
                names.append(f"luhn {luhn(digits)}")
            elif coarse == "d.d.d.d":
                names.append(f"address {_address(word.split('.'))}")
            if "@" in word:
                names.append(f"mail {_DOMAIN.search(word, word.index('@')) is not None}")
            shapes.append(coarse)
            self.features.append([zlib.crc32(x.encode("utf-8", "replace")) % FEATURES for x in names])
        return first, len(self.start)


def clamped(tokens: Tokens, span: tuple[int, int], base: list[Span]) -> list[int]:
    """Labels of a document's tokens by its base spans, 0 outside of them."""
    out, k, last = [], 0, None
    for i in range(*span):
        while k < len(base) and base[k][2] <= tokens.start[i]:
            k += 1
        hit = next((j for j in range(k, min(k + 4, len(base))) if base[j][1] < tokens.end[i] and base[j][2] > tokens.start[i]), None)
        if hit is None:
            out.append(0)
        else:
            kind = KINDS.index(base[hit][0])
            inside = hit == last and tokens.chain[i] >= 0 and out and out[-1] in (1 + 2 * kind, 2 + 2 * kind)
            out.append(2 + 2 * kind if inside else 1 + 2 * kind)
        last = hit
    return out


# --- the field ----------------------------------------------------------------

class Graph:
    """Tokens as arrays: features, and the three kinds of links."""

    def __init__(self, tokens: Tokens):
        self.n = len(tokens.start)
        width = max(map(len, tokens.features), default=1)
        self.features = np.full((self.n, width), FEATURES, np.int32)
        for i, f in enumerate(tokens.features):
            self.features[i, :len(f)] = f
        self.links = []
        for back in (tokens.chain, tokens.same, tokens.tail):
            to = np.flatnonzero(np.array(back, np.int64) >= 0)
            self.links.append((np.array(back, np.int64)[to], to))
        self.begins = np.array(tokens.chain, np.int64) < 0


@dataclass
class Weights:
    node: np.ndarray  # FEATURES + 1 (padding) x LABELS
    kind: np.ndarray  # FEATURES + 1 x kinds, shared by B and I
    step: np.ndarray  # LABELS x LABELS
    agree: np.ndarray  # by kind

    @staticmethod
    def prior() -> Weights:
        kinds = 1 + len(KINDS)
        return Weights(np.zeros((FEATURES + 1, LABELS)), np.zeros((FEATURES + 1, kinds)),
                       np.zeros((LABELS, LABELS)), np.full(kinds, AGREE))

    def parts(self) -> list[np.ndarray]:
        return [self.node, self.kind, self.step, self.agree]


def _potentials(g: Graph, w: Weights) -> tuple[np.ndarray, list[np.ndarray]]:
    both = w.node + w.kind[:, _KIND_OF]
    both[FEATURES] = 0.0
    unary = np.zeros((g.n, LABELS))
    for j in range(g.features.shape[1]):
        unary += both[g.features[:, j]]
    unary[np.ix_(g.begins, _INSIDE)] = _FORBIDDEN
    step = np.where(_ALLOWED, w.step, _FORBIDDEN)
    skip = np.where(_KIND_OF[:, None] == _KIND_OF[None, :], w.agree[_KIND_OF][:, None], 0.0)
    return unary, [step, skip, skip]


def _send(belief: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Messages through a factor, largest entry 0."""
    top = belief.max(axis=1, keepdims=True)
    out = np.log(np.maximum(np.exp(belief - top) @ factor, 1e-300))
    return out - out.max(axis=1, keepdims=True)


def propagate(g: Graph, unary: np.ndarray, pair: list[np.ndarray], messages=None, rounds: int = ROUNDS):
    """Beliefs (unnormalised logs) and messages after loopy message passing."""
    if messages is None:
        messages = [[np.zeros((len(a), LABELS)), np.zeros((len(a), LABELS))] for a, _ in g.links]
    factors = [np.exp(p) for p in pair]

    def beliefs():
        out = unary.copy()
        for (a, b), (forth, back) in zip(g.links, messages):
            out[b] += forth  # a token has one link back and one forth of each kind
            out[a] += back
        return out

    belief = beliefs()
    for _ in range(rounds):
        moved = 0.0
        for (a, b), m, f in zip(g.links, messages, factors):
            if len(a):
                forth, back = _send(belief[a] - m[1], f), _send(belief[b] - m[0], f.T)
                moved = max(moved, float(np.abs(np.exp(forth) - np.exp(m[0])).max()),
                            float(np.abs(np.exp(back) - np.exp(m[1])).max()))
                m[0], m[1] = forth, back
        belief = beliefs()
        if moved < 1e-4:
            break
    return belief, messages


def marginals(belief: np.ndarray) -> np.ndarray:
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _expected(belief, messages, links, pair) -> np.ndarray:
    """Summed pair marginals of one kind of links."""
    a, b = links
    total = np.zeros((LABELS, LABELS))
    for i in range(0, len(a), 4096):
        at = slice(i, i + 4096)
        left, right = belief[a[at]] - messages[1][at], belief[b[at]] - messages[0][at]
        p = left[:, :, None] + pair[None] + right[:, None, :]
        p = np.exp(p - p.max(axis=(1, 2), keepdims=True))
        total += (p / p.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return total


def fit(g: Graph, labels: np.ndarray, steps: int = STEPS) -> Weights:
    """Weights by ascent on the Bethe likelihood with Gaussian priors."""
    w, prior = Weights.prior(), Weights.prior()
    truth = np.eye(LABELS)[labels]
    same_kind = _KIND_OF[:, None] == _KIND_OF[None, :]
    seen = [np.zeros((LABELS, LABELS)) for _ in g.links]
    for s, (a, b) in zip(seen, g.links):
        np.add.at(s, (labels[a], labels[b]), 1.0)
    flat, messages = g.features.ravel(), None
    width = g.features.shape[1]
    first = [np.zeros_like(x) for x in w.parts()]
    second = [np.zeros_like(x) for x in w.parts()]
    for t in range(1, steps + 1):
        unary, pair = _potentials(g, w)
        belief, messages = propagate(g, unary, pair, messages, rounds=6)
        off = truth - marginals(belief)
        node = np.column_stack([np.bincount(flat, np.repeat(off[:, y], width), FEATURES + 1) for y in range(LABELS)])
        kind = np.zeros_like(w.kind)
        np.add.at(kind.T, _KIND_OF, node.T)
        lack = [s - _expected(belief, m, link, p) for s, m, link, p in zip(seen, messages, g.links, pair)]
        agree = np.array([((lack[1] + lack[2]) * same_kind)[_KIND_OF == k].sum() for k in range(1 + len(KINDS))])
        rise = [node, kind, np.where(_ALLOWED, lack[0], 0.0), agree]
        for x, x0, r, m1, m2 in zip(w.parts(), prior.parts(), rise, first, second):
            r = r - RIDGE * (x - x0)
            m1 += 0.1 * (r - m1)
            m2 += 0.01 * (r * r - m2)
            x += 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-3)
    return w


def learn(docs: DataFrame, sample: int = SAMPLE) -> Weights | None:
    """Weights from a bounded sample; None if no document has a base span."""

    def candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                if text:
                    tokens = Tokens.none()
                    span = tokens.add(text)
                    if 0 < span[1] <= SAMPLE_TOKENS and not doubtful(text):
                        labels = clamped(tokens, span, base_spans(text))
                        rows.append((any(labels), zlib.crc32(text.encode("utf-8", "replace")), tokens.features,
                                     tokens.chain, tokens.same, tokens.tail, labels))
            yield pd.DataFrame(rows, columns=["found", "h", "features", "chain", "same", "tail", "labels"])

    schema = ("found boolean, h long, features array<array<int>>, chain array<int>, same array<int>, tail array<int>, "
              "labels array<int>")
    made = docs.select("text").mapInPandas(candidates, schema)
    order = F.xxhash64("h")
    chosen = made.groupBy("found", F.pmod(order, F.lit(sample)).alias("slot")).agg(
        F.min(F.struct(order.alias("o"), "features", "chain", "same", "tail", "labels")).alias("one"))
    rows = chosen.collect()  # at most `sample` documents of each sort, SAMPLE_TOKENS tokens each
    if not any(r.found for r in rows):
        return None
    tokens, labels = Tokens.none(), []
    for r in sorted(rows, key=lambda r: (r.found, r.slot)):
        base = len(tokens.start)
        tokens.start += r.one.chain  # only their number counts here
        tokens.features += r.one.features
        for name in ("chain", "same", "tail"):
            getattr(tokens, name).extend(i + base if i >= 0 else -1 for i in r.one[name])
        labels += r.one.labels
    return fit(Graph(tokens), np.array(labels))


def _added(tokens: Tokens, fixed: np.ndarray, w: Weights) -> list[tuple[int, int, str]]:
    """Spans the field adds, as first token, last token and kind."""
    g = Graph(tokens)
    unary, pair = _potentials(g, w)
    at = np.flatnonzero(fixed > 0)
    held = np.full((len(at), LABELS), _FORBIDDEN)
    held[np.arange(len(at)), fixed[at]] = 0.0
    unary[at] = held
    p = marginals(propagate(g, unary, pair)[0])
    best = p.argmax(axis=1)
    by_kind = np.column_stack([p[:, _KIND_OF == k].sum(axis=1) for k in range(1 + len(KINDS))])
    sure = by_kind[np.arange(len(p)), _KIND_OF[best]] >= ACCEPT
    found: list[tuple[int, int, str, bool]] = []
    for i in np.flatnonzero((best > 0) & (fixed == 0)).tolist():
        kind = KINDS[_KIND_OF[best[i]] - 1]
        if _INSIDE[best[i]]:
            # the rest of a span that began just before, unless that one is a pattern's
            if found and found[-1][1] == i - 1 == tokens.chain[i] and found[-1][2] == kind:
                found[-1] = (found[-1][0], i, kind, found[-1][3] and bool(sure[i]))
        else:
            found.append((i, i, kind, bool(sure[i])))
    return [(a, b, kind) for a, b, kind, ok in found if ok]


def spans_of(texts: list[str | None], w: Weights | None) -> list[list[tuple[str, int, int, bool]]]:
    """For each text its spans (kind, start, end, by a pattern) by start then kind."""
    out = [[(*s, True) for s in base_spans(t)] for t in texts]
    if w is None:
        return out
    tokens, owner, fixed = Tokens.none(), [], []

    def label():
        nonlocal tokens, owner, fixed
        for a, b, kind in _added(tokens, np.array(fixed), w) if fixed else ():
            out[owner[a]].append((kind, tokens.start[a], tokens.end[b], False))
        tokens, owner, fixed = Tokens.none(), [], []

    for i, text in enumerate(texts):
        if text:
            span = tokens.add(text)
            fixed += clamped(tokens, span, [s[:3] for s in out[i]])
            owner += [i] * (span[1] - span[0])
        if len(fixed) >= BLOCK:
            label()
    label()
    for found in out:
        found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def scan(docs: DataFrame, weights: Weights | None) -> DataFrame:
    """Add pii_spans (kind, start, end in code points, base) to each document."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        def of_batch(texts):
            found = spans_of(texts, shared.value)
            return [(t, [{"kind": k, "start": a, "end": b, "base": base} for k, a, b, base in s])
                    for t, s in zip(texts, found)]

        return of_batch

    return map_texts(docs, "text", make, "pii_spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def redact(docs: DataFrame, weights: Weights | None) -> DataFrame:
    """Documents with every span replaced by its kind, e.g. ``[EMAIL]``; all
    columns and rows kept, n_chars follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        def of_batch(texts):
            out = []
            for text, spans in zip(texts, spans_of(texts, shared.value)):
                kept, last = [], 0
                for kind, start, end, _ in spans:
                    if start >= last:
                        kept += [text[last:start], f"[{kind.upper()}]"]
                    last = max(last, end)
                out.append((text if text is None else "".join([*kept, text[last:]]),))
            return out

        return of_batch

    out = map_texts(docs, "text", make)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(
            F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans."""
    docs = docs.select("doc_id", "text")
    found = scan(docs, learn(docs))
    text_of = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("pii_spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("pii_spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(F.transform(base, text_of), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("pii_spans", text_of), ",").alias("spans"))
