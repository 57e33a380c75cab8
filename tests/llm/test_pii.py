import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from relaymart.llm import pii
from tests_llm_rows import MESSY, doc

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def brute(text):
    text = text or ""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = digits(m[0])
        double = sum(sum(divmod(2 * v, 10)) for v in d[-2::-2])
        if 14 <= len(d) <= 19 and (sum(d[::-2]) + double) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_against_brute_force():
    rng = random.Random(4)
    texts = ["".join(rng.choices("0123.@-+ ()aZ%_é\n٣", k=rng.randint(0, 60))) for _ in range(20_000)]
    texts += ["a@b.c@d.e@f", "x@@y.z", "1.2.3.4.5.6.7.8", "256.1.1.1", "00000255.1.2.3", "+1 (555) 555-5555 4111 1111 1111 1111",
              "4111-1111-1111-1111", "a@b..c", "é@b.c", "a+b@c-.d"]
    for text in [*texts, *(m[1] for m in MESSY)]:
        assert pii.base_spans(text) == brute(text)


def test_addresses_of_many_zeros():
    text = f"at {'0' * 6000}10.1.2.{'0' * 6000} and 1.2.3.{'0' * 6000}256"
    assert [s[0] for s in pii.base_spans(text)] == ["ip"]
    pii.Tokens.none().add(text)


def test_long_runs_take_linear_time():
    for text in ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@" * 300_000, "a@" * 150_000, "+" + "1 " * 150_000,
                 "1 " * 20_000]:
        assert isinstance(pii.base_spans(text), list)
        pii.Tokens.none().add(text)


def test_messages_are_exact_on_a_tree():
    """On a chain, marginals equal those by summing over all labellings."""
    import itertools

    rng = np.random.default_rng(5)
    tokens = pii.Tokens([0] * 4, [0] * 4, [[0]] * 4, [-1, 0, 1, -1], [-1, -1, -1, 0], [-1] * 4)
    g = pii.Graph(tokens)
    w = pii.Weights.prior()
    w.node[0], w.step = rng.normal(size=pii.LABELS), rng.normal(size=(pii.LABELS, pii.LABELS))
    unary, pair = pii._potentials(g, w)
    unary = unary + rng.normal(size=unary.shape)
    got = pii.marginals(pii.propagate(g, unary, pair)[0])
    want = np.zeros_like(unary)
    for y in itertools.product(range(pii.LABELS), repeat=4):
        p = np.exp(sum(unary[i, y[i]] for i in range(4)) + pair[0][y[0], y[1]] + pair[0][y[1], y[2]] + pair[1][y[0], y[3]])
        for i in range(4):
            want[i, y[i]] += p
    np.testing.assert_allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-6)


def _number(rng, n):
    return "".join(rng.choices("0123456789", k=n))


def _card(rng):
    head = "4" + _number(rng, 14)
    return next(head + c for c in "0123456789" if pii.luhn(head + c))


def _words(rng, n):
    return " ".join(rng.choices(["the", "onest", "thre", "orshin", "edhawh", "tannt", "hely", "thingingst", "lyther"], k=n))


def people(n=300, seed=6):
    """Documents with one piece of personal data each, apart from others."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        what = [f"{rng.choice(['bos', 'hsr', 'pa'])}.{_number(rng, 2)}@mail{rng.randint(0, 9)}.example.com",
                ".".join(str(rng.randint(1, 255)) for _ in range(4)), _card(rng),
                f"+1 ({_number(rng, 3)}) 555-{_number(rng, 4)}",
                rng.choice([f"page {rng.randint(1, 400)}", "version 2.0.", f"in {rng.randint(1900, 2030)}", f"no {_number(rng, 8)}"])][i % 5]
        rows.append(doc(i, f"{_words(rng, 12)} {what} {_words(rng, 12)}."))
    return rows


@pytest.fixture(scope="module")
def weights(corpus):
    return pii.learn(corpus(people()))


def test_side_by_side_numbers_are_told_apart(weights):
    """Where a pattern's match swallows two numbers and is dropped, the field finds both."""
    rng, hits, n = random.Random(9), 0, 200
    for _ in range(n):
        phone, card = f"+1 ({_number(rng, 3)}) 555-{_number(rng, 4)}", _card(rng)
        text = f"{_words(rng, 9)} {phone} {card} {_words(rng, 9)}"
        assert not brute(text)
        hits += {(k, text[a:b]) for k, a, b, _ in pii.spans_of([text], weights)[0]} == {("phone", phone), ("card", card)}
    assert hits >= 0.98 * n


def test_a_distant_repeat_takes_the_label(weights):
    """A number written again without its prefix is found by the skip factors, and
    not without them; a like number that repeats nothing personal is left alone."""
    rng = random.Random(10)
    none = pii.Weights(weights.node, weights.kind, weights.step, np.zeros_like(weights.agree))
    found, without, wrong, n = 0, 0, 0, 200
    for _ in range(n):
        area, line = _number(rng, 3), f"555-{_number(rng, 4)}"
        text = f"{_words(rng, 20)} +1 ({area}) {line} {_words(rng, 300)} call {line} now {_words(rng, 5)} ref {_number(rng, 5)} x"
        at = text.rindex(line)
        spans = lambda w: {s[:3] for s in pii.spans_of([text], w)[0]}
        found += ("phone", at, at + len(line)) in spans(weights)
        without += ("phone", at, at + len(line)) in spans(none)
        wrong += any(a > at + len(line) for _, a, _ in spans(weights))
    assert found >= 0.9 * n and without < found and wrong == 0


def test_clean_documents_stay_clean(weights):
    rng = random.Random(11)
    texts = [f"{_words(rng, 20)} page {rng.randint(1, 400)} {_words(rng, 9)} version 2.0. in {rng.randint(1900, 2030)}, no {_number(rng, 8)}."
             for _ in range(300)]
    assert not any(pii.spans_of(texts, weights))


def test_many_texts_are_as_one(weights, monkeypatch):
    texts = [r[1] for r in people(60, 12)] + [None, ""]
    together = pii.spans_of(texts, weights)
    assert together == [pii.spans_of([t], weights)[0] for t in texts]
    monkeypatch.setattr(pii, "BLOCK", 5)
    assert together == pii.spans_of(texts, weights)


def test_report_and_redaction(corpus):
    rows = people(100) + [(r[0] and r[0] + 1000, *r[1:]) for r in MESSY]
    rows.append(doc(500, "see +1 (314) 555-6532 4663622617512349 here"))
    docs = corpus(rows).withColumn("pii_spans", F.lit(1)).withColumn("spans", F.lit(2))
    out = pii.report(docs).collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        if r.doc_id is None:
            continue
        base = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, *_ in base) for kind in pii.KINDS)
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
    assert {r.doc_id: r.spans for r in out}[500] == "phone:4:21,card:22:38"
    weights = pii.learn(docs)
    clean = {r.doc_id: r for r in pii.redact(corpus(rows), weights).collect()}
    assert clean[500].text == "see [PHONE] [CARD] here" and clean[500].n_chars == 23
    assert clean[1002].text is None and clean[1003].text == ""
    scanned = pii.scan(docs.drop("pii_spans"), weights)
    assert scanned.columns == [*docs.drop("pii_spans").columns, "pii_spans"] and scanned.count() == len(rows)


def test_nothing_to_learn_from(corpus):
    assert pii.report(corpus([])).collect() == []
    assert pii.learn(corpus([doc(1, "page 3"), doc(2, None)])) is None
    assert [r.spans for r in pii.report(corpus([doc(1, "page 3")])).collect()] == [""]
