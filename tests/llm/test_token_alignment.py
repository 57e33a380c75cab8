import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from relaymart.llm import token_alignment as t
from tests_llm_rows import MESSY, doc

ROWS = MESSY + [doc(20 + i, text) for i, text in enumerate([
    "Tokenizers disagree about antidisestablishmentarianism, 漢字, naïveté and 12345.67!", "a▁b has the sign itself",
    "<|endoftext|> and <s> or <0x41> are plain text", "  two  blanks  ", "tab\tline\nend\r\n", "\x00 zero", "🙂🙂 emoji",
    "the the the the", "the the the the", "x" * 3000, "a" * 40 + " ", "日本語のテキスト" * 30])]


def brute(rows):
    """Links by walking both token sequences byte by byte."""
    v = t.vocabularies(*t._paths(None, None))
    links, docs = Counter(), []
    for doc_id, text, *_ in rows:
        a = v.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = v.b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(v.bytes_a[i] for i in a) != whole or b"".join(v.bytes_b[i] for i in b) != whole:
            a, b = [], []
        groups, i, j = [], 0, 0
        while i < len(a):
            ga, gb = [a[i]], [b[j]]
            i, j = i + 1, j + 1
            while (n := sum(len(v.bytes_a[x]) for x in ga)) != (m := sum(len(v.bytes_b[x]) for x in gb)):
                if n < m:
                    ga.append(a[i])
                    i += 1
                else:
                    gb.append(b[j])
                    j += 1
            groups.append((ga, gb))
        pairs = [(ga[-1], gb[-1]) for ga, gb in groups]
        links.update(pairs)
        docs.append((doc_id, len(a), len(b), groups, pairs))
    best = Counter()
    for (_, b), n in links.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, n_a, n_b, groups, pairs in docs:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(pairs), sum(links[p] == best[p[1]] for p in pairs),
                    sum(links[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, links


@pytest.mark.parametrize("hot", [t.HOT, 8, 0])
def test_report_against_brute_force(corpus, hot):
    docs = corpus(ROWS).withColumn("pair", F.lit(1)).withColumn("n", F.lit("x")).withColumn("row", F.lit(2))
    got = [tuple(r) for r in t.report(docs, hot=hot).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(brute(ROWS)[0], key=key)
    by_id = {r[0]: r for r in got}
    assert by_id[21][1:] == (0, 0, 0, 0, 0, 0, "") == by_id[2][1:] == by_id[3][1:]


def test_alignment_table(corpus, monkeypatch):
    monkeypatch.setattr(t, "GATHERED", 4)
    v = t.vocabularies(*t._paths(None, None))
    rows = t.align(corpus(ROWS)).collect()
    assert {(r.a, r.b): r.n for r in rows} == brute(ROWS)[1]
    assert all(r.same == (v.identity[r.a] == r.b) for r in rows)


def test_identity_map():
    v = t.vocabularies(*t._paths(None, None))
    for a, b in enumerate(v.identity):
        assert b < 0 or v.bytes_a[a] == v.bytes_b[b]
    known = {v.bytes_b[i] for i in range(3, len(v.bytes_b))}
    assert all((b >= 0) == (v.bytes_a[a] in known) for a, b in enumerate(v.identity))


def test_quick_encoder_gives_the_tokenizers_ids():
    v, rng = t.vocabularies(*t._paths(None, None)), random.Random(3)
    assert v.quick is not None
    texts = ["".join(map(chr, rng.choices(range(0x250), k=rng.randint(1, 40)))) for _ in range(5000)]
    texts += ["".join(rng.choices("ab é's'll19 \n\t!?.,Ñ\xa0\x85", k=rng.randint(1, 60))) for _ in range(5000)]
    texts += [" " * 100_000, "a" * 100_000, "日本 mixed", "<|endoftext|>"]
    assert v._encode_a(texts) == [v.a.encode(x, add_special_tokens=False).ids for x in texts]


def test_empty_table(corpus):
    assert t.report(corpus([])).collect() == []
    assert [tuple(r)[1:] for r in t.report(corpus([doc(1, None)])).collect()] == [(0, 0, 0, 0, 0, 0, "")]
