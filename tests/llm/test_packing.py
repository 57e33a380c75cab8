import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from relaymart.llm import packing as p
from relaymart.llm.common import tokenizer_path
from tests_llm_rows import MESSY, doc


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers(plain):
    known = p.WordIds(tokenizer_path())
    rng = random.Random(5)
    letters = list("abcdeABZ'sdtmrelv 0123.,!?\"\n<|éÀßñ-×\t́K数")
    texts = ["don't we've I'LL 'sx", "a<|endoftext|>b", "x\x1cy\x85z", "naïve9½ ΑΣ.", ""]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(800)]
    for text in texts:
        assert np.frombuffer(known.of(text), "<u4").tolist() == plain(text), text


def item_by_item(sizes, window):
    """Windows that plain best-fit decreasing opens."""
    free = []
    for s in sorted(sizes, reverse=True):
        fit = [c for c in free if c >= s]
        if fit:
            free.remove(min(fit))
            free.append(min(fit) - s)
        else:
            free.append(window - s)
    return sorted(free)


def test_plan_is_best_fit_decreasing():
    for seed in range(40):
        rng = random.Random(seed)
        window = rng.choice([8, 16, 31])
        sizes = [rng.randint(1, window) for _ in range(rng.randint(0, 120))]
        counts = {s: sizes.count(s) for s in set(sizes)}
        plan, used = p.best_fit(counts, window), {}
        for s, n in counts.items():
            runs = plan[plan.length == s].sort_values("rank0").to_dict("records")
            for rank in range(n):
                r = [x for x in runs if x["rank0"] <= rank][-1]
                k = rank - r["rank0"]
                used.setdefault(r["window0"] + k // r["per_window"], []).append((r["offset0"] + k % r["per_window"] * s, s))
        for placed in used.values():
            at = 0
            for offset, s in sorted(placed):
                assert offset == at
                at += s
            assert at <= window
        assert sorted(window - sum(s for _, s in w) for w in used.values()) == item_by_item(sizes, window)


def check(rows, docs, plain, window):
    """Every id in one piece, sequences gapless; returns the sequences' lengths."""
    expected = sorted((d[0] is None, d[0] or 0, len(plain(d[1])) + 1) for d in docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0) == expected
    sequences = {}
    for r in rows:
        assert r.length <= window and r.start % window == 0
        assert r.length == min(window, r.doc_tokens - r.start)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    return [sum(n for _, n in s) for s in sequences.values()]


def test_pack_messy_rows(corpus, plain):
    docs = corpus(MESSY).selectExpr("*", "1 as start", "2 as sequence_id", "3 as task")
    rows = p.pack(docs, window=512).collect()
    check(rows, MESSY, plain, 512)
    whole = np.array([*plain(MESSY[0][1]), 2], "<u4")
    assert {r.ids_crc32 for r in rows if r.doc_id == 1} == {zlib.crc32(whole.tobytes())}
    long = np.array([*plain(MESSY[8][1]), 2], "<u4")
    for r in rows:
        if r.doc_id == 6:
            assert r.ids_crc32 == zlib.crc32(long[r.start:r.start + r.length].tobytes())


def test_pack_has_little_padding(corpus, plain):
    rng = random.Random(1)
    docs = [doc(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randint(1, 90)))) for i in range(300)]
    lengths = check(p.pack(corpus(docs).repartition(5), window=64).collect(), docs, plain, 64)
    assert sum(lengths) > 0.97 * 64 * len(lengths)


def test_empty_table(corpus):
    assert p.pack(corpus([])).count() == 0
