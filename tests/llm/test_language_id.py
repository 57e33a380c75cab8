import random

import numpy as np
from pyspark.sql import functions as F

from relaymart.llm import language_id as li
from tests_llm_rows import MESSY, doc

SYLLABLES = {"aa": ["ka", "ro", "mi", "ta"], "bb": ["sch", "ung", "ä", "en"], "cc": ["ж", "ов", "ни", "пр"]}


def rows(n=240, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(8, 60)))
        out.append(doc(i, text, lang))
    return out


def slow_bundle(text):
    """The bundle by definition, n-gram by n-gram."""
    letters = "".join(c.lower() if c.isalpha() else " " for c in text)
    letters = " " + " ".join(letters.split()) + " "
    out = np.zeros(li.DIM)
    for at in range(len(letters) - li.GRAM + 1):
        v = np.ones(li.DIM)
        for i, c in enumerate(letters[at:at + li.GRAM]):
            v = v * np.roll(li._letter_vector(ord(c)), li.GRAM - 1 - i)
        out += v
    return out / np.linalg.norm(out)


def test_bundles_by_definition(monkeypatch):
    texts = ["Some words, 12 more - words!", None, "", "12 !", "é", "данные и 数据"]
    for block in (li.BLOCK, 4):
        monkeypatch.setattr(li, "BLOCK", block)
        got = li.bundles(texts)
        for text, v in zip(texts, got):
            if text and any(map(str.isalpha, text)):
                assert np.allclose(v, slow_bundle(text), atol=1e-5)
            else:
                assert not v.any()


def test_held_out_accuracy_and_messy_rows(corpus):
    messy = [(r[0] and r[0] + 10_000, r[1], None, *r[3:]) for r in MESSY]
    docs = corpus(rows() + messy).withColumn("lang_pred", F.lit("x")).withColumn("v", F.lit(1))
    truth = {r[0]: r[2] for r in rows()}
    out = li.predict(docs).collect()
    assert len(out) == 240 + len(messy)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and all(r.lang_pred == truth[r.doc_id] for r in held)
    got = {r.doc_id: r for r in out}
    assert all(got[10_000 + i].lang_pred == "und" and got[10_000 + i].score == 0 for i in (2, 3, 4, 8))
    assert all(0 <= r.score <= 1 for r in out)


def test_stage_keeps_clean_documents(corpus):
    noise = "".join(chr(random.Random(9).randint(0x4E00, 0x9FFF)) for _ in range(400))
    extra = [doc(900, None), doc(901, "?!"), doc(902, noise), doc(903, "ka"), doc(None, "karo mita")]
    out = li.in_known_language(corpus(rows() + extra)).collect()
    ids = {r.doc_id for r in out}
    assert {r[0] for r in rows()} <= ids and {903, None} <= ids and not {900, 901, 902} & ids


def test_short_texts_in_no_learned_language_go_too(corpus):
    """The limit follows the length, learned from labelled texts."""
    rng = random.Random(11)
    cut = lambda r, k: (r[0] + 5000, " ".join(r[1].split()[:k]), *r[2:])
    short = [cut(r, 1 + i % 4) for i, r in enumerate(rows())]
    learned = rows() + short
    strange = [doc(20_000 + i, "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(30 + i))) for i in range(100)]
    strange += [doc(21_000 + i, " ".join("".join(rng.choices("qxwzjyhfvbp", k=6)) for _ in range(20)), None) for i in range(100)]
    out = {r.doc_id for r in li.in_known_language(corpus(learned + [(*r[:2], None, *r[3:]) for r in strange])).collect()}
    assert {r[0] for r in rows()} <= out and len({r[0] for r in short} - out) <= 0.02 * len(short)
    assert len({r[0] for r in strange} & out) <= 0.1 * len(strange)


def test_any_number_of_languages(corpus):
    rng = random.Random(12)
    letters = [chr(c) for c in range(0x4E00, 0x9FFF)]
    lexicons = [["".join(rng.choices(letters, k=4)) for _ in range(4)] for _ in range(2500)]
    docs = [doc(i, " ".join(rng.choices(lexicons[i % 2500], k=20)), f"l{i % 2500:04d}") for i in range(10_000)]
    out = li.predict(corpus(docs).repartition(8)).collect()
    seen = {r.doc_id % 2500 for r in out if not r.held_out}
    held = [r for r in out if r.held_out and r.doc_id % 2500 in seen]
    assert len(held) > 2000 and sum(r.lang_pred == f"l{r.doc_id % 2500:04d}" for r in held) >= 0.97 * len(held)


def test_prediction_by_definition(corpus):
    """Prototypes and cosines worked out text by text."""
    import zlib

    docs = rows(120)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    sums = {}
    for i, text, lang, *_ in docs:
        if not held(i):
            sums[lang] = sums.get(lang, 0) + slow_bundle(text)
    prototypes = {k: v / np.linalg.norm(v) for k, v in sums.items()}
    texts = {r[0]: r[1] for r in docs}
    for r in li.predict(corpus(docs)).collect():
        cosines = {k: float(v @ slow_bundle(texts[r.doc_id])) for k, v in prototypes.items()}
        assert r.lang_pred == max(cosines, key=cosines.get) and abs(r.score - max(cosines.values())) < 1e-4
        assert r.held_out == held(r.doc_id)


def test_nothing_to_learn_from(corpus):
    assert {r.lang_pred for r in li.predict(corpus([doc(1, "words", None)])).collect()} == {"und"}
    assert li.predict(corpus([])).count() == 0
    assert li.in_known_language(corpus([doc(1, "words", None)])).count() == 1


def test_every_labelled_text_is_learned_from(corpus, monkeypatch):
    """Prototypes and limits by definition, from more texts than a sample would hold."""
    monkeypatch.setattr(li, "MIN_SCORE", 1.0)
    rng = random.Random(13)
    syllables = SYLLABLES["aa"]
    texts = ["".join(rng.choices(syllables, k=2)) + " " + "".join(rng.choices(syllables, k=8)) for _ in range(4000)]
    texts += [a + b for a in syllables for b in syllables] * 3  # 48 short ones
    docs = corpus([doc(i, t, "aa") for i, t in enumerate(texts)]).repartition(6)
    names, prototypes = li.learn(docs, F.lit(True))
    vectors = li.bundles(texts)
    whole = vectors.astype(float).sum(axis=0)
    assert names == ["aa"] and np.allclose(prototypes[0], whole / np.linalg.norm(whole), atol=1e-6)
    least = li.limits(docs, F.lit(True), names, prototypes)
    short = (vectors @ prototypes.T)[4000:]
    assert {li._length(t) for t in texts} == {2, 4} and li._length(texts[-1]) == 2
    assert abs(least[2] - float(short.min()) / 2 * 48 * li.LOWEST) < 1e-5
