import hashlib
import random

from relaymart.llm import decontaminate as d
from relaymart.llm.common import words
from tests_llm_rows import MESSY, doc


def brute(text, items, window=10):
    """(hit word positions, ids) by trying every window at every place."""
    ws, hit, ids = words(text), set(), set()
    for item, item_text in items:
        iw = words(item_text)
        size = min(window, len(iw))
        for k in range(len(iw) - size + 1 if iw else 0):
            for at in range(len(ws) - size + 1):
                if ws[at:at + size] == iw[k:k + size]:
                    hit.update(range(at, at + size))
                    ids.add("null" if item is None else str(item))
    return hit, ids


def random_case(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4)]
    items = [(i % 5, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 2, 3, 5, 8])))) for i in range(8)]
    docs = [doc(i, " ".join(rng.choices(vocab, k=rng.randint(0, 30)))) for i in range(12)]
    return docs, items


def test_automaton_against_brute_force():
    for seed in range(60):
        docs, items = random_case(seed)
        automaton = d.SuffixAutomaton([(str(i), words(t), True) for i, t in items], 4)
        for _, text, *_ in docs:
            spans, ids = automaton.scan(words(text))
            assert ({p for s, e in spans for p in range(s, e)}, ids) == brute(text, items, 4)


def test_query_on_messy_rows(corpus, spark):
    items = [(7, "The quick, brown fox jumps over the lazy dog and"), (None, "only TEXT"), (8, None), (9, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = corpus(MESSY).selectExpr("*", "1 as n_words", "'x' as bench_spans", "0 as item_id")
    rows = d.contamination(docs, bench).collect()
    assert len(rows) == len(MESSY)
    for (doc_id, text, *_), r in zip(sorted(MESSY, key=str), sorted(rows, key=lambda r: str((r.doc_id, r.n_words)))):
        assert r.n_words >= 0 and r.contaminated == (r.n_hit > 0)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_hit, by_id[1].n_items) == (10, 1)
    assert by_id[1].items_sha256 == hashlib.sha256(b"7").hexdigest()
    assert (by_id[5].n_hit, by_id[5].items_sha256) == (2, hashlib.sha256(b"null").hexdigest())
    assert by_id[6].n_words == 60_000 and by_id[2].n_words == 0


def test_several_automata_give_the_same(corpus, spark):
    docs, items = random_case(3)
    items = [(i, t + " " + " ".join(f"x{i}_{k}" for k in range(40))) for i, t in items]
    docs += [doc(100 + i, "a b " + t + " c") for i, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = corpus(docs)
    key = lambda rows: sorted((r.doc_id, r.bench_spans, r.bench_items) for r in rows)
    one = key(d.match(df, bench, window=4).collect())
    assert d.load_items(bench, 4, max_words=80).shards > 1
    assert key(d.match(df, bench, window=4, max_words=80).collect()) == one


def test_removal_cuts_passages_and_keeps_clean_documents(corpus, spark):
    passage = " ".join(f"p{i}" for i in range(12))
    filler = " ".join(f"f{i}" for i in range(30))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = [doc(1, f"{filler} {passage}! {filler}"), doc(2, filler), doc(3, passage), doc(4, None), doc(5, ""),
            # the passage appears only once its inner copy is cut
            doc(6, " ".join(f"p{i}" for i in range(5)) + " " + passage + " " + " ".join(f"p{i}" for i in range(5, 12))
                + " " + filler + " " + filler)]
    out = {r.doc_id: r for r in d.remove_spans(corpus(docs), bench).collect()}
    assert set(out) == {1, 2, 4, 5, 6}
    assert out[1].text == f"{filler} ! {filler}" and out[1].n_chars == len(out[1].text)
    assert out[2].text == filler and out[4].text is None and out[5].text == ""
    assert not brute(out[6].text, [(1, passage)])[0]


def test_removal_by_several_automata_gives_the_same(corpus, spark):
    rng = random.Random(5)
    said = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    items = [(i, said(f"p{i}_", 12)) for i in range(12)]
    shared = said("s", 9)  # windows of two items that overlap in a text
    items += [(20, f"{said('l', 6)} {shared}"), (21, f"{shared} {said('r', 6)}")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    # 30 % from one item and 30 % from another; overlapping windows; windows joined by cuts of others
    docs = [doc(i, f"{items[i % 12][1]} {said('f', 12)} {items[(i * 5 + 1) % 12][1]}") for i in range(12)]
    docs += [doc(50, f"{said('f', 30)} {said('l', 6)} {shared} {said('r', 6)} {said('g', 30)}")]
    for i in range(12):
        outer, inner = items[i][1].split(), items[(i * 7 + 3) % 12][1].split()
        nested = [*outer[:5], *inner[:6], *items[(i + 4) % 12][1].split(), *inner[6:], *outer[5:]]
        docs.append(doc(100 + i, " ".join([said("f", 40), *nested, said("g", 40)])))
    docs += [doc(200 + i, " ".join(rng.choices(said("q", 9).split(), k=20))) for i in range(5)]
    docs += [doc(300, None), doc(301, ""), doc(302, "no hit")]
    df = corpus(docs).selectExpr("*", "1 as bench_spans", "2 as bench_cut")
    assert d.load_items(bench, 10, max_words=100).shards > 1
    key = lambda rows: sorted(map(tuple, rows), key=str)
    one = d.remove_spans(df, bench).collect()
    several = d.remove_spans(df, bench, max_words=100)
    assert several.columns == df.columns and key(several.collect()) == key(one)
    assert {r.doc_id for r in one} == {50, *range(100, 112), *range(200, 205), 300, 301, 302}


def test_empty_tables(corpus, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(corpus([]), none).count() == 0
    assert [r.n_hit for r in d.contamination(corpus([doc(1, "a b")]), none).collect()] == [0]
