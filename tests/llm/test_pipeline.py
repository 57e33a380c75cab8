import zlib

import numpy as np

import corpus_pipeline as cp
from relaymart.llm import packing, secret_scan, simhash
from relaymart.llm.common import tokenizer_path, words
from tests_llm_rows import MESSY, doc


def test_stages_and_their_order():
    assert [name for name, _ in cp.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "packing"]


def run_stages(spark, docs, sf_dir, tmp_path):
    out = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, sf_dir).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def test_planted_cases(spark, corpus, tmp_path):
    passage = " ".join(f"item{i}" for i in range(15))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    base = " ".join(f"alpha{i % 37} beta{i % 11} gamma{i}" for i in range(200))
    filler = " ".join(f"delta{i} epsilon{i % 7}" for i in range(120))
    rows = MESSY + [doc(30, base), doc(31, base), doc(32, base + " end"), doc(33, f"{filler} {passage} {filler}"),
                    doc(34, base[::-1] + " zeta password=0123456789abcdef tail"), doc(35, passage)]
    docs = corpus(rows).selectExpr("*", "7 as fp", "'kept' as note")
    out = run_stages(spark, docs, str(tmp_path), tmp_path)
    for name in list(out)[:-1]:
        assert out[name].columns == docs.columns
    ids = lambda name: sorted(x for x in (r.doc_id for r in out[name].select("doc_id").collect()) if x is not None)
    assert ids("language_id") == [1, 1, 5, 6, 7, 30, 31, 32, 33, 34, 35]  # null, empty, blank, letterless ones go
    assert ids("near_dedup") == [1, 5, 6, 7, 30, 33, 34, 35]
    assert ids("decontamination") == [1, 5, 6, 7, 30, 33, 34]
    texts = {r.doc_id: r for r in out["secret_scan"].collect()}
    assert passage not in texts[33].text and texts[33].n_chars == len(texts[33].text)
    assert secret_scan.REDACTED in texts[34].text and "0123456789abcdef" not in texts[34].text
    assert texts[30].text == base
    ids_of = packing.WordIds(tokenizer_path())
    pieces = out["packing"].collect()
    for r in pieces:
        if r.start == 0 and r.length == r.doc_tokens and r.doc_id is not None:
            expected = ids_of.of(texts[r.doc_id].text) + np.array([2], "<u4").tobytes()
            assert zlib.crc32(expected) == r.ids_crc32


def test_run_against_brute_force(spark, corpus, sf_small):
    """Which documents reach the packer, and with how many ids."""
    pieces = cp.run(spark, sf_small).collect()
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()
    fps = {r.doc_id: simhash.fingerprint(r.text) for r in docs}
    label = {r.doc_id: r.doc_id for r in docs if r.text and any(map(str.isalpha, r.text))}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if label[b] < label[a] and (fps[a] ^ fps[b]).bit_count() <= 4:
                    label[a], changed = label[b], True
    windows = {tuple(words(b.text)[k:k + 10]) for b in bench for k in range(max(1, len(words(b.text)) - 9))}
    hit = set()
    for r in docs:
        ws = words(r.text)
        if any(tuple(ws[k:k + 10]) in windows for k in range(len(ws))):
            hit.add(r.doc_id)
    kept = {r.doc_id for r in pieces}
    assert kept <= set(label.values())
    assert set(label.values()) - kept <= hit  # only documents full of passages are missing
    ids_of = packing.WordIds(tokenizer_path())
    by_id = {r.doc_id: r for r in docs}
    for r in pieces:
        text = by_id[r.doc_id].text
        if r.start == 0 and r.doc_id not in hit and not secret_scan.base_spans(text)[0]:
            assert r.doc_tokens == len(ids_of.of(text)) // 4 + 1
    n = sum(r.length for r in pieces)
    used = len({r.sequence_id for r in pieces})
    assert n > (used - 1) * packing.WINDOW * 0.97


def test_empty_documents(spark, corpus, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = run_stages(spark, corpus([]), str(tmp_path), tmp_path)
    assert all(df.count() == 0 for df in out.values())
