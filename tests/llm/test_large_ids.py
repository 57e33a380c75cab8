"""Ids that a double cannot hold, in batches that also hold a null id."""
import pytest

from relaymart.llm import decontaminate, html_wrappers, language_id, packing, pii, quality_fm, secret_scan, simhash, token_alignment, warc
from tests_llm_rows import doc

FIRST = (1 << 60) + 1
IDS = [FIRST, FIRST + 2, None, FIRST + 4]
TEXTS = ["one two three four five six", "one two three four five six", "seven other words", "eight"]


@pytest.fixture(scope="module")
def docs(corpus):
    return corpus([doc(i, t, "aa") for i, t in zip(IDS, TEXTS)]).coalesce(1)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, "http://a.example/x", f"<p>{t}</p>") for i, t in zip(IDS, TEXTS)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)


def ids(rows):
    return sorted((r[0] for r in rows), key=lambda i: (i is None, i))


@pytest.mark.parametrize("operator", [
    language_id.predict, packing.pack, token_alignment.report, pii.report, secret_scan.report,
    lambda d: quality_fm.classify(d, d.selectExpr("doc_id", "1 as quality", "0 as toxic").limit(0)),
    lambda d: decontaminate.contamination(d, d.selectExpr("'i' as item_id", "text").limit(0)),
], ids=["language", "packing", "alignment", "pii", "secrets", "quality", "decontamination"])
def test_documents(docs, operator):
    assert ids(operator(docs).collect()) == [FIRST, FIRST + 2, FIRST + 4, None]


def test_groups(docs):
    got = {r.doc_id: r.component_id for r in simhash.groups(docs).collect()}
    assert got == {FIRST: FIRST, FIRST + 2: FIRST, FIRST + 4: FIRST + 4, None: None}


def test_pages(spark, pages):
    assert ids(html_wrappers.extract(pages).collect()) == [FIRST, FIRST + 2, FIRST + 4, None]
    for segment in (warc.SEGMENT, 60):  # whole records, and continuations
        out = warc.read_archives(spark, warc.write_archives(pages, 0, segment)).collect()
        assert ids(out) == [FIRST, FIRST + 2, FIRST + 4, None]
        assert {r.page_id: r.refers_to for r in out} == {FIRST: FIRST + 2, FIRST + 2: None, FIRST + 4: None, None: None}
