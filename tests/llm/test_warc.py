import base64
import hashlib
import io

import pytest

from relaymart.llm import warc as w

PAGES = "page_id long, url string, html string"


def expected(rows, min_bytes=0):
    last = {}
    for page_id, _, html in rows:
        if page_id is not None:
            last[html or ""] = max(page_id, last.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        to = last.get(html or "")
        revisit = len(payload) >= min_bytes and to is not None and to != page_id and \
            sum((h or "") == (html or "") for _, _, h in rows) > 1
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/1", "<p>same</p>"), (5, "http://a/5", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "u", None),
        (6, "http://b/ \r\nX: y", ""), (7, "u", "é" * 90_000), (8, "u", "é" * 90_000), (9, "u", "x\r\n\r\nWARC/1.1\r\n0\r\n\r\n"),
        (10, "u", "own"), (10, "u", "own"), (None, "u", "nameless"), (None, "u", "<p>same</p>"), (11, "u", "z" * 300_000)]


@pytest.mark.parametrize("min_bytes", [0, 12])
def test_round_trip(spark, corpus, min_bytes):
    pages = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 as last", "'x' as sha1", "2 as payload").repartition(3)
    got = w.round_trip(pages, min_bytes).collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS, min_bytes)


def test_archives_are_plain_records(spark, corpus):
    path = w.write_archives(spark.createDataFrame(ROWS, PAGES).coalesce(1), segment=50_000, archive=100_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    assert len(files) > 3
    import gzip

    kinds = {}
    for f in files:
        for fields, block in w.read_records(io.BytesIO(gzip.decompress(bytes(f.content)))):
            kinds[fields["warc-type"]] = kinds.get(fields["warc-type"], 0) + 1
            assert len(block) <= 50_000
    assert set(kinds) == {"response", "revisit", "continuation"} and kinds["continuation"] > 5
    got = w.read_archives(spark, path).collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS)


def test_chunked_framing():
    for n in (0, 1, 9, 10, 11, 25):
        payload = bytes(range(n))
        assert w.dechunked(w.chunked(payload, 10)) == payload
    with pytest.raises(ValueError):
        w.dechunked(b"5\r\nabcdefg\r\n0\r\n\r\n")


def test_damage_is_an_error():
    import pandas as pd

    one = b"".join(w.page_records(1, "u", b"x" * 100, None, False, "0-1"))
    with pytest.raises(ValueError):
        list(w.read_records(io.BytesIO(one[:-3])))
    parts = pd.DataFrame({"origin": "o", "copy": "c", "segment": [1, 3], "total": [None, 20], "block": [b"a", b"b"],
                          "record_type": "response", "payload_digest": "", "payload_bytes": 2, "page_id": 1})
    with pytest.raises(ValueError):
        w._reassemble(parts)


def test_empty_table(spark, corpus):
    assert w.round_trip(spark.createDataFrame([], PAGES)).count() == 0
