"""The registered corpus queries: columns and types of the contract, one row
per input row where it asks for that, and the SQL form where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry

CONTRACT = {
    "op1_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_decontaminate": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op3_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op4_pack": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op5_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
                        "labels string, score double",
    "op6_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op7_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op8_html_text": "page_id bigint, url string, text string, n_chars bigint",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op10_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op11_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op12_token_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                            "count_sum bigint, groups_sha256 string",
    "op13_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
                      "identity_error double",
}


def test_all_are_registered():
    assert set(entry.LLM_QUERIES) == {*CONTRACT, "pipeline"}


@pytest.mark.parametrize("name", CONTRACT)
def test_contract(spark, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == CONTRACT[name]
    rows = df.collect()
    con = duckdb.connect()
    source = "pages" if "page_id" in df.columns else "embeddings" if "vec_id" in df.columns else "documents"
    n = con.sql(f"select count(*) from '{sf_small}/{source}.parquet'").fetchall()[0][0]
    if name == "op13_whitening":
        assert len(rows) == 16 * n
    elif source == "embeddings":
        assert len(rows) == 20 * len({r.query_id for r in rows}) == 20 * n // 20
    elif name == "op4_pack":
        assert len({r.doc_id for r in rows}) == n
    else:
        assert len(rows) == n
    if name in entry.LLM_ORACLE_SQL:
        con.sql(f"create view pages as select * from '{sf_small}/pages.parquet'")
        sql = con.sql(entry.LLM_ORACLE_SQL[name])
        order = [sql.columns.index(c) for c in df.columns]
        assert sorted(map(tuple, rows)) == sorted(tuple(r[i] for i in order) for r in sql.fetchall())
