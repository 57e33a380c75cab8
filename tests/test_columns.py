import datetime as dt

from pyspark.sql import functions as F

from relaymart.functions import columns as C


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols)) \
        if cols else spark.range(1)
    return df.select(expr.alias("v")).first().v


def test_surrogate_key_matches_md5_of_joined_text(spark):
    import hashlib
    got = one(spark, C.surrogate_key([F.lit("a"), F.lit(None).cast("string"), F.lit(3)]))
    want = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-3").hexdigest()
    assert got == want


def test_normalize_email_strips_all_whitespace(spark):
    assert one(spark, C.normalize_email("x"), x="\t  User1@Example.COM \n") == "user1@example.com"
    assert one(spark, C.normalize_email("x"), x=None) is None


def test_normalize_event_type(spark):
    cases = {"processed": "sent", "OPEN": "opened", "click": "clicked",
             "group_resubscribe": "resubscribed", "email.delivered": "delivered",
             "email.open": "open", "": None, "bounce": "bounce"}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = dict(df.select("x", C.normalize_event_type("x").alias("v")).collect())
    assert got == cases


def test_privacy_or_bot_reason(spark):
    rows = [("opened", "GoogleImageProxy", "privacy_or_image_proxy"),
            ("clicked", "Barracuda Scanner", "bot_or_security_scanner"),
            ("clicked", "Mozilla/5.0", None),
            ("sent", "curl/8.0", None),
            ("opened", None, None),
            (None, "proxy-bot", "privacy_or_image_proxy")]  # NULL type is still tested
    df = spark.createDataFrame(rows, "et string, ua string, want string")
    for r in df.select("want", C.privacy_or_bot_reason("et", "ua").alias("v")).collect():
        assert r.v == r.want


def test_path_slugs(spark):
    assert one(spark, C.job_slug("p"), p="content/jobs/acme/senior-ae.md") == "senior-ae"
    assert one(spark, C.organization_slug("p"), p="content/jobs/acme/senior-ae.md") == "acme"
    assert one(spark, C.organization_slug("p"), p="content/organizations/acme.md") == "acme"
    assert one(spark, C.job_slug("p"), p="content/organizations/acme.md") == "md"
    assert one(spark, C.job_slug("p"), p="content/x") is None


def json_values(spark, text, key, kind="string"):
    df = spark.createDataFrame([(text,)], "j string").withColumn("_f", C.json_fields("j", [key]))
    return df.select(C.json_field("_f", "j", key, kind).alias("v"),
                     C.json_string_array("_f", "j", key).alias("a")).first()


def test_json_scalar_rules(spark):
    doc = '{"a":"x","n":null,"o":{"k":1},"l":[1,2],"b":true,"t":"[tag] x","d":"2024-01-05","m":["p",{"k":1}],"e":[]}'
    got = {k: tuple(json_values(spark, doc, k)) for k in ("a", "n", "o", "l", "missing", "t", "m", "e")}
    assert got == {"a": ("x", None), "n": (None, None), "o": (None, None), "l": (None, ["1", "2"]),
                   "missing": (None, None), "t": ("[tag] x", None), "m": (None, None), "e": (None, [])}
    assert json_values(spark, doc, "b", "boolean").v is True
    assert json_values(spark, doc, "d", "date").v == dt.date(2024, 1, 5)


def test_json_odd_documents(spark):
    assert tuple(json_values(spark, "not json", "a")) == (None, None)
    assert tuple(json_values(spark, None, "a")) == (None, None)
    assert tuple(json_values(spark, "[1]", "a")) == (None, None)
    # numbers as the parser prints them, strict double quotes, the last value of a
    # repeated key
    assert json_values(spark, '{"a":100000.00}', "a").v == "100000.0"
    assert json_values(spark, '{"a":-0.0}', "a").v == "-0.0"
    assert json_values(spark, "{'a':'q'}", "a").v is None
    assert json_values(spark, '{"a":"x","a":["y"]}', "a").a == ["y"]


def test_results_do_not_hang_on_session_settings(spark):
    flipped = {"spark.sql.jsonGenerator.ignoreNullFields": "false", "spark.sql.parser.escapedStringLiterals": "true"}
    ua = spark.createDataFrame([("opened", "x ggpht.com y", "2024-01-05"), ("opened", "ggphtxcom", "2024-1-5")],
                               "e string, u string, d string")
    def results():
        return ua.select(C.privacy_or_bot_reason("e", "u"), C.strict_cast(F.col("d"), "date"),
                         C.json_object_strip_nulls(("a", F.lit(None).cast("string")), ("b", F.col("u"))),
                         C.surrogate_key(["e", "u"]), C.normalize_email("u"), C.normalize_event_type("e")).collect()
    before = results()
    assert before[0][0] == "privacy_or_image_proxy" and before[1][0] is None
    old = {k: spark.conf.get(k) for k in flipped}
    try:
        for k, v in flipped.items():
            spark.conf.set(k, v)
        assert results() == before
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_json_object_strip_nulls(spark):
    v = one(spark, C.json_object_strip_nulls(("a", F.lit(None).cast("string")), ("b", F.lit(True)),
                                            ("c", F.lit("x"))))
    assert v == '{"b":true,"c":"x"}'
    v = one(spark, C.json_object_strip_nulls(("a", F.lit(None).cast("string"))))
    assert v == "{}"


def test_epoch_and_load_id(spark):
    assert one(spark, C.epoch_seconds_to_ts(F.lit(1704067207))) == dt.datetime(2024, 1, 1, 0, 0, 7)
    # 1706572000.9996 s -> rounds to the next millisecond (.9996 * 1000 = 999.6 -> 1000)
    got = one(spark, C.load_id_to_ts(F.lit("1706572000.9996")))
    assert got == dt.datetime(2024, 1, 29, 23, 46, 41)


def test_date_range_never_counts_down(spark):
    d = lambda s: F.lit(s).cast("date")
    assert one(spark, F.size(C.date_range(d("2024-01-03"), d("2024-01-01")))) == 0
    assert one(spark, F.size(C.date_range(d("2024-01-01"), d("2024-01-03")))) == 3
    assert one(spark, C.date_range(F.lit(None).cast("date"), d("2024-01-03"))) is None


def test_json_field_struct_path(spark):
    doc = '{"a":"x","n":null,"o":{"k":1},"l":[1,2],"b":true,"t":"[tag] x","u":"{not nested}"}'
    df = spark.createDataFrame([(doc,), ("not json",)], "j string")
    keys = ["a", "n", "o", "l", "b", "t", "u", "missing"]
    df = df.withColumn("_f", C.json_fields("j", keys))
    rows = df.select(*[C.json_field(F.col("_f"), F.col("j"), k).alias(k) for k in keys],
                     C.json_field(F.col("_f"), F.col("j"), "b", "boolean").alias("bb")).collect()
    r = rows[0]
    assert (r.a, r.n, r.o, r.l, r.b, r.t, r.u, r.missing, r.bb) == \
        ("x", None, None, None, "true", "[tag] x", "{not nested}", None, True)
    assert all(v is None for v in rows[1])


def test_strict_json_casts(spark):
    import pytest
    keys = ["b", "d"]
    ok = spark.createDataFrame([('{"b":"TRUE","d":"2024-1-5"}',), ('{"b":false}',), ("{}",)], "j string")
    ok = ok.withColumn("_f", C.json_fields("j", keys))
    rows = ok.select(C.json_field("_f", "j", "b", "boolean").alias("b"),
                     C.json_field("_f", "j", "d", "date").alias("d")).collect()
    assert [(r.b, r.d) for r in rows] == [(True, dt.date(2024, 1, 5)), (False, None), (None, None)]
    for bad in ('{"b":"yes"}', '{"d":"2024"}', '{"d":"2024-01-05 10:00:00"}'):
        df = spark.createDataFrame([(bad,)], "j string").withColumn("_f", C.json_fields("j", keys))
        with pytest.raises(Exception):
            df.select(C.json_field("_f", "j", "b", "boolean"),
                      C.json_field("_f", "j", "d", "date")).collect()
