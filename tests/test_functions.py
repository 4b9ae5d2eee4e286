import hashlib
import hmac

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.hashing import hmac_sha256_hex, pii_hash, sha256_hex
from tidemark.functions.ids import gid_to_long
from tidemark.naming import snake_case


@pytest.mark.parametrize("raw,expected", [
    ("gid://x/Order/123", 123),
    ("gid://x/X/9?y=1", 9),
    ("gid://x/X/9?y=a/b", None),
    ("gid://x/Order/", None),
    ("12", 12),
    ("", None),
    (None, None),
    ("gid://x/Order/abc", None),
    ("gid://x/Order/-5", -5),
])
def test_gid_to_long(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(gid_to_long("v")).first()[0] == expected


def test_snake_case():
    assert snake_case("totalPriceSet") == "total_price_set"
    assert snake_case("countryCodeV2") == "country_code_v2"
    assert snake_case("_loaded_at") == "_loaded_at"
    assert snake_case("shopId") == "shop_id"
    assert snake_case("ianaTimezone") == "iana_timezone"


VALUES = ["a@b.c", "", "Zoë Ünicode ☃", "x" * 300, "+1 555 0100", "line\nbreak"]
KEYS = ["k", "secret-6", "y" * 64, "z" * 100]


def test_sha256_matches_hashlib(spark):
    df = spark.createDataFrame([(v,) for v in VALUES] + [(None,)], "v string")
    got = dict(df.select("v", sha256_hex("v").alias("h")).collect())
    for v in VALUES:
        assert got[v] == hashlib.sha256(v.encode()).hexdigest()
    assert got[None] is None


@pytest.mark.parametrize("key", KEYS)
def test_hmac_matches_stdlib(spark, key):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    got = dict(df.select("v", hmac_sha256_hex("v", key).alias("h")).collect())
    for v in VALUES:
        assert got[v] == hmac.new(key.encode(), v.encode(), hashlib.sha256).hexdigest()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20), st.text(min_size=1, max_size=80))
def test_hmac_property(spark, values, key):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", hmac_sha256_hex("v", key).alias("h")).collect()
    for v, h in rows:
        assert h == hmac.new(key.encode(), v.encode(), hashlib.sha256).hexdigest()


def test_empty_secret_rejected():
    with pytest.raises(ValueError):
        pii_hash(F.col("x"), "")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(min_value=-5, max_value=5), max_size=6), min_size=1, max_size=8))
def test_explode_then_regroup_is_identity(spark, arrays):
    from tidemark.operators.nested import explode_child

    rows = [(i, a) for i, a in enumerate(arrays)]
    df = spark.createDataFrame(rows, "id long, xs array<int>")
    child = explode_child(df, "xs", {"id": "parent_id"}, index="index", scalar_name="x")
    back = child.groupBy("parent_id").agg(F.array_sort(F.collect_list(F.struct("index", "x"))).alias("s"))
    got = {r.parent_id: [e.x for e in r.s] for r in back.collect()}
    assert got == {i: a for i, a in rows if a}


def test_gid_is_cut_without_patterns():
    assert "split" not in str(gid_to_long(F.col("v")))


@pytest.mark.parametrize("raw", ["gid://x/", "gid://x/?", "?1", "7?x?y", "a/8", "gid://x/Y/5?", "gid://", "gid://x//6", " 4 ", "gid://x/é/3?ü"])
def test_gid_cuts_as_patterns_do(spark, raw):
    s = F.col("v")
    tail = F.when(s.contains("gid://"), F.element_at(F.split(s, "/"), -1)).otherwise(s)
    row = spark.createDataFrame([(raw,)], "v string").select(gid_to_long("v"), F.split(tail, r"\?").getItem(0).try_cast("bigint")).first()
    assert row[0] == row[1]
