import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace import bytes_to_text, lookup, strip_whitespace
from tests.conftest import rows


def test_lookup_known_unknown_and_null_codes(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (None,)], "c int")
    out = df.select("c", lookup({1: "one", 2: "two"}, F.col("c")).alias("label"))
    assert rows(out) == sorted([(1, "one"), (2, "two"), (9, None), (None, None)], key=repr)


def test_lookup_default_covers_unknown_and_null(spark):
    df = spark.createDataFrame([("Y",), ("?",), (None,)], "c string")
    out = df.select("c", lookup({"Y": "yes"}, F.col("c"), default="n/a").alias("label"))
    assert rows(out) == sorted([("Y", "yes"), ("?", "n/a"), (None, "n/a")], key=repr)


def test_lookup_none_key_labels_null_codes(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "c int")
    out = df.select("c", lookup({1: "one", None: "missing"}, F.col("c")).alias("label"))
    assert rows(out) == sorted([(1, "one"), (None, "missing"), (2, None)], key=repr)


def test_lookup_widens_types_instead_of_overflowing(spark):
    df = spark.createDataFrame([(1, 1.0), (10**12, 1.5)], "big bigint, real double")
    out = df.select(
        lookup({1: "one"}, F.col("big")).alias("a"), lookup({1: "one"}, F.col("real")).alias("b")
    )
    assert rows(out) == sorted([("one", "one"), (None, None)], key=repr)


def test_lookup_empty_mapping(spark):
    df = spark.createDataFrame([(1,)], "c int")
    out = df.select(lookup({}, F.col("c")).alias("a"), lookup({}, F.col("c"), "d").alias("b"))
    assert out.dtypes == [("a", "string"), ("b", "string")]
    assert rows(out) == [(None, "d")]


def test_strip_whitespace_everywhere_in_the_value(spark):
    text = " New \t York\n\x0b\f\r city x "
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    out = df.select(strip_whitespace(F.col("t")).alias("t"))
    assert rows(out) == sorted([("NewYorkcity x",), (None,), ("",)], key=repr)


def test_bytes_to_text(spark):
    df = spark.createDataFrame([(bytearray("é{}".encode()),), (None,)], "v binary")
    assert rows(df.select(bytes_to_text(F.col("v")))) == sorted([("é{}",), (None,)], key=repr)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(st.sampled_from(" \t\n\x0b\f\rab\u00a0\u2003é中"), max_size=30), min_size=1))
def test_strip_whitespace_equals_its_definition(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", strip_whitespace(F.col("t")).alias("t"))
    assert rows(out) == rows(
        spark.createDataFrame(
            [(i, re.sub(r"[ \t\n\x0b\f\r]", "", t)) for i, t in enumerate(texts)],
            "i int, t string",
        )
    )


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    mapping=st.dictionaries(st.one_of(st.none(), st.integers(-5, 5)), st.text("xyz", max_size=2)),
    codes=st.lists(st.one_of(st.none(), st.integers(-6, 6)), min_size=1, max_size=20),
    default=st.one_of(st.none(), st.just("other")),
)
def test_lookup_equals_a_dictionary(spark, mapping, codes, default):
    df = spark.createDataFrame([(c,) for c in codes], "c bigint")
    out = df.select("c", lookup(mapping, F.col("c"), default).alias("label"))
    assert rows(out) == sorted([(c, mapping.get(c, default)) for c in codes], key=repr)
