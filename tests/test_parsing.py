import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace import TRANSACTION_SCHEMA, parse_json, parse_transactions
from tests.conftest import plan_text, rows

COLUMNS = [
    "transaction_id",
    "buyer_buyer_id",
    "buyer_city",
    "buyer_name",
    "seller_platform",
    "seller_seller_id",
    "transaction_details_amount",
    "transaction_details_currency",
    "transaction_details_merchant",
    "transaction_details_transaction_time",
]


def message(**changes):
    record = {
        "transaction_id": "t 1",
        "buyer": {"buyer_id": 7, "city": "New York", "name": "A\nB"},
        "seller": {"platform": "web", "seller_id": 8},
        "transaction_details": {
            "amount": 1.5,
            "currency": "USD",
            "merchant": "M",
            "transaction_time": "2025-01-01 10:00:00",
        },
    }
    return json.dumps(record | changes, indent=2)


def parsed(spark, *texts, **options):
    values = [(None if t is None else bytearray(t.encode()),) for t in texts]
    return parse_transactions(spark.createDataFrame(values, "value binary"), **options)


def test_schema_of_the_flat_table(spark):
    out = parsed(spark, message())
    assert out.columns == COLUMNS
    assert dict(out.dtypes) | {} == {
        c: {
            "buyer_buyer_id": "bigint",
            "seller_seller_id": "bigint",
            "transaction_details_amount": "double",
        }.get(c, "string")
        for c in COLUMNS
    }


def test_whitespace_is_removed_inside_values_too(spark):
    row = parsed(spark, message()).collect()[0]
    assert row.transaction_id == "t1"
    assert row.buyer_city == "NewYork"
    assert row.transaction_details_transaction_time == "2025-01-0110:00:00"
    # An escaped line break is no whitespace in the JSON text.
    assert row.buyer_name == "A\nB"


def test_whitespace_can_be_kept(spark):
    row = parsed(spark, message(), strip=False).collect()[0]
    assert (row.transaction_id, row.buyer_city) == ("t 1", "New York")


@pytest.mark.parametrize(
    "text",
    [
        "not json",
        message()[:-1],
        message()[:40],
        "{}",
        "",
        "null",
        "5",
        '{"transaction_id": null}',
        None,
        "[" + message() + "," + message() + "]",
        '{"TRANSACTION_ID": "t"}',
    ],
)
def test_unusable_messages_are_dropped(spark, text):
    assert parsed(spark, text).collect() == []


def test_wrong_type_nulls_one_field_only(spark):
    buyer = {"buyer_id": "notnum", "city": "c", "name": "n"}
    row = parsed(spark, message(buyer=buyer)).collect()[0]
    assert (row.buyer_buyer_id, row.buyer_city, row.seller_seller_id) == (None, "c", 8)


def test_null_struct_unknown_field_and_number_as_text(spark):
    row = parsed(spark, message(buyer=None, more=1, transaction_id=7)).collect()[0]
    assert (row.transaction_id, row.buyer_buyer_id, row.buyer_name) == ("7", None, None)


def test_nan_amount(spark):
    details = {"amount": "NaN", "currency": "USD", "merchant": "M", "transaction_time": "x"}
    row = parsed(spark, message(transaction_details=details)).collect()[0]
    assert row.transaction_details_amount != row.transaction_details_amount


def test_dropped_messages_are_counted_on_the_way(spark):
    seen = Observation()
    out = parsed(spark, message(), "not json", message(), metrics=seen)
    assert out.count() == 2
    assert seen.get == {"rows": 3, "missing": 1}


def test_each_text_is_parsed_once(spark):
    """The null filter must not bring a second from_json with it."""
    out = parsed(spark, message())
    assert plan_text(out, "simple").count("from_json") == 1
    assert "Exchange" not in plan_text(out)


def test_parse_json_keeps_columns_and_all_rows(spark):
    df = spark.createDataFrame([(1, '{"k": 2}'), (2, "bad"), (3, None)], "id int, `the text` string")
    schema = TRANSACTION_SCHEMA.__class__.fromDDL("k bigint")
    out = parse_json(df, "the text", schema, keep=("id",))
    assert rows(out) == [(1, 2), (2, None), (3, None)]


def test_parse_json_refuses_equal_names(spark):
    df = spark.createDataFrame([(1, "{}")], "k int, t string")
    with pytest.raises(ValueError, match="k"):
        parse_json(df, "t", TRANSACTION_SCHEMA.__class__.fromDDL("K int"), keep=("k",))


def test_arrays_in_the_schema_become_rows(spark):
    schema = TRANSACTION_SCHEMA.__class__.fromDDL(
        "transaction_id string, items array<struct<sku: string, n: int>>"
    )
    text = '{"transaction_id": "a", "items": [{"sku": "x", "n": 1}, {"sku": "y"}]}'
    out = parsed(spark, text, '{"items": [{"sku": "z"}]}', schema=schema)
    assert rows(out) == sorted([("a", "x", 1), ("a", "y", None)], key=repr)


def test_required_may_be_a_nested_column(spark):
    out = parsed(spark, message(), message(buyer=None), required="buyer_buyer_id")
    assert [r.buyer_buyer_id for r in out.collect()] == [7]
    assert out.filter(F.col("buyer_buyer_id").isNull()).count() == 0


WORD = st.one_of(st.none(), st.text("ab cé\t", max_size=5))
NUMBER = st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1))
RECORD = st.fixed_dictionaries(
    {
        "transaction_id": WORD,
        "buyer": st.one_of(
            st.none(), st.fixed_dictionaries({"buyer_id": NUMBER, "city": WORD, "name": WORD})
        ),
        "seller": st.fixed_dictionaries({}, optional={"platform": WORD, "seller_id": NUMBER}),
        "transaction_details": st.fixed_dictionaries(
            {"amount": st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False))},
            optional={"currency": WORD, "merchant": WORD, "transaction_time": WORD},
        ),
    }
)


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(records=st.lists(RECORD, min_size=1, max_size=5))
def test_parsing_equals_brute_force(spark, records):
    def flat(record):
        buyer, seller = record["buyer"] or {}, record["seller"]
        details = record["transaction_details"]
        found = [record["transaction_id"]]
        found += [buyer.get(k) for k in ("buyer_id", "city", "name")]
        found += [seller.get(k) for k in ("platform", "seller_id")]
        found += [details.get(k) for k in ("amount", "currency", "merchant", "transaction_time")]
        # Only spaces are whitespace in the JSON text: json.dumps escapes tabs.
        return tuple(v.replace(" ", "") if isinstance(v, str) else v for v in found)

    out = parsed(spark, *[json.dumps(r, ensure_ascii=False) for r in records])
    expected = [flat(r) for r in records if r["transaction_id"] is not None]
    assert rows(out) == sorted(expected, key=repr)


def test_only_named_fields_are_parsed(spark):
    schema = StructType.fromDDL("a int, b string, c struct<d: int>")
    texts = spark.createDataFrame([('{"a": 1, "b": "x", "c": {"d": 2}}',), ("no",)], "json string")
    found = parse_json(texts, "json", schema, fields=["c", "a"])
    assert found.columns == ["a", "c"] and rows(found) == rows(parse_json(texts, "json", schema).select("a", "c"))
    plan = plan_text(found)
    assert plan.count("from_json") == 1 and "StructField(b" not in plan
    with pytest.raises(ValueError, match="not in the schema"):
        parse_json(texts, "json", schema, fields=["z"])
