import datetime as dt
from functools import partial

import pytest

from millrace import Labels, Role, enrich, enrich_trips, load_trips
from millrace.plans.enrichment import ZONE_SCHEMA
from tests.conftest import plan_text, rows

MAPPINGS = {
    "VendorID": {1: "First Vendor", 2: "Second Vendor"},
    "RatecodeID": {1: "Standard", 2: "Airport"},
    "payment_type": {1: "Card", 2: "Cash"},
    "store_and_fwd_flag": {"Y": "stored", "N": "direct"},
}
TRIPS = "VendorID int, tpep_pickup_datetime timestamp_ntz, RatecodeID bigint, store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type bigint, extra double"
ZONES = [
    (1, "EWR", "Newark, Airport", "EWR"),
    (2, "Queens", "Jamaica Bay", "Boro Zone"),
    (264, "Unknown", "N/A", None),
]


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(
        [
            (1, dt.datetime(2025, 1, 1, 23, 59, 59), 1, "Y", 1, 2, 1, 0.5),
            (2, dt.datetime(2025, 1, 2), 99, "N", 2, 2, 2, 1.5),
            (9, dt.datetime(2025, 1, 2, 12), None, None, None, 264, 0, 2.5),
            (1, None, 2, "?", 77, None, None, None),
        ],
        TRIPS,
    )


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(ZONES, ZONE_SCHEMA)


EXPECTED_COLUMNS = [
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "extra",
    "vendorName",
    "rateCodeName",
    "paymentMethod",
    "storeFwd",
    "cobdate",
    "Pickup_Borough",
    "Pickup_Zone",
    "Pickup_Service_Zone",
    "DropOff_Borough",
    "DropOff_Zone",
    "DropOff_Service_Zone",
]


def test_enriched_trips(trips, zones):
    out = enrich_trips(trips, zones, MAPPINGS)
    assert out.columns == EXPECTED_COLUMNS
    by_extra = {r.extra: r for r in out.collect()}
    assert len(by_extra) == 4
    first = by_extra[0.5]
    assert first[4:] == (
        "First Vendor", "Standard", "Card", "stored", dt.date(2025, 1, 1),
        "EWR", "Newark, Airport", "EWR", "Queens", "Jamaica Bay", "Boro Zone",
    )
    assert by_extra[1.5].rateCodeName is None and by_extra[1.5].cobdate == dt.date(2025, 1, 2)
    odd = by_extra[2.5]
    assert odd[4:] == (
        None, None, None, None, dt.date(2025, 1, 2), None, None, None, "Unknown", "N/A", None,
    )
    empty = by_extra[None]
    assert (empty.cobdate, empty.Pickup_Zone, empty.DropOff_Zone) == (None, None, None)


def test_duplicate_zone_multiplies_its_trips(spark, trips):
    zones = spark.createDataFrame([*ZONES, (2, "Queens", "Copy", "x")], ZONE_SCHEMA)
    out = enrich_trips(trips, zones, MAPPINGS)
    assert out.count() == 2 + 4 + 1 + 1


def test_label_may_take_the_name_of_its_code(spark, zones):
    facts = spark.createDataFrame([(1, 2)], "code int, place int")
    out = enrich(
        facts, zones, dimension_key="LocationID", roles=[Role("place", {"Zone": "zone"})],
        labels=[Labels("code", "code", {1: "one"})],
    )
    assert rows(out) == [(2, "one", "Jamaica Bay")]


def test_event_time_as_text_or_zoned(spark, zones, set_conf):
    facts = spark.createDataFrame(
        [(1, "2025-02-03 23:30:00"), (2, "2025-02-30"), (3, "soon"), (4, None)], "id int, t string"
    )
    dated = enrich(facts, zones, dimension_key="LocationID", roles=[], event_time="t")
    assert rows(dated.select("id", "event_date")) == sorted(
        [(1, dt.date(2025, 2, 3)), (2, None), (3, None), (4, None)], key=repr
    )
    set_conf(spark__sql__session__timeZone="America/New_York")
    zoned = spark.sql("SELECT TIMESTAMP'2025-02-03 23:30:00 UTC' AS t")
    out = enrich(zoned, zones, dimension_key="LocationID", roles=[], event_time="t", date_column="d")
    assert out.collect()[0].d == dt.date(2025, 2, 3)
    late = spark.sql("SELECT TIMESTAMP'2025-02-04 03:30:00 UTC' AS t")
    out = enrich(late, zones, dimension_key="LocationID", roles=[], event_time="t", date_column="d")
    assert out.collect()[0].d == dt.date(2025, 2, 3)


def test_repeated_label_is_refused(spark, zones):
    facts = spark.createDataFrame([(1, 2)], "code int, place int")
    with pytest.raises(ValueError, match="place"):
        enrich(
            facts, zones, dimension_key="LocationID", roles=[],
            labels=[Labels("code", "Place", {1: "one"})],
        )


def test_load_from_files_to_a_dated_table(spark, trips, zones, tmp_path, namespace):
    trips.write.parquet(str(tmp_path / "data"))
    zones.write.option("header", True).csv(str(tmp_path / "misc"))
    table = f"{namespace}.trips"
    for _ in range(2):
        written = load_trips(spark, str(tmp_path / "data"), str(tmp_path / "misc"), table, MAPPINGS)
        assert written == 4
    out = spark.table(table)
    assert rows(out.select(*EXPECTED_COLUMNS)) == rows(enrich_trips(trips, zones, MAPPINGS))
    assert spark.sql(f"SELECT count(*) FROM {table}").collect()[0][0] == 4
    assert "PartitionFilters: [isnotnull(cobdate" in plan_text(out.filter("cobdate = date'2025-01-02'"))


def test_only_needed_columns_are_read(spark, trips, zones, tmp_path):
    trips.write.parquet(str(tmp_path / "data"))
    zones.write.option("header", True).csv(str(tmp_path / "misc"))
    from millrace.sources import read_csv, read_parquet

    out = enrich_trips(
        read_parquet(spark, str(tmp_path / "data")),
        read_csv(spark, str(tmp_path / "misc"), ZONE_SCHEMA),
        MAPPINGS,
    ).select("vendorName", "DropOff_Zone")
    plan = plan_text(out)
    assert "ReadSchema: struct<VendorID:int,PULocationID:int,DOLocationID:int>" in plan
    assert plan.count("BroadcastHashJoin LeftOuter") == 2


def test_labels_are_made_after_the_joins(spark, set_conf):
    """What a shuffled join carries are the codes."""
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    facts = spark.range(50).selectExpr("id", "id % 3 AS code", "id % 4 AS place", "TIMESTAMP'2025-01-01' AS t")
    places = spark.range(4).selectExpr("id AS key", "'n' AS name")
    out = enrich(
        facts,
        places,
        dimension_key="key",
        roles=[Role("place", {"name": "place_name"})],
        labels=[Labels("code", "label", {0: "zero", 1: "one"})],
        event_time="t",
    )
    assert out.columns == ["id", "place", "t", "label", "event_date", "place_name"]
    plan = plan_text(out, "simple")
    assert "SortMergeJoin" in plan
    assert "label" not in plan[plan.index("SortMergeJoin") :] and "zero" not in plan[plan.index("SortMergeJoin") :]


def test_text_codes_meet_number_keys_as_text(spark):
    facts = spark.createDataFrame([("1",), ("x",), (None,)], "code string")
    places = spark.range(1).selectExpr("id AS key")
    out = enrich(facts, places, dimension_key="key", roles=[], labels=[Labels("code", "label", {1: "one", None: "none"})])
    assert rows(out) == sorted([("one",), (None,), ("none",)], key=repr)


def test_months_that_gain_a_column(spark, tmp_path, namespace):
    """The extra column of one month survives, and zones may come with reader options."""
    names = "VendorID int, RatecodeID int, payment_type int, store_and_fwd_flag string, tpep_pickup_datetime timestamp, PULocationID int, DOLocationID int"
    row = (1, 1, 1, "N", dt.datetime(2025, 1, 2), 1, 1)
    spark.createDataFrame([row], names).write.parquet(f"{tmp_path}/trips")
    spark.createDataFrame([(*row, 2.5)], names + ", fee double").write.mode("append").parquet(f"{tmp_path}/trips")
    (tmp_path / "zones.csv").write_text("LocationID;Borough;Zone;service_zone\n1;B;Z;S\n")
    maps = {c: {} for c in ("VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag")}
    table = f"{namespace}.trips"
    written = load_trips(spark, f"{tmp_path}/trips", f"{tmp_path}/zones.csv", table, maps, csv_options={"sep": ";"})
    out = spark.table(table)
    assert written == 2 and sorted(map(repr, (r.fee for r in out.collect()))) == ["2.5", "None"]
    assert {r.Pickup_Zone for r in out.collect()} == {"Z"}


# --- what load_trips does with zones and dates ------------------------------------------


def trips_of(spark, folder, *rows_of):
    schema = "VendorID int, RatecodeID int, payment_type int, store_and_fwd_flag string, tpep_pickup_datetime timestamp, PULocationID int, DOLocationID int"
    spark.createDataFrame([(1, 1, 1, "Y", t, a, b) for t, a, b in rows_of], schema).write.mode("overwrite").parquet(folder)


SHORT_MAPPINGS = {"VendorID": {1: "v"}, "RatecodeID": {1: "r"}, "payment_type": {1: "p"}, "store_and_fwd_flag": {"Y": "yes"}}


def zones_of(tmp_path, *lines):
    (tmp_path / "zones").mkdir(exist_ok=True)
    (tmp_path / "zones" / "z.csv").write_text("\n".join(["LocationID,Borough,Zone,service_zone", *lines, ""]))
    return str(tmp_path / "zones")


def test_zone_lines_that_do_not_fit(spark, tmp_path, namespace):
    day = dt.datetime(2025, 1, 1, 9)
    trips_of(spark, str(tmp_path / "trips"), (day, 1, 2))
    zones = zones_of(tmp_path, "1,a,b,c", "x2,a,b,c")
    load = partial(load_trips, spark, str(tmp_path / "trips"), zones, f"{namespace}.t", SHORT_MAPPINGS)
    with pytest.raises(Exception, match="does not fit the schema: x2,a,b,c"):
        load()
    assert not spark.catalog.tableExists(f"{namespace}.t")
    assert load(zone_rejects=f"{namespace}.bad") == 1
    assert rows(spark.table(f"{namespace}.bad")) == [("x2,a,b,c",)]
    assert rows(spark.table(f"{namespace}.t").select("Pickup_Zone", "DropOff_Zone")) == [("b", None)]


def test_a_zone_that_is_there_twice(spark, tmp_path, namespace):
    day = dt.datetime(2025, 1, 1, 9)
    trips_of(spark, str(tmp_path / "trips"), (day, 1, 2))
    zones = zones_of(tmp_path, "1,a,b,c", "1,a,other,c")
    load = partial(load_trips, spark, str(tmp_path / "trips"), zones, f"{namespace}.t", SHORT_MAPPINGS)
    assert load() == 2
    with pytest.raises(Exception, match="LocationID more than once: 1"):
        load(unique=True)
    assert spark.table(f"{namespace}.t").count() == 2


def test_months_are_loaded_one_by_one(spark, tmp_path, namespace):
    january, february = dt.datetime(2025, 1, 5, 9), dt.datetime(2025, 2, 5, 9)
    zones = zones_of(tmp_path, "1,a,b,c")
    load = partial(load_trips, spark, str(tmp_path / "trips"), zones, f"{namespace}.t", SHORT_MAPPINGS, reload_dates=True)
    for content, total in (([(january, 1, 1)], 1), ([(february, 1, 1)] * 2, 3), ([(january, 1, 2)] * 3, 5)):
        trips_of(spark, str(tmp_path / "trips"), *content)
        assert load() == len(content)
        assert spark.table(f"{namespace}.t").count() == total
    found = spark.table(f"{namespace}.t").groupBy("cobdate", "DOLocationID").count()
    assert rows(found) == [(january.date(), 2, 3), (february.date(), 1, 2)]


def test_long_mappings_are_joined(spark):
    facts = spark.createDataFrame([(k, "1" if k else None) for k in (None, 0, 1, 500, 99999)], "id int, place string")
    places = spark.createDataFrame([("1", "one")], "key string, name string")
    mapping = {k: f"label {k}" for k in range(1000)} | {None: "none"}
    out = enrich(
        facts, places, dimension_key="key", roles=[Role("place", {"name": "place_name"})], labels=[Labels("id", "id", mapping)]
    )
    assert rows(out.select("id")) == sorted([("none",), ("label 0",), ("label 1",), ("label 500",), (None,)], key=repr)
    assert "BroadcastHashJoin" in plan_text(out) and "CASE WHEN (id" not in plan_text(out)
