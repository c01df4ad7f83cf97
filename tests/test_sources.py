import datetime
from pathlib import Path

import pytest
from pyspark.sql import Observation, functions as F
from pyspark.sql.types import StructType

from millrace.sources import (
    build_session,
    object_store_conf,
    read_csv,
    read_file_stream,
    read_kafka,
    read_parquet,
    rest_catalog_conf,
    scale_conf,
    split_csv,
)
from millrace.plans.enrichment import ZONE_SCHEMA
from tests.conftest import plan_text, rows
from millrace.sources.scratch import scratch_folder


def test_csv_header_quotes_empty_and_na(spark, tmp_path):
    (tmp_path / "zones.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n"
        '1,EWR,"Newark, Airport",EWR\n'
        "264,Unknown,N/A,\n"
        ",,,\n"
    )
    out = read_csv(spark, str(tmp_path), ZONE_SCHEMA)
    expected = [
        (1, "EWR", "Newark, Airport", "EWR"),
        (264, "Unknown", "N/A", None),
        (None, None, None, None),
    ]
    assert rows(out) == sorted(expected, key=repr)


def test_csv_reads_only_the_columns_in_use(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n1,a,b,c\n")
    out = read_csv(spark, str(tmp_path), ZONE_SCHEMA).select("Zone")
    assert rows(out) == [("b",)]
    assert "ReadSchema: struct<Zone:string>" in plan_text(out)


def test_csv_columns_in_another_order_fail(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Zone,Borough,service_zone\n1,a,b,c\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_csv(spark, str(tmp_path), ZONE_SCHEMA).collect()


def test_csv_reader_options_pass_through(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1;a\n")
    out = read_csv(spark, str(tmp_path), StructType.fromDDL("a int, b string"), header=False, sep=";")
    assert rows(out) == [(1, "a")]


def test_parquet_prunes_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(5).selectExpr("id", "id + 1 AS b", "id + 2 AS c").write.parquet(path)
    out = read_parquet(spark, path).filter("id > 3").select("c")
    assert rows(out) == [(6,)]
    plan = plan_text(out)
    assert "ReadSchema: struct<id:bigint,c:bigint>" in plan
    assert "GreaterThan(id,3)" in plan


def test_parquet_with_given_schema(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1).write.parquet(path)
    out = read_parquet(spark, path, StructType.fromDDL("id bigint, later string"))
    assert rows(out) == [(0, None)]


def test_file_stream_is_unbounded(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "p"))
    assert read_file_stream(spark, str(tmp_path / "p"), StructType.fromDDL("id bigint")).isStreaming


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="[Kk]afka"):
        read_kafka(spark, "broker:9092", "sample", minPartitions=8)


def test_kafka_options(monkeypatch, spark):
    seen = {}
    from millrace.sources import messages

    monkeypatch.setattr(messages, "read_stream", lambda _, source, **o: seen.update(o, source=source))
    messages.read_kafka(spark, "broker:9092", "sample", "earliest", maxOffsetsPerTrigger=10)
    assert seen == {
        "source": "kafka",
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "sample",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": 10,
    }


def test_rest_catalog_settings():
    conf = rest_catalog_conf("lake", "http://host/api", credential="id:secret", s3_endpoint="http://s3")
    assert conf["spark.sql.defaultCatalog"] == "lake"
    assert conf["spark.sql.catalog.lake.uri"] == "http://host/api"
    assert conf["spark.sql.catalog.lake.warehouse"] == "lake"
    assert conf["spark.sql.catalog.lake.credential"] == "id:secret"
    assert conf["spark.sql.catalog.lake.s3.path-style-access"] == "true"
    assert "spark.sql.catalog.lake.s3.region" not in conf
    assert "spark.sql.defaultCatalog" not in rest_catalog_conf("lake", "u", default=False)


def test_object_store_settings():
    conf = object_store_conf("http://s3", access_key="a", secret_key="b", region="r")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://s3"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "a"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.executorEnv.AWS_REGION"] == "r"
    assert not any("key" in k for k in object_store_conf("http://s3"))


def test_scale_settings_grow_with_the_input_but_stay_bounded():
    small, large, huge = (scale_conf(n) for n in (10**9, 10**12, 10**14))
    key = "spark.sql.shuffle.partitions"
    assert int(small[key]) == 200 < int(large[key]) < int(huge[key]) == 50_000
    scan = "spark.sql.files.maxPartitionBytes"
    assert int(small[scan]) == 128 * 1024**2
    assert int(huge[scan]) == 10**9


def test_build_session_takes_settings(spark):
    session = build_session("again", {"spark.sql.session.timeZone": "UTC"})
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_folder_is_the_shared_one(spark):
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_dates_read_back(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.sql("SELECT DATE'2025-01-02' AS d").write.parquet(path)
    assert rows(read_parquet(spark, path)) == [(datetime.date(2025, 1, 2),)]


def test_columns_of_all_files_are_read(spark, tmp_path):
    for k, extra in enumerate([[], ["x"], []] * 2):
        df = spark.range(k, k + 1).withColumns({c: F.lit(1) for c in extra})
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    found = read_parquet(spark, f"{tmp_path}/in")
    assert found.columns == ["id", "x"]
    assert rows(found) == [(0, None), (1, 1), (2, None), (3, None), (4, 1), (5, None)]


def test_a_given_schema_reads_int_and_bigint(spark, tmp_path):
    spark.range(2).selectExpr("CAST(id AS INT) AS id").coalesce(1).write.parquet(f"{tmp_path}/in")
    spark.range(2, 4).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    given = StructType.fromDDL("id bigint")
    assert rows(read_parquet(spark, f"{tmp_path}/in", given)) == [(0,), (1,), (2,), (3,)]
    files = sorted(Path(f"{tmp_path}/in").glob("*.parquet"))
    kept = read_parquet(spark, f"{tmp_path}/in", given, pathGlobFilter=files[0].name)
    assert kept.count() == 2


# --- lines that do not fit --------------------------------------------------------------

ODD_LINES = ["x2,b,c,d", "3,b,c,d,e", "4,b", '5,"b,c,d', "99999999999,b,c,d"]


@pytest.fixture
def odd_zones(tmp_path):
    good = ['1,EWR,"Newark, Airport",EWR', "2,,N/A,", ",,,", '"7",b,c,d']
    for k, lines in enumerate(([good[0], *ODD_LINES[:2]], [*ODD_LINES[2:], *good[1:]])):
        (tmp_path / f"{k}.csv").write_text("\n".join(["LocationID,Borough,Zone,service_zone", *lines, ""]))
    return str(tmp_path)


GOOD_ZONES = [(1, "EWR", "Newark, Airport", "EWR"), (2, None, "N/A", None), (None, None, None, None), (7, "b", "c", "d")]


def test_every_csv_line_is_a_row_or_rejected(spark, odd_zones):
    seen = Observation()
    found = split_csv(spark, odd_zones, ZONE_SCHEMA, metrics=seen)
    assert rows(found.rows) == sorted(GOOD_ZONES, key=repr)
    assert sorted(r.line for r in found.rejected.collect()) == sorted(ODD_LINES)
    assert seen.get == {"rows": 9, "rejected": 5}
    # The same lines, whatever is used of them.
    assert found.rejected.count() == 5 and found.rows.count() == 4
    assert rows(found.rows.select("Zone")) == sorted([(r[2],) for r in GOOD_ZONES], key=repr)


def test_strict_csv_ends_at_a_line_that_does_not_fit(spark, odd_zones, tmp_path):
    for use in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("Zone").collect()):
        with pytest.raises(Exception, match="a CSV line does not fit the schema: "):
            use(read_csv(spark, odd_zones, ZONE_SCHEMA, strict=True))
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n1,a,b,c\n\n2,a,b,\n")
    out = read_csv(spark, str(tmp_path / "good"), ZONE_SCHEMA, strict=True)
    assert rows(out) == [(1, "a", "b", "c"), (2, "a", "b", None)] and out.columns == ZONE_SCHEMA.fieldNames()


def test_split_csv_checks_the_header_and_its_options(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Zone,Borough,service_zone\n1,a,b,c\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        split_csv(spark, str(tmp_path), ZONE_SCHEMA).rows.collect()
    with pytest.raises(ValueError, match="mode"):
        split_csv(spark, str(tmp_path), ZONE_SCHEMA, Mode="DROPMALFORMED")
