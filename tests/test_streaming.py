import datetime
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace import Labels, Role, append_once, enrich, ingest_transactions, parse_transactions, start_append
from millrace.sources import drop_table, ensure_namespace, ensure_table, read_file_stream, renew_passed_files
from millrace.sources.tables import table_location
from workload.queries import QUERIES
from millrace.sources.scratch import scratch_folder
from tests.conftest import plan_text, rows

MESSAGE = StructType().add("value", "binary")


def land(spark, folder, *ids, bad=0):
    texts = [json.dumps({"transaction_id": i, "buyer": {"city": "New York"}}) for i in ids]
    texts += ["not json"] * bad
    df = spark.createDataFrame([(bytearray(t.encode()),) for t in texts], MESSAGE)
    df.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


def ingest(spark, landing, table, tmp_path, **options):
    query = ingest_transactions(
        read_file_stream(spark, landing, MESSAGE),
        table,
        str(tmp_path / "checkpoint"),
        **({"until_caught_up": True} | options),
    )
    if "until_caught_up" not in options:
        query.awaitTermination()
    return query


def ids(spark, table):
    return sorted(r.transaction_id for r in spark.table(table).collect())


def test_stream_equals_batch(spark, landing, tmp_path, namespace):
    land(spark, landing, "a", "b", bad=2)
    land(spark, landing, "c")
    ingest(spark, landing, f"{namespace}.t", tmp_path)
    batch = parse_transactions(spark.read.parquet(landing))
    assert rows(spark.table(f"{namespace}.t")) == rows(batch)
    assert spark.table(f"{namespace}.t").columns == batch.columns


def test_restart_adds_only_new_rows_and_keeps_old_ones(spark, landing, tmp_path, namespace):
    table = f"{namespace}.t"
    land(spark, landing, "a", "b")
    ingest(spark, landing, table, tmp_path)
    ingest(spark, landing, table, tmp_path)
    assert ids(spark, table) == ["a", "b"]
    land(spark, landing, "c")
    ingest(spark, landing, table, tmp_path)
    assert ids(spark, table) == ["a", "b", "c"]


@pytest.mark.parametrize("bound", [{"maxFilesPerTrigger": 2}, {"maxBytesPerTrigger": 1500}])
def test_bounded_batches_deliver_everything(spark, landing, tmp_path, namespace, bound):
    for i in "abcde":
        land(spark, landing, i)
    table = f"{namespace}.t"
    query = ingest_transactions(
        read_file_stream(spark, landing, MESSAGE, **bound),
        table,
        str(tmp_path / "checkpoint"),
        until_caught_up=True,
    )
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    assert ids(spark, table) == list("abcde")


def test_interval_trigger_runs_until_stopped(spark, landing, tmp_path, namespace):
    table = f"{namespace}.t"
    land(spark, landing, "a")
    query = ingest(spark, landing, table, tmp_path, until_caught_up=False, every="1 second")
    try:
        query.processAllAvailable()
        land(spark, landing, "b")
        query.processAllAvailable()
        assert query.isActive
        assert ids(spark, table) == ["a", "b"]
    finally:
        query.stop()


def test_a_stream_reports_dropped_messages(spark, landing, tmp_path, namespace):
    land(spark, landing, "a", "b", bad=3)
    query = ingest(spark, landing, f"{namespace}.t", tmp_path, metrics="messages")
    seen = [p["observedMetrics"]["messages"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(s["rows"] for s in seen) == 5
    assert sum(s["missing"] for s in seen) == 3


def test_append_of_any_stream_creates_its_table(spark, tmp_path, namespace):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    stream = read_file_stream(spark, source, StructType.fromDDL("id bigint"))
    query = start_append(
        stream.withColumn("twice", F.col("id") * 2),
        f"{namespace}.t",
        str(tmp_path / "checkpoint"),
        until_caught_up=True,
        name="doubling",
    )
    query.awaitTermination()
    assert query.name == "doubling"
    assert rows(spark.table(f"{namespace}.t")) == [(i, 2 * i) for i in range(5)]


def test_a_fresh_table_needs_a_fresh_checkpoint(spark, landing, tmp_path, namespace):
    """Why ingestion never drops its table: old rows are not delivered again."""
    table = f"{namespace}.t"
    land(spark, landing, "a")
    ingest(spark, landing, table, tmp_path)
    drop_table(spark, table)
    query = ingest_transactions(
        read_file_stream(spark, landing, MESSAGE),
        table,
        str(tmp_path / "other-checkpoint"),
        until_caught_up=True,
    )
    query.awaitTermination()
    assert ids(spark, table) == ["a"]


def test_stream_plan_has_no_shuffle_and_no_state(spark, landing):
    land(spark, landing, "a")
    plan = plan_text(parse_transactions(read_file_stream(spark, landing, MESSAGE)))
    assert "Exchange" not in plan and "StateStore" not in plan


def test_crashed_run_continues_without_loss_or_repeats(spark, landing, tmp_path, namespace):
    """One file per batch; the third is unreadable at first and delivered after the restart."""
    table = f"{namespace}.t"
    for i in "abcd":
        land(spark, landing, i)

    def run(condition):
        stream = parse_transactions(
            read_file_stream(spark, landing, MESSAGE, maxFilesPerTrigger=1)
        ).withColumn("buyer_city", F.when(condition, F.raise_error(F.lit("boom"))).otherwise("x"))
        start_append(
            stream, table, str(tmp_path / "checkpoint"), until_caught_up=True
        ).awaitTermination()

    with pytest.raises(Exception, match="boom"):
        run(F.col("transaction_id") == "c")
    assert "c" not in ids(spark, table)
    run(F.lit(False))
    assert ids(spark, table) == list("abcd")


def test_arrays_are_exploded_on_a_stream(spark, landing, tmp_path, namespace):
    schema = StructType.fromDDL("transaction_id string, items array<struct<n: int>>")
    text = '{"transaction_id": "a", "items": [{"n": 1}, {"n": 2}]}'
    values = [(bytearray(text.encode()),), (bytearray(b'{"transaction_id": "b"}'),)]
    spark.createDataFrame(values, MESSAGE).write.parquet(landing)
    ingest(spark, landing, f"{namespace}.t", tmp_path, schema=schema)
    assert rows(spark.table(f"{namespace}.t")) == sorted([("a", 1), ("a", 2), ("b", None)], key=repr)


def test_files_per_batch(spark, landing, tmp_path):
    folder = scratch_folder(spark)
    namespace = f"files_{folder.rsplit('/', 1)[1]}"
    ensure_namespace(spark, namespace, folder)
    for i in "abcdef":
        land(spark, landing, i)
    ingest(spark, landing, f"{namespace}.many", tmp_path)
    assert len(glob.glob(f"{folder}/many/*.parquet")) > 1
    ingest(spark, landing, f"{namespace}.one", tmp_path / "other", files_per_batch=1)
    assert len(glob.glob(f"{folder}/one/*.parquet")) == 1
    assert ids(spark, f"{namespace}.one") == ids(spark, f"{namespace}.many") == list("abcdef")


def test_enrichment_of_a_stream_equals_batch(spark, tmp_path, namespace):
    """A stream may be enriched with the same function, against a static dimension."""
    source = str(tmp_path / "in")
    facts = spark.range(20).selectExpr(
        "id", "id % 3 AS code", "id % 4 AS place", "TIMESTAMP'2025-01-01' AS t"
    )
    facts.write.parquet(source)
    places = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "key int, name string")

    def enriched(df):
        return enrich(
            df,
            places,
            dimension_key="key",
            roles=[Role("place", {"name": "place_name"}), Role("id", {"name": "id_name"})],
            labels=[Labels("code", "label", {0: "zero", 1: "one"})],
            event_time="t",
        )

    stream = read_file_stream(spark, source, facts.schema)
    start_append(
        enriched(stream), f"{namespace}.t", str(tmp_path / "checkpoint"), until_caught_up=True
    ).awaitTermination()
    assert rows(spark.table(f"{namespace}.t")) == rows(enriched(facts))


# --- a streamed file table never loses rows ---------------------------------------------


def append(spark, source, table, checkpoint, schema="id bigint"):
    stream = read_file_stream(spark, str(source), StructType.fromDDL(schema))
    start_append(stream, table, str(checkpoint), until_caught_up=True).awaitTermination()


def test_a_table_with_rows_of_its_own_is_refused(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    spark.range(10).write.saveAsTable(table)
    spark.range(5).write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="holds rows"):
        append(spark, tmp_path / "in", table, tmp_path / "checkpoint")
    assert spark.table(table).count() == 10


def test_a_second_checkpoint_is_refused(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    spark.range(5).write.parquet(str(tmp_path / "a"))
    spark.range(7).write.parquet(str(tmp_path / "b"))
    append(spark, tmp_path / "a", table, tmp_path / "first")
    with pytest.raises(ValueError, match="is fed under checkpoint"):
        append(spark, tmp_path / "b", table, tmp_path / "second")
    append(spark, tmp_path / "a", table, tmp_path / "first")
    assert spark.table(table).count() == 5


def test_a_lost_checkpoint_is_refused(spark, tmp_path, namespace):
    """Its batches would be numbered from 0 again, and skipped."""
    table = f"{namespace}.t"
    spark.range(5).write.parquet(str(tmp_path / "in"))
    append(spark, tmp_path / "in", table, tmp_path / "checkpoint")
    (tmp_path / "checkpoint").rename(tmp_path / "elsewhere")
    with pytest.raises(ValueError, match="whose checkpoint is not in"):
        append(spark, tmp_path / "in", table, tmp_path / "checkpoint")


def test_rows_of_a_batch_job_between_two_runs_are_noticed(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    spark.range(5).write.parquet(str(tmp_path / "in"))
    append(spark, tmp_path / "in", table, tmp_path / "checkpoint")
    spark.range(4).write.insertInto(table)
    with pytest.raises(ValueError, match="a batch job wrote rows"):
        append(spark, tmp_path / "in", table, tmp_path / "checkpoint")


def test_a_stream_of_another_schema_is_refused(spark, tmp_path, namespace):
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "in"))
    spark.sql(f"CREATE TABLE {namespace}.narrow (id BIGINT) USING parquet")
    spark.sql(f"CREATE TABLE {namespace}.text (id STRING, x INT) USING parquet")
    for name in ("narrow", "text"):
        with pytest.raises(ValueError, match="another schema"):
            append(spark, tmp_path / "in", f"{namespace}.{name}", tmp_path / name, "id bigint, x int")


def test_late_old_files_are_read(spark, tmp_path, namespace):
    source, table = tmp_path / "in", f"{namespace}.t"
    spark.range(5).coalesce(1).write.parquet(str(source))
    append(spark, source, table, tmp_path / "checkpoint")
    spark.range(5, 10).coalesce(1).write.parquet(str(tmp_path / "late"))
    (late,) = glob.glob(f"{tmp_path}/late/*.parquet")
    os.utime(late, (time.time() - 10 * 86400,) * 2)
    os.rename(late, source / "late.parquet")
    append(spark, source, table, tmp_path / "checkpoint")
    assert rows(spark.table(table)) == [(i,) for i in range(10)]


def test_ingestion_of_messages_without_the_usual_id(spark, tmp_path, namespace):
    """Key inside a struct, another column, blanks kept, a named query; missing keys are counted."""
    source, table = str(tmp_path / "in"), f"{namespace}.t"
    texts = ['{"buyer": {"buyer_id": 1, "city": "New York"}}', '{"buyer": {"city": "x"}}', "no"]
    spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "body binary").write.parquet(source)
    query = ingest_transactions(
        read_file_stream(spark, source, StructType.fromDDL("body binary")),
        table,
        str(tmp_path / "checkpoint"),
        StructType.fromDDL("buyer struct<buyer_id: bigint, city: string>"),
        value="body",
        required="buyer_buyer_id",
        strip=False,
        name="buyers",
        metrics="m",
        until_caught_up=True,
    )
    query.awaitTermination()
    assert query.name == "buyers" and rows(spark.table(table)) == [(1, "New York")]
    seen = [p["observedMetrics"]["m"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(s["rows"] for s in seen) == 3 and sum(s["missing"] for s in seen) == 2


def test_transaction_queries_agree_on_null_statuses(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    status = F.when(F.col("o_orderkey") % 10 == 0, None).otherwise(F.col("o_orderstatus"))
    orders.withColumn("o_orderstatus", status).write.parquet(f"{tmp_path}/orders.parquet")
    names = ("from_json_nested", "stream_transactions", "stream_restart")
    found = [rows(QUERIES[name](spark, str(tmp_path))) for name in names]
    assert found[0] == found[1] == found[2] and any(r[4] is None for r in found[0])


# --- several writers, rejected messages -------------------------------------------------


def forget_last_commit(checkpoint, number):
    """As after a crash between the delivery of a batch and its entry in the checkpoint."""
    (checkpoint / "commits" / str(number)).unlink()
    (checkpoint / "commits" / f".{number}.crc").unlink(missing_ok=True)


def shared_stream(spark, source, table, checkpoint, schema="id bigint", **options):
    stream = read_file_stream(spark, str(source), StructType.fromDDL(schema), **options)
    query = start_append(stream, table, str(checkpoint), until_caught_up=True, shared=True)
    query.awaitTermination()
    return query


def test_two_streams_and_batches_share_a_table(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    for name, start in (("a", 0), ("b", 100)):
        spark.range(start, start + 10).repartition(3).write.parquet(str(tmp_path / name))
    for _ in range(2):
        for name in "ab":
            # The same folder in another spelling is the same checkpoint.
            shared_stream(spark, tmp_path / name, table, f"{tmp_path}//c{name}/", maxFilesPerTrigger=1)
    spark.range(200, 210).write.insertInto(table)
    for _ in range(2):
        append_once(spark.range(300, 310), table, "nightly", 7)
    assert append_once(spark.range(0), table, "nightly", 8) == 0
    spark.range(10, 15).write.mode("append").parquet(str(tmp_path / "a"))
    shared_stream(spark, tmp_path / "a", table, tmp_path / "ca")
    expected = [*range(15), *range(100, 110), *range(200, 210), *range(300, 310)]
    assert rows(spark.table(table)) == sorted(((i,) for i in expected), key=repr)


def test_a_batch_run_twice_adds_none(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "in"))
    query = shared_stream(spark, tmp_path / "in", table, tmp_path / "c", maxFilesPerTrigger=1)
    forget_last_commit(tmp_path / "c", 1)
    again = shared_stream(spark, tmp_path / "in", table, tmp_path / "c", maxFilesPerTrigger=1)
    assert again.id == query.id
    assert rows(spark.table(table)) == [(i,) for i in range(10)]


def test_a_batch_that_dies_is_not_seen_and_delivered_later(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    ensure_table(spark, table, StructType.fromDDL("id bigint"), shared=True)
    broken = spark.range(0, 100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("bigint").alias("id")
    )
    with pytest.raises(Exception, match="boom"):
        append_once(broken, table, "w", 1)
    assert spark.table(table).count() == 0
    assert append_once(spark.range(100), table, "w", 1) == 100
    assert spark.table(table).count() == 100


def test_shared_and_single_streams_do_not_mix(spark, tmp_path, namespace):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    append(spark, tmp_path / "in", f"{namespace}.single", tmp_path / "c1")
    with pytest.raises(ValueError, match="not created for several writers"):
        shared_stream(spark, tmp_path / "in", f"{namespace}.single", tmp_path / "c2")
    shared_stream(spark, tmp_path / "in", f"{namespace}.shared", tmp_path / "c3")
    with pytest.raises(ValueError, match="several writers"):
        append(spark, tmp_path / "in", f"{namespace}.shared", tmp_path / "c4")
    with pytest.raises(ValueError, match="cannot be shared"):
        ensure_table(spark, f"{namespace}.p", StructType.fromDDL("id bigint, d int"), partition_by=["d"], shared=True)
    with pytest.raises(ValueError, match="no writer options"):
        start_append(spark.readStream.format("rate").load(), f"{namespace}.x", str(tmp_path / "c5"), shared=True, compression="zstd")


def test_another_spelling_of_the_checkpoint_is_accepted(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    spark.range(5).write.parquet(str(tmp_path / "in"))
    append(spark, tmp_path / "in", table, tmp_path / "c")
    spark.range(5, 8).write.mode("append").parquet(str(tmp_path / "in"))
    append(spark, tmp_path / "in", table, f"file:{tmp_path}//c/")
    assert spark.table(table).count() == 8


def test_the_way_back_after_a_stray_insert(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    spark.range(5).write.parquet(str(tmp_path / "in"))
    append(spark, tmp_path / "in", table, tmp_path / "c")
    before = set(glob.glob(f"{table_location(spark, table).removeprefix('file:')}/*.parquet"))
    spark.range(90, 94).coalesce(1).write.insertInto(table)
    with pytest.raises(ValueError, match="a batch job wrote rows into .* in 1 files") as refused:
        append(spark, tmp_path / "in", table, tmp_path / "c")
    (stray,) = set(glob.glob(f"{table_location(spark, table).removeprefix('file:')}/*.parquet")) - before
    assert stray.rsplit("/", 1)[1] in str(refused.value)
    assert rows(spark.read.parquet(stray)) == [(i,) for i in range(90, 94)]
    os.remove(stray)
    append(spark, tmp_path / "in", table, tmp_path / "c")
    assert spark.table(table).count() == 5


def test_rejected_messages_are_kept_byte_for_byte(spark, landing, tmp_path, namespace):
    good, bad = f"{namespace}.good", f"{namespace}.bad"
    odd = [b"\xff\xfe not text", b"", None, b'{"transaction_id": null}', b'{"buyer": {"city": "x"}', b"[1, 2]"]
    land(spark, landing, "a", "b")
    spark.createDataFrame([(x and bytearray(x) if x is not None else None,) for x in odd], MESSAGE).write.mode("append").parquet(landing)

    def run():
        query = ingest(spark, landing, good, tmp_path, rejects=bad, until_caught_up=True)
        query.awaitTermination()

    run()
    land(spark, landing, "c", bad=1)
    run()
    forget_last_commit(tmp_path / "checkpoint", 1)
    run()
    assert ids(spark, good) == ["a", "b", "c"]
    found = [r.value if r.value is None else bytes(r.value) for r in spark.table(bad).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, [*odd, b"not json"]))
    # Both tables take other rows too.
    land(spark, f"{landing}-2", "d", bad=2)
    ingest_transactions(
        read_file_stream(spark, f"{landing}-2", MESSAGE), good, str(tmp_path / "second"), rejects=bad, until_caught_up=True
    ).awaitTermination()
    assert ids(spark, good) == ["a", "b", "c", "d"] and spark.table(bad).count() == len(odd) + 3


def test_columns_are_added_only_when_asked(spark, tmp_path, namespace):
    table = f"{namespace}.t"
    ensure_table(spark, table, StructType.fromDDL("id bigint"), shared=True)
    append_once(spark.range(2), table, "old", 1)
    wider = StructType.fromDDL("id bigint, x struct<a: int> not null, `y z` string")
    with pytest.raises(ValueError, match="another schema: x, y z differ"):
        ensure_table(spark, table, wider, shared=True)
    ensure_table(spark, table, wider, shared=True, add_columns=True)
    ensure_table(spark, table, wider, shared=True)
    append_once(spark.sql("SELECT 5L AS id, named_struct('a', 1) AS x, 'q' AS `y z`"), table, "new", 1)
    assert [(r[0], r[1] and tuple(r[1]), r[2]) for r in spark.table(table).orderBy("id").collect()] == [(0, None, None), (1, None, None), (5, (1,), "q")]
    for other in ("id int, x struct<a: int>, `y z` string", "x struct<a: int>, `y z` string, w int"):
        with pytest.raises(ValueError, match="id differ"):
            ensure_table(spark, table, StructType.fromDDL(other), add_columns=True)


def _land(spark, folder, number, changed):
    """One file with one row, last changed at ``changed`` seconds since 1970."""
    aside = folder.parent / f"aside{number}"
    spark.range(number, number + 1).coalesce(1).write.parquet(str(aside))
    folder.mkdir(exist_ok=True)
    target = folder / f"{number}.parquet"
    next(aside.glob("part-*.parquet")).rename(target)
    os.utime(target, (changed, changed))


def _taken(spark, folder, checkpoint, starting):
    """Ids that a run takes until it has caught up."""
    ids = []
    rows = read_file_stream(
        spark, str(folder), spark.range(1).schema, starting=starting, checkpoint=str(checkpoint)
    )
    query = (
        rows.writeStream.foreachBatch(lambda batch, _: ids.extend(r["id"] for r in batch.collect()))
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(ids)


def test_a_file_stream_starts_where_it_is_told_once(spark, tmp_path):
    folder, now = tmp_path / "landed", time.time()
    for number, age in ((1, 5000), (2, 3000), (3, 1000)):
        _land(spark, folder, number, now - age)
    assert _taken(spark, folder, tmp_path / "latest", "latest") == []
    assert _taken(spark, folder, tmp_path / "time", datetime.datetime.fromtimestamp(now - 4000)) == [2, 3]
    assert _taken(spark, folder, tmp_path / "earliest", "earliest") == [1, 2, 3]
    _land(spark, folder, 4, time.time() + 1)
    # Started again: the setting of the first start holds.
    assert _taken(spark, folder, tmp_path / "latest", "earliest") == [4]
    assert _taken(spark, folder, tmp_path / "time", "latest") == [4]
    assert _taken(spark, folder, tmp_path / "earliest", "latest") == [4]


def test_a_start_needs_a_checkpoint_and_a_known_name(spark, tmp_path):
    schema = spark.range(1).schema
    (tmp_path / "landed").mkdir()
    for options in ({"starting": "latest"}, {"checkpoint": "c"}, {"starting": "soon", "checkpoint": str(tmp_path / "c")}):
        with pytest.raises(ValueError):
            read_file_stream(spark, str(tmp_path / "landed"), schema, **options)


def _take_and_clear(spark, folder, checkpoint, finished):
    """Ids that a run takes, and how many paths its source remembers at the end."""
    ids = []
    rows = read_file_stream(
        spark, str(folder), spark.range(1).schema, finished=finished, max_file_age="1h", cleanSourceThreads="0"
    )
    query = (
        rows.writeStream.foreachBatch(lambda batch, _: ids.extend(r["id"] for r in batch.collect()))
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(ids), query._jsq.streamingQuery().sources().head().seenFiles().size()


@pytest.mark.parametrize("archive", [False, True])
def test_finished_files_go_and_are_forgotten(spark, tmp_path, archive):
    folder, checkpoint = tmp_path / "landed files+", tmp_path / "checkpoint"
    finished = str(tmp_path / "kept" / "archive") if archive else "delete"
    start = int(time.time()) - 100 * 3600
    taken = []
    for number in range(12):
        # Each file looks two hours younger than the one before.
        _land(spark, folder, number, start + 7200 * number)
        ids, remembered = _take_and_clear(spark, folder, checkpoint, finished)
        taken += ids
        assert remembered <= 2
        assert len(list(folder.glob("*.parquet"))) <= 1
    assert taken == list(range(12))
    if archive:
        assert len(list((tmp_path / "kept").rglob("*.parquet"))) == 11
    # A file that looks too old is passed over, until it is renewed; what was taken is not.
    _land(spark, folder, 50, start)
    assert _take_and_clear(spark, folder, checkpoint, finished)[0] == []
    assert renew_passed_files(spark, str(folder), str(checkpoint)) == 1
    assert renew_passed_files(spark, str(folder), str(checkpoint)) == 0
    assert _take_and_clear(spark, folder, checkpoint, finished)[0] == [50]
    assert _take_and_clear(spark, folder, checkpoint, finished)[0] == []


def test_nothing_is_renewed_before_a_first_run(spark, tmp_path):
    folder = tmp_path / "landed"
    _land(spark, folder, 1, time.time() - 5000)
    assert renew_passed_files(spark, str(folder), str(tmp_path / "checkpoint")) == 0
