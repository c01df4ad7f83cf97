"""Every operator on the test tables, each over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace import (
    TRANSACTION_SCHEMA,
    Labels,
    Role,
    append_once,
    broadcast_within,
    bytes_to_text,
    count_rows,
    drop_missing,
    enrich,
    explode_arrays,
    flatten,
    ingest_transactions,
    join_dimension,
    label_codes,
    lookup,
    parse_json,
    parse_transactions,
    start_append,
    strip_whitespace,
    unique_keys,
)
from millrace.naming import literal
from millrace.sources import (
    current_namespace,
    drop_table,
    ensure_namespace,
    ensure_table,
    list_namespaces,
    list_tables,
    read_csv,
    read_file_stream,
    read_parquet,
    replace_partitions,
    replace_table,
    split_csv,
)
from millrace.sources.scratch import scratch_folder, scratch_namespace

# 5 and 7 occur in the data but not here, so that unknown codes are met.
LINE_LABELS = {1: "first", 2: "second", 3: "third", 4: "fourth", 6: "sixth"}
RETURN_LABELS = {"R": "Returned", "A": "Accepted"}
EVENT_LABELS = {"view": "browse", "click": "browse", "purchase": "buy"}

PROPS_SCHEMA = StructType([StructField("k", LongType())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", merge_schema=False)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a file stream; the glob lets it be one file or a directory of files.

    A batch takes at most a terabyte, so that a failed one repeats no more than that.
    """
    schema = table(spark, sf_dir, name).schema
    path = f"{sf_dir}/{{{name}}}.parquet"
    return read_file_stream(spark, path, schema, maxBytesPerTrigger=10**12)


# --- derived inputs ---------------------------------------------------------------------


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the nation they leave from (supplier) and go to (customer)."""
    buyers = join_dimension(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        table(spark, sf_dir, "customer"),
        fact_key="o_custkey",
        dimension_key="c_custkey",
        columns={"c_nationkey": "to_nationkey"},
    )
    from_supplier = join_dimension(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "supplier"),
        fact_key="l_suppkey",
        dimension_key="s_suppkey",
        columns={"s_nationkey": "from_nationkey"},
    )
    return join_dimension(
        from_supplier,
        buyers,
        fact_key="l_orderkey",
        dimension_key="o_orderkey",
        columns={"to_nationkey": "to_nationkey"},
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with the name of their region: the small table joined in two roles."""
    named = join_dimension(
        table(spark, sf_dir, "nation"),
        table(spark, sf_dir, "region"),
        fact_key="n_regionkey",
        dimension_key="r_regionkey",
        columns={"r_name": "r_name"},
    )
    return broadcast_within(named.select("n_nationkey", "n_name", "r_name"))


def place_roles() -> list[Role]:
    return [
        Role("from_nationkey", {"n_name": "from_nation", "r_name": "from_region"}),
        Role("to_nationkey", {"n_name": "to_nation", "r_name": "to_region"}),
    ]


def enriched_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(
        shipments(spark, sf_dir),
        places(spark, sf_dir),
        dimension_key="n_nationkey",
        roles=place_roles(),
        labels=[
            Labels("l_linenumber", "line_label", LINE_LABELS),
            Labels("l_returnflag", "return_label", RETURN_LABELS),
        ],
        event_time="l_shipdate",
        date_column="cobdate",
    )


def transaction_messages(orders: DataFrame) -> DataFrame:
    """Orders as binary JSON messages; medium-priority ones lack an id, pending ones are cut off."""
    record = F.struct(
        F.when(
            F.col("o_orderpriority") != "3-MEDIUM",
            F.concat(F.lit("tx "), F.col("o_orderkey").cast("string")),
        ).alias("transaction_id"),
        F.struct(
            F.col("o_custkey").alias("buyer_id"),
            F.col("o_orderpriority").alias("city"),
            F.concat(F.lit("Buyer no "), F.col("o_custkey").cast("string")).alias("name"),
        ).alias("buyer"),
        F.struct(
            F.concat(F.lit("desk\t"), F.col("o_orderstatus")).alias("platform"),
            (F.col("o_orderkey") + F.col("o_custkey")).alias("seller_id"),
        ).alias("seller"),
        F.struct(
            F.col("o_totalprice").alias("amount"),
            F.lit("USD").alias("currency"),
            F.col("o_orderstatus").alias("merchant"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("transaction_time"),
        ).alias("transaction_details"),
    )
    # Two projections: each record is written as text once, whatever uses the text.
    texts = orders.select("o_orderstatus", F.to_json(record).alias("text"))
    cut_off = F.substring("text", F.lit(1), F.length("text") - 1)
    sent = F.when(F.col("o_orderstatus") == "P", cut_off).otherwise(F.col("text"))
    return texts.select(sent.cast("binary").alias("value"))


def words(text: Column) -> Column:
    """Lines of a text, each an array of its words."""
    return F.transform(F.split(text, "\n"), lambda line: F.split(line, " "))


# --- scans ------------------------------------------------------------------------------


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def scan_parquet_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two vintages: the older ones, of returned or unknown items, lack the tax."""
    lines = table(spark, sf_dir, "lineitem")
    old = F.coalesce(F.col("l_returnflag") == "R", F.lit(True))
    folder = scratch_folder(spark)
    lines.filter(old).drop("l_tax").write.mode("append").parquet(folder)
    lines.filter(~old).write.mode("append").parquet(folder)
    return read_parquet(spark, folder)


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    folder = scratch_folder(spark)
    customers.write.option("header", True).csv(folder)
    return read_csv(spark, folder, customers.schema)


def scan_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines of text, of which those of two nations do not fit; nothing is lost."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    line = (
        F.when(F.col("c_nationkey") == 3, F.concat(F.lit("no "), key, F.lit(","), nation))
        .when(F.col("c_nationkey") == 7, F.concat_ws(",", key, nation, F.lit("more")))
        .otherwise(F.concat(key, F.lit(","), F.coalesce(nation, F.lit(""))))
    )
    folder = scratch_folder(spark)
    customers.select(line.alias("value")).write.text(folder)
    found = split_csv(spark, folder, customers.schema, header=False)
    rows = found.rows.withColumn("line", F.lit(None).cast("string"))
    return rows.unionByName(found.rejected, allowMissingColumns=True)


def table_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark)
    spark.sql(
        f"CREATE TABLE {namespace}.orders USING parquet LOCATION '{literal(sf_dir)}/orders.parquet'"
    )
    return spark.sql(f"SELECT count(*) AS n FROM spark_catalog.{namespace}.orders")


def table_scan_current_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark)
    spark.sql(
        f"CREATE TABLE {namespace}.customer USING parquet LOCATION '{literal(sf_dir)}/customer.parquet'"
    )
    with current_namespace(spark, namespace):
        return spark.sql("SELECT * FROM customer")


# --- tables -----------------------------------------------------------------------------


def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, list, fill, create again without loss, and drop; the rows left in the table."""
    namespace = scratch_namespace(spark)
    ensure_namespace(spark, namespace)
    rows = parse_transactions(transaction_messages(table(spark, sf_dir, "orders")))
    ledger, dropped = f"{namespace}.ledger", f"{namespace}.dropped"
    for name in (ledger, dropped):
        ensure_table(spark, name, rows.schema)
    rows.write.insertInto(ledger)
    ensure_table(spark, ledger, rows.schema)
    drop_table(spark, dropped)
    drop_table(spark, dropped)
    tables = ",".join(sorted(row.tableName for row in list_tables(spark, namespace).collect()))
    found = list_namespaces(spark).filter(F.col("namespace") == namespace).count()
    return spark.table(ledger).withColumns(
        {"listed_tables": F.lit(tables), "listed_namespaces": F.lit(found)}
    )


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("cobdate", F.to_date("ts"))


def events_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_namespace(spark)}.events_by_date"
    replace_table(dated_events(spark, sf_dir), name, partition_by="cobdate")
    return spark.table(name)


def partitioned_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a table by one with another content, layout and partitioning; the second stays."""
    name = f"{scratch_namespace(spark)}.replaced"
    replace_table(table(spark, sf_dir, "events").select("event_type", "user_id"), name)
    replace_table(dated_events(spark, sf_dir), name, partition_by="cobdate")
    return spark.table(name)


def replace_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count observed during a write beside the count of the written table."""
    name = f"{scratch_namespace(spark)}.counted"
    written = replace_table(dated_events(spark, sf_dir), name, partition_by="cobdate")
    return count_rows(spark.table(name), "n_table").withColumn("n_written", F.lit(written).cast("bigint"))


def partition_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates are loaded, later ones follow, then the first are loaded again with what they should hold."""
    name = f"{scratch_namespace(spark)}.reloaded"
    events = dated_events(spark, sf_dir)
    early = F.coalesce(F.col("cobdate") < F.lit("2024-01-11").cast("date"), F.lit(True))
    replace_table(events.filter(early).withColumn("event_type", F.lit("old")), name, partition_by="cobdate")
    replace_partitions(events.filter(~early), name)
    replace_partitions(events.filter(early), name)
    return spark.table(name)


def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_by_date(spark, sf_dir).filter(F.col("cobdate") >= F.lit("2024-01-11").cast("date"))


# --- projections, filters, scalar functions ---------------------------------------------


def enrich_int_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = lookup(LINE_LABELS, F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", label.alias("line_label")
    )


def enrich_many_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of all even days since 1992, too long for a CASE expression."""
    days = {d: f"day {d}" for d in range(0, 4000, 2)} | {None: "no date"}
    day = F.datediff("l_shipdate", F.lit("1992-01-01").cast("date")).alias("day")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", day)
    return label_codes(lines, "day", days, "day_label", default="odd day")


def enrich_string_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        lookup(RETURN_LABELS, flag).alias("return_label"),
        lookup(RETURN_LABELS, flag, default="unknown").alias("return_label_or_default"),
    )


def to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("cobdate"))


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other letter case and unknown names are accepted."""
    return table(spark, sf_dir, "orders").drop("O_ORDERSTATUS", "o_OrderPriority", "no_such_column")


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = lookup(EVENT_LABELS, F.col("event_type"))
    labelled = table(spark, sf_dir, "events").select("event_id", label.alias("label"))
    return drop_missing(labelled, "label")


def strip_whitespace_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", strip_whitespace(F.col("text")).alias("stripped")
    )


def cast_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("value")
    )
    return payloads.select("doc_id", bytes_to_text(F.col("value")).alias("text"))


def count_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(table(spark, sf_dir, "lineitem"))


# --- JSON and nested data ---------------------------------------------------------------


def struct_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", PROPS_SCHEMA).alias("parsed")
    )
    return parsed.select("event_id", "parsed.*")


def from_json_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_json(
        table(spark, sf_dir, "events"), "props", PROPS_SCHEMA, keep=("event_id", "event_type")
    )


def from_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_transactions(transaction_messages(table(spark, sf_dir, "orders")))


def flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs three levels deep; customers are null where the order is still open."""
    customers = join_dimension(
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "nation"),
        fact_key="c_nationkey",
        dimension_key="n_nationkey",
        columns={"n_name": "nation", "n_regionkey": "region"},
    ).select(
        "c_custkey",
        F.struct(
            "c_name",
            "c_acctbal",
            F.struct("nation", "region").alias("home"),
        ).alias("customer"),
    )
    orders = join_dimension(
        table(spark, sf_dir, "orders"),
        customers,
        fact_key="o_custkey",
        dimension_key="c_custkey",
        columns={"customer": "customer"},
    )
    nested = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "O", F.col("customer")).alias("buyer"),
        F.struct("o_totalprice", F.struct("o_orderpriority").alias("urgency")).alias("terms"),
        "o_orderstatus",
    )
    return flatten(nested)


def explode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in each document: null where it has no label, empty where it has no number."""
    labelled = join_dimension(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        fact_key="doc_id",
        dimension_key="doc_id",
        columns={"quality": "quality"},
    )
    numbers = F.when(
        F.col("quality").isNotNull(), F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1))
    )
    return labelled.select("doc_id", "quality", numbers.alias("number")).select(
        "doc_id", "quality", F.explode_outer("number").alias("number")
    )


def explode_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every turn (an array of arrays in a struct) times its two tags."""
    nested = table(spark, sf_dir, "conversations").select(
        "conv_id",
        F.struct("turn", words(F.col("text")).alias("word")).alias("message"),
        F.array(
            F.struct(F.lit("role").alias("kind"), F.col("role").alias("value")),
            F.struct(F.lit("turn").alias("kind"), F.col("turn").cast("string").alias("value")),
        ).alias("tag"),
    )
    return explode_arrays(nested)


def explode_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_arrays(table(spark, sf_dir, "embeddings"))


# --- joins ------------------------------------------------------------------------------


def left_join_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their labels, which most documents lack; both tables grow with the data."""
    return join_dimension(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "source"),
        table(spark, sf_dir, "labels"),
        fact_key="doc_id",
        dimension_key="doc_id",
        columns={"quality": "quality", "toxic": "toxic"},
    )


def role_playing_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = shipments(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "from_nationkey", "to_nationkey"
    )
    nations = places(spark, sf_dir)
    for role in place_roles():
        result = join_dimension(
            result,
            nations,
            fact_key=role.fact_key,
            dimension_key="n_nationkey",
            columns=role.columns,
        )
    return result


def left_join_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their labels; a document labelled twice would end the job."""
    return join_dimension(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "source"),
        table(spark, sf_dir, "labels"),
        fact_key="doc_id",
        dimension_key="doc_id",
        columns={"quality": "quality", "toxic": "toxic"},
        unique=True,
    )


def left_join_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and the newest event of the user with their number; most users have many."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return join_dimension(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
        unique_keys(events, "user_id", newest_by="ts"),
        fact_key="s_suppkey",
        dimension_key="user_id",
        columns={"ts": "last_ts", "event_id": "last_event"},
    )


# --- complete jobs ----------------------------------------------------------------------


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_shipments(spark, sf_dir)


def batch_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shipments enriched, written by date, and read back."""
    name = f"{scratch_namespace(spark)}.shipments"
    result = enriched_shipments(spark, sf_dir)
    replace_table(result, name, partition_by="cobdate")
    return spark.table(name).select(*result.columns)


def batch_enrichment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job on events; many users are no supplier, so their role stays null."""
    facts = parse_json(
        table(spark, sf_dir, "events"),
        "props",
        PROPS_SCHEMA,
        keep=("event_id", "ts", "user_id", "event_type", "value"),
    )
    result = enrich(
        facts,
        table(spark, sf_dir, "supplier"),
        dimension_key="s_suppkey",
        roles=[
            Role("user_id", {"s_name": "user_name", "s_nationkey": "user_nationkey"}),
            Role("k", {"s_name": "partner_name", "s_nationkey": "partner_nationkey"}),
        ],
        labels=[Labels("event_type", "event_label", EVENT_LABELS)],
        event_time="ts",
        date_column="cobdate",
    )
    name = f"{scratch_namespace(spark)}.events"
    replace_table(result, name, partition_by="cobdate")
    return spark.table(name).select(*result.columns)


# --- streams ----------------------------------------------------------------------------


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, name = scratch_folder(spark), f"{scratch_namespace(spark)}.appended"
    start_append(
        table_stream(spark, sf_dir, "events"), name, folder, until_caught_up=True
    ).awaitTermination()
    return spark.table(name)


def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a fixed interval: runs until the source is drained, then stops."""
    folder, name = scratch_folder(spark), f"{scratch_namespace(spark)}.appended"
    query = start_append(table_stream(spark, sf_dir, "events"), name, folder, every="6 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.table(name)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More messages land between two runs that share a checkpoint; each arrives once."""
    folder, name = scratch_folder(spark), f"{scratch_namespace(spark)}.restarted"
    orders = table(spark, sf_dir, "orders")
    # An order without a status is not finished.
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    for part in (orders.filter(finished), orders.filter(~finished)):
        transaction_messages(part).write.mode("append").parquet(f"{folder}/landing")
        landed = StructType.fromDDL("value binary")
        ingest_transactions(
            read_file_stream(spark, f"{folder}/landing", landed, maxBytesPerTrigger=10**12),
            name,
            f"{folder}/checkpoint",
            until_caught_up=True,
        ).awaitTermination()
    return spark.table(name)


def stream_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished and open orders land in turn; files are moved away once taken, and each arrives once."""
    folder, name = scratch_folder(spark), f"{scratch_namespace(spark)}.archived"
    orders = table(spark, sf_dir, "orders")
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    for part in (orders.filter(finished), orders.filter(~finished)):
        transaction_messages(part).write.mode("append").parquet(f"{folder}/landing")
        landed = StructType.fromDDL("value binary")
        ingest_transactions(
            read_file_stream(
                spark, f"{folder}/landing", landed, finished=f"{folder}/archive", maxBytesPerTrigger=10**12
            ),
            name,
            f"{folder}/checkpoint",
            until_caught_up=True,
        ).awaitTermination()
    return spark.table(name)


def stream_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, name = scratch_folder(spark), f"{scratch_namespace(spark)}.transactions"
    ingest_transactions(
        transaction_messages(table_stream(spark, sf_dir, "orders")),
        name,
        folder,
        TRANSACTION_SCHEMA,
        until_caught_up=True,
    ).awaitTermination()
    return spark.table(name)


def stream_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, an insert and a batch job fill one table; all but the insert run twice."""
    folder, name = scratch_folder(spark), f"{scratch_namespace(spark)}.shared"
    kind = F.coalesce("event_type", F.lit("none"))
    for number in (1, 2):
        for part in ("view", "click"):
            events = table_stream(spark, sf_dir, "events").filter(kind == part)
            start_append(events, name, f"{folder}/{part}", until_caught_up=True, shared=True).awaitTermination()
        rest = table(spark, sf_dir, "events").filter(~kind.isin("view", "click", "none"))
        append_once(rest, name, "batch", 1)
        if number == 1:
            table(spark, sf_dir, "events").filter(kind == "none").write.insertInto(name)
    return spark.table(name)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, in two runs with one checkpoint: rows, and what is known of the rejected ones."""
    folder, namespace = scratch_folder(spark), scratch_namespace(spark)
    orders = table(spark, sf_dir, "orders")
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    for part in (orders.filter(finished), orders.filter(~finished)):
        transaction_messages(part).write.mode("append").parquet(f"{folder}/landing")
        landed = StructType.fromDDL("value binary")
        ingest_transactions(
            read_file_stream(spark, f"{folder}/landing", landed, maxBytesPerTrigger=10**12),
            f"{namespace}.transactions",
            f"{folder}/checkpoint",
            until_caught_up=True,
            rejects=f"{namespace}.rejects",
        ).awaitTermination()
    rows = spark.table(f"{namespace}.transactions").select(
        "transaction_id",
        F.col("buyer_buyer_id").alias("buyer_id"),
        F.col("seller_seller_id").alias("seller_id"),
        F.lit(False).alias("rejected"),
    )
    text = F.decode("value", "UTF-8")
    number = {n: F.regexp_extract(text, f'"{n}":([0-9]+)', 1).cast("bigint").alias(n) for n in ("buyer_id", "seller_id")}
    rejects = spark.table(f"{namespace}.rejects").select(
        F.lit(None).cast("string").alias("transaction_id"), *number.values(), F.lit(True).alias("rejected")
    )
    return rows.unionByName(rejects)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_parquet": scan_parquet,
    "scan_parquet_evolving": scan_parquet_evolving,
    "scan_csv": scan_csv,
    "scan_csv_rejects": scan_csv_rejects,
    "table_count_sql": table_count_sql,
    "table_scan_current_namespace": table_scan_current_namespace,
    "table_lifecycle": table_lifecycle,
    "partitioned_replace": partitioned_replace,
    "replace_row_count": replace_row_count,
    "partition_reload": partition_reload,
    "partition_prune": partition_prune,
    "enrich_int_code": enrich_int_code,
    "enrich_many_codes": enrich_many_codes,
    "enrich_string_code": enrich_string_code,
    "to_date": to_date,
    "drop_columns": drop_columns,
    "left_join_dim": left_join_dim,
    "left_join_unique": left_join_unique,
    "left_join_newest": left_join_newest,
    "role_playing_dim": role_playing_dim,
    "count_rows": count_all_rows,
    "filter_not_null": filter_not_null,
    "strip_whitespace": strip_whitespace_text,
    "cast_binary": cast_binary,
    "struct_star": struct_star,
    "from_json_flat": from_json_flat,
    "from_json_nested": from_json_nested,
    "flatten_structs": flatten_structs,
    "explode_outer": explode_outer,
    "explode_all": explode_all,
    "explode_vectors": explode_vectors,
    "enrichment": enrichment,
    "batch_enrichment": batch_enrichment,
    "batch_enrichment_events": batch_enrichment_events,
    "stream_append": stream_append,
    "stream_interval": stream_interval,
    "stream_restart": stream_restart,
    "stream_archived": stream_archived,
    "stream_transactions": stream_transactions,
    "stream_two_writers": stream_two_writers,
    "stream_rejects": stream_rejects,
}
