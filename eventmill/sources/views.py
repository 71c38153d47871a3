"""Event views over the given tables: the inputs of the registered queries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.functions.jsontext import dynamic_fields, integer_json, merged_maps, number_json, string_json
from eventmill.functions.levels import LEVELS, levels_from
from eventmill.session import prepare

# Which event types carry which levels (errors split in two by id).
TYPE_OF_LEVEL = {
    "Verbose": "view", "Debug": "click", "Information": "purchase", "Warning": "signup", "Error": "error", "Fatal": "error",
}

# Rows of a task where much is computed per row: a scanned file of some hundred MB has many millions.
ROWS_PER_TASK = 250_000

_COLUMNS = (
    "event_id",
    "CAST(ts AS TIMESTAMP) AS ts",
    "event_type",
    "user_id",
    "value",
    "CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 60 WHEN 2 THEN -300 ELSE 600 END AS offset_minutes",
    "CASE event_type WHEN 'view' THEN 'Verbose' WHEN 'click' THEN 'Debug' WHEN 'purchase' THEN 'Information'"
    " WHEN 'signup' THEN 'Warning' ELSE CASE WHEN event_id % 5 = 0 THEN 'Fatal' ELSE 'Error' END END AS level",
    "CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2"
    " WHEN 'signup' THEN 3 ELSE CASE WHEN event_id % 5 = 0 THEN 5 ELSE 4 END END AS level_rank",
    "CASE event_id % 3 WHEN 0 THEN '{EventType} by {UserId}' WHEN 1 THEN 'Value {Value:0.00} for {UserId}'"
    " ELSE '{Missing} {{literal}} {EventType}' END AS message_template",
    "CASE WHEN event_id % 17 = 0 THEN '{\"k\":\"s' || event_id || '\"}' ELSE props END AS props",
    "CASE WHEN event_type = 'error' THEN CAST(1 + event_id % 25 AS INT) ELSE 0 END AS chain_len",
    "CASE WHEN event_id % 97 = 0 THEN 400 WHEN event_id % 89 = 0 THEN 429 ELSE 201 END AS status",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores, and tasks of a bounded number of rows, when the files give fewer tasks than that."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / ROWS_PER_TASK))
    return df.repartition(tasks, key) if df.rdd.getNumPartitions() < tasks else df


def log_columns(events: DataFrame) -> DataFrame:
    """The log-event view of a table (or stream) of raw events."""
    return events.selectExpr(*_COLUMNS)


def log_events(spark: SparkSession, folder: str, minimum: str | None = None, heavy: bool = False) -> DataFrame:
    """Log events; a minimum level is also put as a predicate the scan can use.

    ``heavy`` says that much is computed per row, so that few input files must
    not mean few tasks.
    """
    events = table(spark, folder, "events")
    if heavy:
        events = spread(events, "event_id")
    if minimum is None:
        return log_columns(events)
    types = sorted({TYPE_OF_LEVEL[name] for name in levels_from(minimum)})
    logs = log_columns(events.filter(F.col("event_type").isin(types)))
    return logs.filter(F.col("level_rank") >= LEVELS.index(minimum))


def large_log_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same view shape over the largest table."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS event_id",
        "CAST(l_shipdate AS TIMESTAMP) AS ts",
        "CASE l_returnflag WHEN 'R' THEN 'error' WHEN 'A' THEN 'signup' ELSE 'purchase' END AS event_type",
        "l_suppkey AS user_id",
        "l_extendedprice AS value",
        "0 AS offset_minutes",
        "CASE l_returnflag WHEN 'R' THEN 'Error' WHEN 'A' THEN 'Warning' ELSE 'Information' END AS level",
        "CASE l_returnflag WHEN 'R' THEN 4 WHEN 'A' THEN 3 ELSE 2 END AS level_rank",
        "'Value {Value:0.00} for {UserId}' AS message_template",
        "'{\"k\":' || l_partkey || '}' AS props",
        "0 AS chain_len",
        "201 AS status",
    )


def with_payload(logs: DataFrame) -> DataFrame:
    """Add properties and the exception chain, as an event carries them."""
    return logs.withColumns({
        "properties": merged_maps(
            F.create_map(
                F.lit("EventType"), string_json(F.col("event_type")),
                F.lit("UserId"), integer_json(F.col("user_id")),
                F.lit("Value"), number_json(F.col("value"))),
            dynamic_fields(F.col("props"))),
        "exceptions": exception_chain(F.col("chain_len")),
    })


def with_structures(logs: DataFrame) -> DataFrame:
    """Events with a structure, a sequence and a dictionary among their columns."""
    return logs.withColumns({
        "User": F.struct(F.col("user_id").alias("Id"), F.when(F.col("event_id") % 3 > 0, "Account").alias("_typeTag"), F.col("event_type").alias("Last Type")),
        "Steps": F.array(F.col("event_id"), F.lit(None).cast("bigint"), F.lit(2).cast("bigint")),
        "Seats": F.create_map(F.lit(20), F.array(F.lit("a\"b"), F.col("level")), F.lit(3), F.array().cast("array<string>"))})


def deep_properties() -> Column:
    """Properties as JSON text with objects in objects, three and ten levels down."""
    def nested(levels: int, leaf: Column) -> Column:
        opening = "".join(f'{{"l{i}":' for i in range(1, levels + 1))
        return F.concat(F.lit(opening), leaf, F.lit("}" * levels))

    bottom = F.when(F.col("event_id") % 7 == 0, F.lit('"x"')).otherwise(F.col("event_id").cast("string"))
    return F.concat(F.lit('{"three":'), nested(3, F.lit("true")), F.lit(',"ten":'), nested(10, bottom), F.lit(',"none":{},"list":[[1,2],[{"a":1.5}]]}'))


def exception_chain(length: Column) -> Column:
    """The exception chain of an event, outermost first."""
    def one(d):
        # Every fifth description has too few parts and must be left out of documents.
        method = F.when(d % 5 == 4, F.lit("8\nBroken")).otherwise(F.format_string(
            "8\nMethod%d\nAsm%d, Version=1.%d.0.0, Culture=neutral, PublicKeyToken=null\nApp.Class%d\nVoid Method%d()",
            d % 4, d % 2, d % 3, d % 3, d % 4))
        return F.struct(
            F.concat(F.lit("E"), (d % 3).cast("string")).alias("ClassName"),
            F.concat(F.lit("m"), d.cast("string")).alias("Message"),
            F.when(d % 2 == 0, "app").alias("Source"),
            F.when(d % 4 != 3, "at A\n\nat B").alias("StackTraceString"),
            F.lit(None).cast("string").alias("RemoteStackTraceString"),
            F.lit(0).alias("RemoteStackIndex"),
            method.alias("ExceptionMethod"),
            (-d).alias("HResult"),
            F.lit(None).cast("string").alias("HelpURL"),
        )
    return F.when(length > 0, F.transform(F.sequence(F.lit(0), length - 1), one))


def exception_links(logs: DataFrame) -> DataFrame:
    """The chains as links: one row per exception with the id of its inner one."""
    rows = logs.filter("chain_len > 0").select(
        "event_id", "chain_len", F.explode(F.sequence(F.lit(0), F.col("chain_len") - 1)).alias("d"))
    return rows.select(
        "event_id",
        (F.col("event_id") * 100 + F.col("d")).alias("exc_id"),
        F.when(F.col("d") + 1 < F.col("chain_len"), F.col("event_id") * 100 + F.col("d") + 1).alias("inner_exc_id"),
        F.concat(F.lit("E"), (F.col("d") % 3).cast("string")).alias("class_name"),
        F.concat(F.lit("m"), F.col("d").cast("string")).alias("message"),
        F.when(F.col("d") % 4 != 3, "at A\n\nat B").alias("stack"),
        (-F.col("d")).alias("hresult"),
    )


def buffer_lines(logs: DataFrame) -> DataFrame:
    """Events as lines of rolling buffer files: two files per day."""
    return logs.select(buffer_file_name().alias("file_name"), "event_id", F.col("props").alias("line"))


def buffer_file_name() -> Column:
    """The buffer file an event is written to."""
    suffix = F.when(F.col("event_id") % 2 == 0, "").otherwise("_001")
    return F.concat(F.lit("buf-"), F.date_format("ts", "yyyyMMdd"), suffix, F.lit(".json"))


def file_sizes(lines: DataFrame) -> DataFrame:
    """Size and line count of each buffer file."""
    return lines.groupBy("file_name").agg(
        F.sum(F.octet_length("line")).alias("size_bytes"), F.count(F.lit(1)).alias("n_lines"))


# Names that a daily listing must not pick up: a month, an hour, another base, a short sequence.
DECOYS = ("buf-202401.json", "buf-2024010107.json", "other-20240101.json", "buf-20240101_01.json")


def with_decoys(files: DataFrame) -> DataFrame:
    """Add files that are not daily buffer files."""
    rows = ", ".join(f"('{name}', 0L, 0L)" for name in DECOYS)
    return files.unionByName(files.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(file_name, size_bytes, n_lines)"))


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Delivery attempts per target."""
    return table(spark, folder, "events").selectExpr(
        "'t' || (user_id % 5) AS target", "event_id AS attempt_no", "CAST(ts AS TIMESTAMP) AS ts",
        "event_type <> 'error' AS success")


def targets(spark: SparkSession) -> DataFrame:
    """The delivery targets, a literal table."""
    return spark.sql(
        "SELECT * FROM VALUES ('t0', '8.0.0', 'my', true, 'IndexAnyway'), ('t1', '7.17.5', NULL, false, 'IndexAnyway'),"
        " ('t2', '6.8.1', 'my', true, 'IndexAnyway'), ('t3', '6.8.1', NULL, false, 'IndexToDeadletterIndex'),"
        " ('t4', '8.0.0', NULL, false, 'FailSink') AS t(target, version, type_name, registration_ok, recovery)")


def level_control(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP'2024-01-01', 2), (TIMESTAMP'2024-01-10', 0), (TIMESTAMP'2024-01-20', 4) "
        "AS t(effective_from, min_rank)")



STUB_ERRORS = "CASE status WHEN 400 THEN 'mapper_parsing_exception' WHEN 429 THEN 'rejected' END"


def bulk_responses(batched: DataFrame, op: str = "index") -> DataFrame:
    """What a search store would answer to each batch, from the status every event carries.

    Items name their event by ``doc_id``. A batch has at most its posting limit of rows.
    """
    failed = F.col("status") >= 300
    error = F.when(failed, F.struct(F.expr(STUB_ERRORS).alias("type"), F.when(F.col("status") == 400, "bad field").alias("reason")))
    item = F.struct(F.struct(
        F.col("_index"), F.col("doc_id").alias("_id"), F.col("status"), error.alias("error")).alias(op))
    answered = batched.groupBy("batch_id").agg(
        F.max(failed).alias("errors"), F.array_sort(F.collect_list(F.struct("pos", item.alias("item")))).alias("_rows"))
    body = F.struct(F.col("errors"), F.transform("_rows", lambda r: r["item"]).alias("items"))
    return answered.select(
        "batch_id", F.lit(200).alias("http_status"), F.lit(True).alias("success"), F.to_json(body).alias("response"))
