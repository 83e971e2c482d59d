"""Run logs and message lists.

Message tables hold one row per message (``conv_id``, ``turn``, ``role``, ``text``). Lengths, counts and
last messages are plain aggregates. Only texts that must become one value are gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Roles, line prefixes, the text without an answer, characters of tool output kept in logs.
SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
PREFIXES = {USER: "User: ", ASSISTANT: "Assistant: "}
NO_ANALYSIS = "No analysis generated."
TOOL_OUTPUT_CHARACTERS = 1000

AGENT_LOG = T.StructType(
    [
        T.StructField("execution_id", T.StringType()),
        T.StructField("agent_name", T.StringType()),
        T.StructField("start_timestamp", T.DoubleType()),
        T.StructField("end_timestamp", T.DoubleType()),
        T.StructField("execution_time_seconds", T.DoubleType()),
        T.StructField("input_data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("output_data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("success", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
INTERACTION_LOG = T.StructType(
    [
        T.StructField("execution_id", T.StringType()),
        T.StructField("interaction_id", T.StringType()),
        T.StructField("agent_name", T.StringType()),
        T.StructField("input", T.StructType([
            T.StructField("messages", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))),
            T.StructField("message_count", T.IntegerType()),
            T.StructField("total_input_length", T.LongType()),
        ])),
        T.StructField("output", T.StructType([T.StructField("content", T.StringType()), T.StructField("content_length", T.IntegerType())])),
        T.StructField("performance", T.StructType([T.StructField("execution_time_seconds", T.DoubleType())])),
    ]
)
EXECUTION_LOG = T.StructType(
    [
        T.StructField("execution_id", T.StringType()),
        T.StructField("start_timestamp", T.DoubleType()),
        T.StructField("end_timestamp", T.DoubleType()),
        T.StructField("total_execution_time_seconds", T.DoubleType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
TOOL_LOG = T.StructType(
    [
        T.StructField("execution_id", T.StringType()),
        T.StructField("agent_name", T.StringType()),
        T.StructField("tool_name", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("execution_time_seconds", T.DoubleType()),
        T.StructField("success", T.BooleanType()),
    ]
)
REPORT_LOG = T.StructType(
    [
        T.StructField("execution_id", T.StringType()),
        T.StructField("report", T.StringType()),
        T.StructField("report_path", T.StringType()),
        T.StructField("report_length", T.LongType()),
        T.StructField("report_preview", T.StringType()),
    ]
)
# Where the folder layout keeps each kind, below the folder of a run.
RUN_FILES = {
    "execution": r"execution_info\.json",
    "agents": r"agents/[^/]+_execution\.json",
    "interactions": r"llm_interactions/[^/]+\.json",
    "tools": r"tools/[^/]+\.jsonl",
    "reports": r"reports/final_report_info\.json",
}
#: The kinds of documents of a run and their schemas.
LOGS = {"execution": EXECUTION_LOG, "agents": AGENT_LOG, "interactions": INTERACTION_LOG, "tools": TOOL_LOG, "reports": REPORT_LOG}


def status(success: Column) -> Column:
    return F.when(success, "completed").otherwise("failed")


def agent_logs(events: DataFrame) -> DataFrame:
    """Start and completion events of an agent merged into one record per run and agent."""
    last = lambda c: F.max_by(c, "turn")
    return (
        events.groupBy("execution_id", "agent_name")
        .agg(
            F.min("started").alias("start_timestamp"), F.max("ended").alias("end_timestamp"), last("success").alias("success"),
            F.count("*").alias("events"), F.sum(F.length("text")).alias("characters"),
        )
        .select(
            "execution_id",
            "agent_name",
            "start_timestamp",
            "end_timestamp",
            (F.col("end_timestamp") - F.col("start_timestamp")).alias("execution_time_seconds"),
            F.create_map(F.lit("events"), F.col("events").cast("string")).alias("input_data"),
            F.create_map(F.lit("characters"), F.col("characters").cast("string")).alias("output_data"),
            "success",
            F.when(~F.col("success"), "failed").alias("error"),
            status(F.col("success")).alias("status"),
        )
    )


def interaction_logs(events: DataFrame) -> DataFrame:
    """One record per message with its input and output in nested form."""
    message = F.array(F.struct("role", F.col("text").alias("content")))
    return events.select(
        "execution_id",
        F.concat_ws("-", "execution_id", F.col("turn").cast("string")).alias("interaction_id"),
        "agent_name",
        F.struct(message.alias("messages"), F.lit(1).alias("message_count"), F.length("text").cast("long").alias("total_input_length")).alias("input"),
        F.struct(F.col("text").alias("content"), F.length("text").alias("content_length")).alias("output"),
        F.struct((F.col("ended") - F.col("started")).alias("execution_time_seconds")).alias("performance"),
    )


def tool_logs(events: DataFrame) -> DataFrame:
    """One record per tool call (user turns stand for calls), the output cut as in the logs."""
    long_output = F.length("text") > TOOL_OUTPUT_CHARACTERS
    output = F.when(long_output, F.concat(F.left("text", F.lit(TOOL_OUTPUT_CHARACTERS)), F.lit("..."))).otherwise(F.col("text"))
    return events.where(F.col("role") == USER).select(
        "execution_id", "agent_name", F.lit("crawl_news").alias("tool_name"), output.alias("output"),
        (F.col("ended") - F.col("started")).alias("execution_time_seconds"), "success",
    )


def execution_logs(events: DataFrame) -> DataFrame:
    """One record per run, from its first start to its last end; the last event decides on success."""
    runs = events.groupBy("execution_id").agg(
        F.min("started").alias("start_timestamp"), F.max("ended").alias("end_timestamp"), F.max_by("success", "turn").alias("success")
    )
    return runs.select(
        "execution_id", "start_timestamp", "end_timestamp", (F.col("end_timestamp") - F.col("start_timestamp")).alias("total_execution_time_seconds"),
        "success", F.when(~F.col("success"), "failed").alias("error"), status(F.col("success")).alias("status"),
    )


def report_logs(events: DataFrame) -> DataFrame:
    """The final report of each run: its last answer. Runs without one have no record."""
    return events.where(F.col("role") == ASSISTANT).groupBy("execution_id").agg(F.max_by("text", "turn").alias("report"))


def write_run(events: DataFrame, base: str) -> None:
    """All five kinds of documents of the runs in ``events``, a folder each below ``base``."""
    made = {
        "execution": execution_logs, "agents": agent_logs, "interactions": interaction_logs, "tools": tool_logs, "reports": report_logs,
    }
    for kind, build in made.items():
        write_logs(build(events), f"{base}/{kind}")


def read_logs(spark, base: str, kind: str) -> DataFrame:
    """The documents of one kind below ``base``."""
    return spark.read.schema(LOGS[kind]).json(f"{base}/{kind}")


def write_logs(records: DataFrame, path: str) -> None:
    """One JSON document per record. Run ids stay a field: a folder per run would be millions of small files."""
    records.write.json(path)


def flat_documents(spark, base: str) -> DataFrame:
    """All documents that ``write_run`` left below ``base``: ``execution_id``, ``kind``, ``document``; large files are split."""
    per_kind = [spark.read.text(f"{base}/{kind}").select(F.lit(kind).alias("kind"), F.col("value").alias("document")) for kind in LOGS]
    documents = reduce(DataFrame.unionByName, per_kind)
    return documents.select(F.get_json_object("document", "$.execution_id").alias("execution_id"), "kind", "document")


def folder_documents(spark, base: str) -> DataFrame:
    """All documents of the folder layout, in one scan that packs small files: ``execution_id``, ``kind``, ``document``.

    The run id is the folder's name. Each line of a file of tool calls is a document; other files are one. Files that belong to
    no kind are left out, so are blank lines. A document that is no JSON keeps its row; its fields are null when parsed.
    """
    raw = spark.read.text(base, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json*")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))  # written by Spark, always valid
    kind = F.coalesce(*[F.when(path.rlike(f"/[^/]+/{files}$"), kind) for kind, files in RUN_FILES.items()])
    run = F.coalesce(*[F.nullif(F.regexp_extract(path, f"/([^/]+)/{files}$", 1), F.lit("")) for files in RUN_FILES.values()])
    parts = F.when(F.col("kind") == "tools", F.split("value", r"\r?\n")).otherwise(F.array("value"))
    found = raw.select(run.alias("execution_id"), kind.alias("kind"), "value").where("kind is not null")
    return found.select("execution_id", "kind", F.explode(parts).alias("document")).where("trim(document) <> ''")


def parsed_logs(documents: DataFrame, kind: str) -> DataFrame:
    """The documents of one kind as typed rows; the run id is that of the table."""
    rows = documents.where(F.col("kind") == kind).select("execution_id", F.from_json("document", LOGS[kind]).alias("_row"))
    return rows.select("execution_id", *[f"_row.{f.name}" for f in LOGS[kind] if f.name != "execution_id"])


def read_run_folders(spark, base: str, kind: str = "agents") -> DataFrame:
    """Documents of one kind from the folder layout."""
    return parsed_logs(folder_documents(spark, base), kind)


def run_durations(events: DataFrame) -> DataFrame:
    return execution_logs(events).select("execution_id", "start_timestamp", "total_execution_time_seconds", "status")


def run_summary(agents: DataFrame, events: DataFrame) -> DataFrame:
    """Agents with success and duration, interaction and tool counts, files created per run.

    The gathered list has one entry per agent of a run, not per event.
    """
    entry = F.struct("agent_name", "success", "execution_time_seconds")
    listed = agents.groupBy("execution_id").agg(F.array_sort(F.collect_list(entry)).alias("agents_executed"))
    is_tool = F.col("role") == USER
    counted = events.groupBy("execution_id").agg(
        F.count("*").alias("llm_interactions_count"), F.count_if(is_tool).alias("tools_used_count"),
        F.count_distinct(F.when(is_tool, F.col("agent_name"))).alias("_tool_files"),
    )
    # four folders, the run document, one file per agent, two per interaction, one per agent with tools
    files = 5 + F.size("agents_executed") + 2 * F.col("llm_interactions_count") + F.col("_tool_files")
    joined = listed.join(counted, "execution_id", "left").fillna(0, ["llm_interactions_count", "tools_used_count", "_tool_files"])
    return joined.withColumn("total_files_created", files).drop("_tool_files")


def run_details(spark, base: str) -> DataFrame:
    """One row per run from its scanned documents: agents, interactions, tool calls and report; children are counted first."""
    read = lambda kind: read_logs(spark, base, kind)
    details = read("execution").select("execution_id", "start_timestamp", "total_execution_time_seconds", "status")
    counted = [
        read("agents").groupBy("execution_id").agg(F.count("*").alias("agents"), F.count_if("success").alias("agents_ok")),
        read("interactions").groupBy("execution_id").agg(F.count("*").alias("interactions")),
        read("tools").groupBy("execution_id").agg(F.count("*").alias("tool_calls")),
        read("reports").select("execution_id", F.length("report").alias("report_length")),
    ]
    for part in counted:
        details = details.join(part, "execution_id", "left")
    return details.fillna(0, ["agents", "agents_ok", "interactions", "tool_calls"])


def recent_runs(durations: DataFrame, n: int = 10) -> DataFrame:
    return durations.orderBy(F.desc("start_timestamp")).limit(n)


def interaction_metrics(messages: DataFrame) -> DataFrame:
    """Message count, summed content length and length of the last answer per conversation."""
    return messages.groupBy("conv_id").agg(
        F.count("*").alias("message_count"),
        F.sum(F.length(F.coalesce("text", F.lit("")))).alias("total_input_length"),
        F.coalesce(F.max_by(F.length("text"), F.when(F.col("role") == ASSISTANT, F.col("turn"))), F.lit(0)).alias("output_length"),
    )


def last_answer(messages: DataFrame) -> DataFrame:
    """The last assistant message; else all contents joined by line breaks; else a fixed text."""
    is_answer = F.col("role") == ASSISTANT
    # one aggregate picks the answers; only conversations without one are gathered
    answers = messages.where(is_answer).groupBy("conv_id").agg(F.max_by("text", "turn").alias("output"))
    silent = messages.join(answers.select("conv_id"), "conv_id", "left_anti")
    joined = silent.groupBy("conv_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("turn", "text")))).getField("text"), "\n").alias("all_text")
    )
    fallback = joined.select("conv_id", F.when(F.col("all_text") != "", F.col("all_text")).otherwise(NO_ANALYSIS).alias("output"))
    return answers.unionByName(fallback)


def transcript_lines(messages: DataFrame) -> DataFrame:
    """The prefixed lines of a conversation, a row each, by ``turn``: the form for lists too long to be one value."""
    line = F.when(F.col("role") == USER, F.concat(F.lit(PREFIXES[USER]), "text")).when(
        F.col("role") == ASSISTANT, F.concat(F.lit(PREFIXES[ASSISTANT]), "text")
    )
    return messages.select("conv_id", "turn", line.alias("line")).where("line is not null")


def transcripts(messages: DataFrame) -> DataFrame:
    """One row per conversation: the system text (the last one counts) and the other turns as prefixed lines, trimmed."""
    gathered = transcript_lines(messages).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "line"))).alias("lines"))
    system = messages.groupBy("conv_id").agg(F.max_by("text", F.when(F.col("role") == SYSTEM, F.col("turn"))).alias("system_text"))
    text = F.regexp_replace(F.array_join(F.col("lines.line"), "\n"), r"^\s+|\s+$", "")
    return system.join(gathered, "conv_id", "left").select("conv_id", F.coalesce(text, F.lit("")).alias("transcript"), "system_text")


def append_messages(messages: DataFrame, additions: DataFrame) -> DataFrame:
    """Message lists concatenated in table form: added messages follow the last turn of their conversation, if it has one."""
    last = messages.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    placed = additions.join(last, "conv_id", "left").select("conv_id", (F.coalesce("_last", F.lit(-1)) + 1 + F.col("turn")).alias("turn"), "role", "text")
    return messages.select("conv_id", "turn", "role", "text").unionByName(placed)


def merge_maps(left: Column, right: Column) -> Column:
    """Dictionary merge, the right side wins, whatever the session's duplicate-key policy."""
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k)), right)
