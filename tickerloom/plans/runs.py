"""Queries over run logs and message lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.operators import project, runs
from tickerloom.plans.registry import query
from tickerloom.plans.shape import final
from tickerloom.session import scratch_path

AGENTS = """agents AS (SELECT execution_id, agent_name, min(started) AS started, max(ended) AS ended, arg_max(success, turn) AS success, count(*) AS events,
  sum(length(text)) AS characters FROM v_turns GROUP BY execution_id, agent_name)"""
DURATIONS = """durations AS (SELECT execution_id, min(started)::DOUBLE AS start_timestamp, (max(ended) - min(started))::DOUBLE AS total, arg_max(success, turn) AS success FROM v_turns GROUP BY execution_id)"""


def events(t):
    return t.v_turns.withColumns({"started": F.col("started").cast("double"), "ended": F.col("ended").cast("double")})


def agents(t):
    return runs.agent_logs(events(t))


@query("scan_run_logs", f"""WITH {AGENTS}, {DURATIONS}
SELECT execution_id, 'execution' AS kind, NULL::VARCHAR AS name, NULL::VARCHAR AS content, NULL::BIGINT AS number, round(total, 6) AS seconds,
  CASE WHEN success THEN 'completed' ELSE 'failed' END AS status FROM durations
UNION ALL SELECT execution_id, 'agents', agent_name, characters::VARCHAR, events, round((ended - started)::DOUBLE, 6), CASE WHEN success THEN 'completed' ELSE 'failed' END FROM agents
UNION ALL SELECT execution_id, 'interactions', execution_id || '-' || turn, md5(text), length(text), round((ended - started)::DOUBLE, 6), role FROM v_turns
UNION ALL SELECT execution_id, 'tools', agent_name, md5(shown), length(shown), round((ended - started)::DOUBLE, 6), success::VARCHAR
  FROM (SELECT *, CASE WHEN length(text) > 1000 THEN left(text, 1000) || '...' ELSE text END AS shown FROM v_turns WHERE role = 'user')
UNION ALL SELECT execution_id, 'reports', NULL, md5(arg_max(text, turn)), length(arg_max(text, turn)), NULL, NULL FROM v_turns WHERE role = 'assistant' GROUP BY execution_id""")
def scan_run_logs(t):
    """Documents of all five kinds written, scanned as one table of documents and parsed by kind."""
    path = scratch_path(t.spark, "runs")
    runs.write_run(events(t), path)
    documents = runs.flat_documents(t.spark, path)
    none = F.lit(None).cast("string")
    message = F.col("input.messages")[0]

    def rows(kind, name, content, number, seconds, status):
        made = {"name": name, "content": content, "number": number.cast("long"), "seconds": F.round(seconds, 6), "status": status.cast("string")}
        return runs.parsed_logs(documents, kind).select("execution_id", F.lit(kind).alias("kind"), *[c.alias(n) for n, c in made.items()])

    return project.union_by_name([
        rows("execution", none, none, F.lit(None), F.col("total_execution_time_seconds"), F.col("status")),
        rows("agents", F.col("agent_name"), F.col("output_data")["characters"], F.col("input_data")["events"], F.col("execution_time_seconds"), F.col("status")),
        rows("interactions", F.col("interaction_id"), F.md5(message["content"]), F.col("input.total_input_length"), F.col("performance.execution_time_seconds"), message["role"]),
        rows("tools", F.col("agent_name"), F.md5("output"), F.length("output"), F.col("execution_time_seconds"), F.col("success")),
        rows("reports", none, F.md5("report"), F.length("report"), F.lit(None).cast("double"), none),
    ])


@query("sink_run_logs", f"""WITH {AGENTS} SELECT execution_id, agent_name, round((ended - started)::DOUBLE, 6) AS seconds, success,
CASE WHEN success THEN 'completed' ELSE 'failed' END AS status, CASE WHEN NOT success THEN 'failed' END AS error, events::VARCHAR AS events, characters::VARCHAR AS characters FROM agents""")
def sink_run_logs(t):
    """Start and completion merged into one document per run and agent, written and read back."""
    path = scratch_path(t.spark, "agents")
    runs.write_logs(agents(t), f"{path}/agents")
    return runs.read_logs(t.spark, path, "agents").select(
        "execution_id", "agent_name", F.round("execution_time_seconds", 6).alias("seconds"), "success", "status", "error",
        F.col("input_data")["events"].alias("events"), F.col("output_data")["characters"].alias("characters"),
    )


@query("run_duration", f"""WITH {DURATIONS} SELECT execution_id, start_timestamp, round(total, 6) AS total_execution_time_seconds, CASE WHEN success THEN 'completed' ELSE 'failed' END AS status FROM durations""")
def run_duration(t):
    return final(runs.run_durations(events(t)))


@query("recent_runs", f"""WITH {DURATIONS} SELECT execution_id, start_timestamp, CASE WHEN success THEN 'completed' ELSE 'failed' END AS status FROM durations ORDER BY start_timestamp DESC LIMIT 10""")
def recent_runs(t):
    return runs.recent_runs(runs.run_durations(events(t)), 10).select("execution_id", "start_timestamp", "status")


@query("run_summary", f"""WITH {AGENTS}, listed AS (SELECT execution_id, string_agg(agent_name || ':' || success::VARCHAR || ':' || (ended - started)::INT::VARCHAR, ';' ORDER BY agent_name) AS agents_executed, count(*) AS n FROM agents GROUP BY execution_id),
c AS (SELECT execution_id, count(*) AS inter, count(*) FILTER (WHERE role = 'user') AS tools, count(DISTINCT agent_name) FILTER (WHERE role = 'user') AS tool_files FROM v_turns GROUP BY execution_id)
SELECT execution_id, agents_executed, inter AS llm_interactions_count, tools AS tools_used_count, 5 + n + 2 * inter + tool_files AS total_files_created FROM listed JOIN c USING (execution_id)""")
def run_summary(t):
    listed = runs.run_summary(agents(t), events(t))
    entry = lambda a: F.concat_ws(":", a["agent_name"], a["success"].cast("string"), a["execution_time_seconds"].cast("int").cast("string"))
    return listed.withColumn("agents_executed", F.array_join(F.transform("agents_executed", entry), ";"))


@query("run_log_assemble", f"""WITH {AGENTS}, {DURATIONS}, a AS (SELECT execution_id, count(*) AS agents, count(*) FILTER (WHERE success) AS agents_ok FROM agents GROUP BY execution_id),
e AS (SELECT execution_id, count(*) AS interactions, count(*) FILTER (WHERE role = 'user') AS tool_calls, arg_max(length(text), turn) FILTER (WHERE role = 'assistant') AS report_length FROM v_turns GROUP BY execution_id)
SELECT execution_id, round(total, 6) AS total_execution_time_seconds, agents, agents_ok, interactions, tool_calls, report_length FROM durations JOIN a USING (execution_id) JOIN e USING (execution_id)""")
def run_log_assemble(t):
    """All five kinds of documents written, scanned back and joined."""
    path = scratch_path(t.spark, "runs")
    runs.write_run(events(t), path)
    details = runs.run_details(t.spark, path)
    return final(details.drop("start_timestamp", "status"))


@query("interaction_metrics", """SELECT conv_id, count(*) AS message_count, sum(length(text))::BIGINT AS total_input_length,
coalesce(arg_max(length(text), turn) FILTER (WHERE role = 'assistant'), 0) AS output_length FROM conversations GROUP BY conv_id""")
def interaction_metrics(t):
    return runs.interaction_metrics(t.conversations)


@query("last_ai_message", """SELECT conv_id, md5(coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), nullif(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE text <> ''), ''), 'No analysis generated.')) AS output FROM conversations GROUP BY conv_id""")
def last_ai_message(t):
    return runs.last_answer(t.conversations).withColumn("output", F.md5("output"))


@query("messages_to_transcript", """SELECT conv_id, md5(coalesce(regexp_replace(string_agg(CASE role WHEN 'user' THEN 'User: ' || text WHEN 'assistant' THEN 'Assistant: ' || text END, chr(10) ORDER BY turn), '^\\s+|\\s+$', '', 'g'), '')) AS transcript,
md5(any_value(sys)) AS system_text FROM conversations LEFT JOIN (SELECT conv_id, arg_max(text, turn) AS sys FROM conversations WHERE role = 'system' GROUP BY conv_id) s USING (conv_id) GROUP BY conv_id""")
def messages_to_transcript(t):
    return runs.transcripts(t.conversations).select("conv_id", F.md5("transcript").alias("transcript"), F.md5("system_text").alias("system_text"))


@query("append_messages", """SELECT conv_id, turn, role, md5(text) AS text FROM conversations
UNION ALL SELECT conv_id, max(turn) + 1, 'assistant', md5('新闻分析已完成') FROM conversations GROUP BY conv_id
UNION ALL SELECT DISTINCT -1 - conv_id, 0, 'assistant', md5('新闻分析已完成') FROM conversations""")
def append_messages(t):
    known = t.conversations.select("conv_id").distinct()
    done = known.unionByName(known.select((-1 - F.col("conv_id")).alias("conv_id"))).select(  # half of them have no messages yet
        "conv_id", F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.lit("新闻分析已完成").alias("text")
    )
    return runs.append_messages(t.conversations, done).withColumn("text", F.md5("text"))


@query("merge_state_maps", """SELECT doc_id, 'lang=' || lang || ';n=' || n_chars::VARCHAR || ';source=' || CASE WHEN doc_id % 2 = 0 THEN 'seen' ELSE source END AS merged FROM documents""")
def merge_state_maps(t):
    left = F.create_map(F.lit("source"), F.col("source"), F.lit("lang"), F.col("lang"))
    n = F.col("n_chars").cast("string")
    right = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("source"), F.lit("seen"), F.lit("n"), n)).otherwise(F.create_map(F.lit("n"), n))
    merged = t.documents.select("doc_id", runs.merge_maps(left, right).alias("m"))
    entries = F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return merged.select("doc_id", F.array_join(entries, ";").alias("merged"))
