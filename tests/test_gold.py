"""Fixed expected values and edge rows."""

import datetime as dt
import hashlib
import json
import math

import pytest
from gold_requests import CASES
from pyspark.sql import functions as F
from tickerloom.functions import codes, dates, outputs, prompts, report_text, request, text, web
from tickerloom.operators import calendar, indicators, klines, labels, masking, metrics, news, project, ranking, runs, scoring, statements
from tickerloom.sources import files, market


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("x")).first().x


def test_requests(spark):
    df = spark.createDataFrame([(i, q) for i, (q, _, _) in enumerate(CASES)], "i int, q string")
    got = {r.i: (r.r.company, r.r.code) for r in df.select("i", request.stock_request(F.col("q")).alias("r")).collect()}
    wrong = [(q, got[i], (c, k)) for i, (q, c, k) in enumerate(CASES) if got[i] != (c, k)]
    assert wrong == []


@pytest.mark.parametrize(
    "raw,first,tail",
    [
        ("4", 4, 4), ("score 15 then 4.", 4, None), ("12", None, None), ("6", None, None), ("", None, None),
        ("Assistant: 3 Assistant: 4 x", 3, 4), ("Assistant:\n5\nok", 5, 5), ("Assistant: 4.", 4, None), ("a5b", 5, None),
    ],
)
def test_scores(spark, raw, first, tail):
    assert one(spark, raw, outputs.first_score) == first
    assert one(spark, raw, outputs.tail_score) == tail


def test_score_texts(spark):
    assert one(spark, 2, lambda v: outputs.score_with_text(v, outputs.RISK_TEXTS, outputs.RISK_FAILED), "int") == "2 (低风险)"
    assert one(spark, None, lambda v: outputs.score_with_text(v, outputs.RISK_TEXTS, outputs.RISK_FAILED), "int") == "无法分析风险"


@pytest.mark.parametrize(
    "raw,full,plain,dotted",
    [
        ("600000", "sh600000", "600000", "sh.600000"), ("000001", "sz000001", "000001", "sz.000001"),
        ("sh.600000", "sh600000", "600000", "sh.600000"), ("SZ.300750", "sz300750", "300750", "SZ.300750"),
        ("830799", "bj830799", "830799", "830799"), ("430047", "bj430047", "430047", "430047"), ("510300", "sh510300", "510300", "510300"),
        ("900901", "sh900901", "900901", "900901"), (" 002594 ", "sz002594", "002594", " 002594 "),
    ],
)
def test_codes(spark, raw, full, plain, dotted):
    assert one(spark, raw, codes.exchange_code) == full
    assert one(spark, raw, codes.plain_code) == plain
    assert one(spark, raw, codes.dotted_code) == dotted


@pytest.mark.parametrize(
    "day,period,start,middle,display",
    [
        ("2024-03-10", "recent", "2024-01-01", "2024-02-01", "2024年1月-2月-3月"),
        ("2024-03-20", "recent", "2024-02-01", "2024-02-01", "2024年2月-3月"),
        ("2024-01-10", "recent", "2023-11-01", "2023-12-01", "2023年11月-2024年1月"),
        ("2024-02-10", "recent", "2024-01-01", "2024-01-01", "2024年1月-2月"),
        ("2024-01-20", "recent", "2023-12-01", "2023-12-01", "2023年12月-2024年1月"),
        ("2024-02-29", "quarter", "2023-11-01", "2023-11-01", "2023年11月-2024年2月"),
        ("2024-08-31", "half_year", "2024-02-01", "2024-05-01", "2024年2月-5月-8月"),
        ("2024-06-15", "year", "2023-06-01", "2023-12-01", "2023年6月-2024年6月"),
        ("2024-05-31", "other", "2024-04-01", "2024-04-01", "2024年4月-5月"),
    ],
)
def test_timeframes(spark, day, period, start, middle, display):
    df = spark.createDataFrame([(day, period)], "d string, p string")
    x = df.select(dates.analysis_timeframe(F.to_date("d"), F.col("p")).alias("x")).first().x
    assert (x.start.isoformat(), x.middle.isoformat()) == (start, middle)
    assert x.display == f"{display} (ISO日期范围: {start} 至 {day})"


def test_date_parts(spark):
    x = one(spark, dt.datetime(2024, 1, 5, 9, 3, 7), dates.date_parts_cn, "timestamp_ntz")
    assert x.current_time_info == "2024年01月05日 (2024-01-05) 星期五 09:03:07"


def test_quarter_end(spark):
    df = spark.createDataFrame([(2023, q) for q in (1, 2, 3, 4, 5)], "y int, q int")
    got = [r.x for r in df.select("q", dates.quarter_end_code(F.col("y"), F.col("q")).alias("x")).orderBy("q").collect()]
    assert got == ["20230331", "20230630", "20230930", "20231231", None]


def bars(spark, rows):
    return spark.createDataFrame(
        [("A", dt.date.fromisoformat(d), *v) for d, *v in rows], "code string, date date, open double, high double, low double, close double, volume long, amount double"
    )


def test_resample_edges(spark):
    df = bars(spark, [
        ("2024-01-05", 1.0, 2.0, 0.5, 1.5, 10, 1.0),  # a Friday keeps its own label
        ("2024-01-06", None, 3.0, 1.0, 2.0, 10, 1.0),  # Saturday belongs to the next Friday; open missing
        ("2024-01-08", 4.0, 5.0, 3.0, None, 10, 1.0),  # close missing: the Saturday close counts
        ("2024-01-15", None, 5.0, 3.0, 4.0, 10, 1.0),  # a week without any open is dropped
        ("2024-01-31", 7.0, 8.0, 6.0, 7.5, 10, None),
    ])
    weekly = {str(r.date): r for r in klines.resample(df, "w").collect()}
    assert sorted(weekly) == ["2024-01-05", "2024-01-12", "2024-02-02"]
    assert (weekly["2024-01-12"].open, weekly["2024-01-12"].close, weekly["2024-01-12"].high) == (4.0, 2.0, 5.0)
    monthly = klines.resample(df, "m").collect()
    assert [str(r.date) for r in monthly] == ["2024-01-31"] and monthly[0].open == 1.0 and monthly[0].close == 7.5


def test_kline_contract(spark):
    df = bars(spark, [("2024-01-02", 1.0, 1.0, 1.0, 1.0, 1, 1.0), ("2024-01-03", 2.0, 2.0, 2.0, 2.0, 1, 1.0)])
    out = klines.klines(df)
    assert out.columns == ["date", "code", "open", "high", "low", "close", "preclose", "volume", "amount", "pctChg", "adjustflag"]
    rows = out.orderBy("date").collect()
    assert rows[0].preclose is None and rows[0].pctChg is None and rows[1].pctChg == 100.0 and rows[1].date == "2024-01-03"
    for bad in ({"frequency": "5"}, {"adjust_flag": "9"}):
        with pytest.raises(ValueError):
            klines.klines(df, **bad)


def test_adjusted_prices(spark):
    df = bars(spark, [(f"2024-01-0{i}", 10.0, 10.0, 10.0, 10.0, 1, 1.0) for i in (1, 3, 5)])
    factors = spark.createDataFrame(
        [("A", dt.date(2024, 1, 2), 1.1), ("A", dt.date(2024, 1, 5), 1.2)], "code string, dividOperateDate date, factor double"
    )
    backward = [round(r.close, 6) for r in klines.adjust(df, factors, "2").orderBy("date").collect()]
    forward = [round(r.close, 6) for r in klines.adjust(df, factors, "1").orderBy("date").collect()]
    assert backward == [10.0, 11.0, 12.0] and forward == [round(10 / 1.2, 6), round(11 / 1.2, 6), 10.0]


def test_streaming_bars_equal_batch(spark, sf_dir, tmp_path):
    from tickerloom.sources.standins import Tables
    from tickerloom.streaming.bars import streaming_bars

    ticks = Tables(spark, sf_dir).v_ticks_intraday.withColumn("ts", F.col("ts").cast("timestamp"))
    ticks.write.parquet(str(tmp_path / "ticks"))
    last = ticks.agg(F.max("ts")).first()[0]
    flush = ticks.limit(1).withColumn("ts", F.lit(last + dt.timedelta(days=2)))
    stream = spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "ticks"))
    run = streaming_bars(stream).writeStream.format("memory").queryName("bars").option(
        "checkpointLocation", str(tmp_path / "state")).start()
    try:
        run.processAllAvailable()
        flush.write.mode("append").parquet(str(tmp_path / "ticks"))
        run.processAllAvailable()
        got = {tuple(r) for r in spark.sql("SELECT * FROM bars").collect()}
    finally:
        run.stop()
    assert got == {tuple(r) for r in klines.intraday_bars(ticks, "15").collect()}


def test_calendar_defaults(spark):
    days = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2024, 3, 29),)], "date date")
    assert calendar.in_date_range(days, "date", None, "2024-03-31").count() == 2
    assert calendar.in_date_range(days, "date", "2024-03-02", "2024-03-31").count() == 1
    bounds = spark.createDataFrame([(dt.date(2024, 2, 28), dt.date(2024, 3, 31))], "start date, end date")
    flags = calendar.trading_calendar(days, bounds)
    assert flags.count() == 33 and flags.agg(F.sum("is_trading_day")).first()[0] == 2
    assert calendar.latest_trading_date(flags, "2024-03-30").first()[0] == "2024-03-29"  # days 29 to 31 count
    assert calendar.latest_trading_date(flags, "2024-02-28").first()[0] == "2024-02-28"


def test_asof(spark):
    statement = spark.createDataFrame([("A", "2023-03-31", 1), ("A", "20230930", 2), ("B", "20240331", 3)], "code string, `报告日` string, v int")
    requests = statements.with_target(spark.createDataFrame([("A", 2023, 1), ("A", 2023, 2), ("A", 2023, 4), ("B", 2023, 4)], "code string, y int, q int"))
    got = {(r.code, r.q): r.v for r in statements.asof_statement(statement, requests).collect()}
    assert got == {("A", 1): 1, ("A", 2): 1, ("A", 4): 2}


def test_projection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, `币种` int")
    assert project.project_existing(df, ["b", "x", "a"]).columns == ["b", "a"]
    assert project.project_existing(df, None, ["a", "z"]).columns == ["a"]
    with pytest.raises(ValueError):
        project.project_existing(df, ["x"], strict=True)
    wide = df.select("币种", *[F.lit(1).alias(f"利润{i}") for i in range(30)], F.lit(2).alias("other"))
    assert len(project.project_keyword_columns(wide, ["利润"]).columns) == 31
    assert len(project.project_keyword_columns(wide, ["利润"], most=24).columns) == 25
    assert project.project_keyword_columns(df.select("a", "b"), ["利润"]).columns == ["a", "b"]


def test_label_edges(spark):
    raw = [None, "0", "6", "2.7", "abc", "5.9", "NaN", "1", "-1", " 3 ", "Infinity"]
    df = spark.createDataFrame([(i, "s", None, x) for i, x in enumerate(raw)], files.LABEL_CSV)
    got = {r.row_id: (r.label, r.Stock_symbol) for r in labels.clean_labels(df).collect()}
    assert got == {3: (2, "STOCK"), 5: (5, "STOCK"), 7: (1, "STOCK"), 9: (3, "STOCK")}
    with pytest.raises(ValueError):
        labels.require_rows(df)


def labelled(spark, sizes):
    rows, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((i, label))
            i += 1
    return spark.createDataFrame(rows, "row_id long, label int")


def test_samples(spark):
    rows = labelled(spark, {1: 3, 2: 200, 3: 50})
    out = labels.sample_balanced(rows, 100, 7).collect()
    counts = {k: sum(r.label == k for r in out) for k in (1, 2, 3)}
    assert len(out) == 100 and len({r.row_id for r in out}) == 100 and sorted(r.shuffle_pos for r in out) == list(range(1, 101))
    assert counts[1] == 3 and counts[2] >= 33 and counts[3] >= 33
    assert labels.select_rows(rows, 0, "head", 1).count() == 253 and labels.select_rows(rows, 999, "balanced", 1).count() == 253
    again = labels.sample_random(rows.repartition(7), 20, 3)
    assert {r.row_id for r in again.collect()} == {r.row_id for r in labels.sample_random(rows, 20, 3).collect()}


def test_split(spark):
    rows = labelled(spark, {1: 40, 2: 60, 3: 21})
    parts = labels.split_stratified(rows, 0.1, 42).collect()
    evals = [r for r in parts if r.part == "eval"]
    assert len(parts) == 121 and len(evals) == 13 and {r.label for r in evals} == {1, 2, 3}
    lone = labels.split_stratified(labelled(spark, {1: 40, 2: 1}), 0.1, 42).collect()  # not feasible: plain random
    assert sum(r.part == "eval" for r in lone) == 5


def test_rank_with_one_hot_key(spark):
    rows = spark.range(5000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("k"))
    got = ranking.with_rank(rows, ranking.seeded(1, "row_id"), "row_id", "r", ["k"])
    check = got.groupBy("k").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi"), F.count_distinct("r").alias("d"))
    assert all((r.lo, r.hi, r.d) == (1, r.n, r.n) for r in check.collect())


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, None), (4, 2)], "truth int, prediction int")
    assert metrics.accuracy(df).first().accuracy == 0.4
    assert metrics.accuracy_valid_only(df).first().accuracy == 50.0
    assert metrics.within_one(df).first().within_one == pytest.approx(0.6)
    matrix = {r.truth: [r[f"pred_{x}"] for x in range(1, 6)] for r in metrics.confusion_matrix(df).collect()}
    assert matrix[1] == [1, 1, 0, 0, 0] and matrix[3] == [0] * 5 and matrix[5] == [0] * 5
    report = {r.label: r for r in metrics.classification_report(df).collect()}
    assert report["5"].f1 == 0 and report["2"].precision == pytest.approx(1 / 3) and report["macro avg"].support == 5


def test_completion_mask(spark):
    df = spark.createDataFrame([("abcdef", "3")], "p string, a string")
    e = df.select(masking.encode_completion(F.col("p"), F.col("a"), 5).alias("e")).first().e
    assert e.input_ids == [97, 98, 99, 51, masking.EOS_ID] and e.labels == [-100] * 3 + [51, masking.EOS_ID] and e.attention_mask == [1] * 5
    with pytest.raises(Exception, match="max_length is too small"):
        df.select(masking.encode_completion(F.col("p"), F.col("a"), 2).alias("e")).collect()


def test_legacy_mask(spark):
    def run(value, length):
        return one(spark, value, lambda v: masking.legacy_answer(v, length))

    e = run("Assistant: 1 Assistant: 25", 30)
    assert e.labels[:24] == [-100] * 24 and e.labels[24:26] == [50, 53] and e.labels[26:] == [-100] * 4
    assert run("no marker", 12).labels == [-100] * 12
    cut = run("Assistant: 1 Assistant: 25", 15)  # the marker's end was cut off: mask by its first letter
    assert cut.labels == [-100] * 15
    assert run("Assistant: 1 xxxxxxxxxxxx Assistant: 25", 20).labels == [-100] * 12 + [ord(c) for c in " xxxxxxx"]


def test_padding(spark):
    rows = [(i, i + 1, [1] * n, [1] * n, [5] * n) for i, n in enumerate((3, 9, 2))]
    df = spark.createDataFrame(rows, "row_id int, pos int, input_ids array<int>, attention_mask array<int>, labels array<int>")
    got = {r.row_id: r for r in masking.pad_batches(df, "pos", 2).collect()}
    assert [len(got[i].input_ids) for i in range(3)] == [16, 16, 8] and got[0].labels == [5] * 3 + [-100] * 13 and got[2].attention_mask == [1, 1] + [0] * 6


def test_prompts(spark):
    df = spark.createDataFrame([("AAPL", "News.")], "s string, t string")
    m = df.select(prompts.messages("risk", F.col("s"), F.col("t")).alias("m")).first().m
    assert m[1].content == "Stock symbol: AAPL\nSummarized news: News."
    x = df.select(prompts.legacy_conversation("sentiment", F.col("s"), F.col("t"), F.lit(4)).alias("x")).first().x
    assert x.endswith("Assistant: 4\n\nUser: News to Stock Symbol -- AAPL: News.\nAssistant: 4") and x.startswith("System: Forget all")


def test_softmax(spark):
    s = one(spark, [0.0, 1.0, 3.0, 3.0, -2.0], scoring.softmax_score, "array<double>")
    assert s.score == 3 and s.probabilities["3"] == s.probabilities["4"] and sum(s.probabilities.values()) == pytest.approx(1, abs=1e-3)


def test_cut_after_marker(spark):
    info = "2024年01月05日 (2024-01-05) 星期五 09:03:07"
    cut = lambda r: one(spark, r, lambda v: report_text.cut_after_marker(v, F.lit(info)))
    assert cut(f"a\n分析基准时间： {info} x\nb") == f"a\n分析基准时间： {info} x"
    assert cut(f"dated {info}\n\n更新时间:{info}\nb") == f"dated {info}\n\n更新时间:{info}"
    assert cut("a\nas of (2024-01-05) close\nb") == "a\nas of (2024-01-05) close"
    assert cut("nothing\n ") == "nothing\n "


def test_web(spark):
    page = '<html><script>"<p>"</script><article><p>short</p><p>A <b>long</b> paragraph &amp; more than thirty characters<p>Another unclosed paragraph with enough text</article><p>Outside the article, also long enough to count</p>'
    assert one(spark, page, web.paragraphs) == "Along" "paragraph & more than thirty characters Another unclosed paragraph with enough text"
    heads = '<h3 class="x"><a href="/a">Plain</a></h3><h3 class="c-TITLE y"><em><a href="/b"> News <i>one</i></a></em></h3><h3 class="news">no link</h3>'
    assert [(h.title, h.href) for h in one(spark, heads, web.headings)] == [("Newsone", "/b")]
    assert one(spark, "/link?url=http%3A%2F%2Fa.b%2Fc+d&x=1", web.redirect_target) == "http://a.b/c+d"
    assert one(spark, "http://a/?url=1", web.redirect_target) == "http://a/?url=1"
    assert one(spark, "<title>Gateway TimeOut</title>", web.blocked) and not one(spark, "<title>ok</title>", web.blocked)
    assert one(spark, "```markdown\n# x\n```\n", web.strip_fences) == "# x"
    assert one(spark, "x" * 301, web.preview) == "x" * 300 + "..." and one(spark, "x" * 300, web.preview) == "x" * 300


def test_cosine_has_idf_of_the_pair(spark):
    df = spark.createDataFrame([("a stock stock rises", "stock falls 3 today"), ("x", "x")], "a string, b string")
    rows = df.select(text.tfidf_cosine(text.term_counts(F.col("a")), text.term_counts(F.col("b"))).alias("c")).collect()
    w = text.SINGLE_IDF
    assert rows[0].c == pytest.approx(2 / ((4 + w * w) ** 0.5 * (1 + 2 * w * w) ** 0.5)) and rows[1].c == 0


def test_messages(spark):
    rows = [(1, 0, "system", "old"), (1, 1, "user", "hi"), (1, 2, "system", "new"), (1, 3, "assistant", "yo"), (2, 0, "user", "a"), (2, 1, "user", "b"), (3, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in runs.transcripts(df).collect()}
    assert got[1].transcript == "User: hi\nAssistant: yo" and got[1].system_text == "new" and got[3].transcript == "User:"
    assert {r.conv_id: r.output for r in runs.last_answer(df).collect()} == {1: "yo", 2: "a\nb", 3: "No analysis generated."}


def test_run_folders(spark, tmp_path):
    folder = tmp_path / "run_7" / "agents"
    folder.mkdir(parents=True)
    record = {"agent_name": "news_agent", "execution_time_seconds": 2.5, "success": True, "status": "completed", "input_data": {"q": "x"}}
    (folder / "news_agent_execution.json").write_text(json.dumps(record, indent=2))
    row = runs.read_run_folders(spark, str(tmp_path)).first()
    assert (row.execution_id, row.agent_name, row.execution_time_seconds, row.input_data["q"]) == ("run_7", "news_agent", 2.5, "x")


def test_all_documents_of_run_folders(spark, tmp_path):
    run = tmp_path / "run 8+x"
    for folder in ("agents", "llm_interactions", "tools", "reports", "other"):
        (run / folder).mkdir(parents=True)
    put = lambda path, *docs, indent=None: (run / path).write_text("\n".join(json.dumps(d, indent=indent, ensure_ascii=False) for d in docs), encoding="utf-8")
    put("execution_info.json", {"execution_id": "ignored", "status": "completed", "success": True, "start_timestamp": 1.5}, indent=2)
    put("agents/a_execution.json", {"agent_name": "a", "success": False}, indent=2)
    put("agents/notes.json", {"agent_name": "no log"})
    put("llm_interactions/a_summary_1.json", {"interaction_id": "1", "input": {"message_count": 2}, "output": {"content": "新\n闻"}}, indent=2)
    (run / "llm_interactions" / "a_summary_1.txt").write_text("not read")
    put("tools/a_tools.jsonl", {"tool_name": "x", "output": "one"}, {"tool_name": "y", "output": "two\nlines"})
    put("tools/b_tools.jsonl", {"tool_name": "z"})
    with open(run / "tools" / "b_tools.jsonl", "a") as f:
        f.write("\r\n\r\n")
    put("reports/final_report_info.json", {"report_path": "r.md", "report_length": 3, "report_preview": "abc"}, indent=2)
    put("other/execution_info.jsonx", {})
    (tmp_path / "run9").mkdir()
    (tmp_path / "run9" / "execution_info.json").write_text("{broken")

    read = lambda kind: runs.read_run_folders(spark, str(tmp_path), kind)
    assert sorted((r.execution_id, r.status or "", r.start_timestamp or 0) for r in read("execution").collect()) == [("run 8+x", "completed", 1.5), ("run9", "", 0)]
    assert [(r.execution_id, r.agent_name, r.success) for r in read("agents").collect()] == [("run 8+x", "a", False)]
    assert [(r.interaction_id, r.input.message_count, r.output.content) for r in read("interactions").collect()] == [("1", 2, "新\n闻")]
    assert sorted((r.tool_name, r.output) for r in read("tools").collect()) == [("x", "one"), ("y", "two\nlines"), ("z", None)]
    assert [(r.report_path, r.report_length, r.report_preview) for r in read("reports").collect()] == [("r.md", 3, "abc")]


def test_both_layouts_give_the_same_table(spark, tmp_path):
    events = spark.createDataFrame(
        [("r1", 0, "user", "hi", "a", 1.0, 2.0, True), ("r1", 1, "assistant", "yo", "a", 3.0, 5.0, False)],
        "execution_id string, turn long, role string, text string, agent_name string, started double, ended double, success boolean",
    )
    runs.write_run(events, str(tmp_path / "flat"))
    flat = runs.flat_documents(spark, str(tmp_path / "flat"))
    assert sorted(r.kind for r in flat.collect()) == ["agents", "execution", "interactions", "interactions", "reports", "tools"]
    names = {"execution": "execution_info.json", "agents": "agents/a_execution.json", "tools": "tools/a_tools.jsonl", "reports": "reports/final_report_info.json"}
    for i, r in enumerate(flat.collect()):
        to = tmp_path / "folders" / r.execution_id / names.get(r.kind, f"llm_interactions/a_{i}.json")
        to.parent.mkdir(parents=True, exist_ok=True)
        to.write_text(r.document)
    folders = runs.folder_documents(spark, str(tmp_path / "folders"))
    assert sorted(map(str, folders.collect())) == sorted(map(str, flat.collect()))


def test_open_ended_ranges(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    assert market.date_between(df, "d", None, None).count() == 3 and market.date_between(df, "d", "2024-01-02", None).count() == 2


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Session:
    """A session with just the settings that name the shared folder."""

    def __init__(self, master, folder=None):
        self.conf = _Conf({"spark.checkpoint.dir": folder} if folder else {})
        self.sparkContext = self
        self.master, self.made = master, None

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, path):
        self.made = path


def test_scratch_follows_the_session():
    from tickerloom.session import shared_dir

    assert shared_dir(_Session("yarn", "hdfs://store/scratch/")) == "hdfs://store/scratch"
    alone = _Session("local[4]")
    assert shared_dir(alone) == alone.made == shared_dir(alone)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(_Session(master))


def test_macd_is_not_cut(spark):
    prices = [10 + 3 * math.sin(i / 9) + i / 50 for i in range(600)]
    bars = spark.createDataFrame([("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), p) for i, p in enumerate(prices)], "code string, date date, close double")

    def mean(values, span):
        decay, out, num, den = 1 - 2 / (span + 1), [], 0.0, 0.0
        for v in values:
            num, den = num * decay + v, den * decay + 1
            out.append(num / den)
        return out

    dif = [a - b for a, b in zip(mean(prices, 12), mean(prices, 26))]
    dea = mean(dif, 9)
    got = indicators.macd(bars).orderBy("date").collect()
    assert [r.dif for r in got] == pytest.approx(dif) and [r.dea for r in got] == pytest.approx(dea)
    assert [r.macd for r in got] == pytest.approx([2 * (a - b) for a, b in zip(dif, dea)], abs=1e-9)


def test_first_by_title_within_keys(spark):
    rows = [("q1", 0, "A"), ("q1", 1, "B"), ("q2", 0, "C"), ("q2", 1, "A"), ("q2", 2, "C")]
    df = spark.createDataFrame(rows, "query string, pos int, title string")
    assert sorted((r.query, r.pos, r.title) for r in news.first_by_title(df, ["query"]).collect()) == [("q1", 0, "A"), ("q1", 1, "B"), ("q2", 0, "C"), ("q2", 1, "A")]
    got = news.first_by_title(df).collect()
    assert sorted(r.title for r in got) == ["A", "B", "C"]


def test_append_to_an_empty_list(spark):
    kind = "conv_id long, turn long, role string, text string"
    got = runs.append_messages(spark.createDataFrame([(1, 4, "user", "a")], kind), spark.createDataFrame([(1, 0, "user", "b"), (2, 0, "user", "c")], kind))
    assert sorted((r.conv_id, r.turn, r.text) for r in got.collect()) == [(1, 4, "a"), (1, 5, "b"), (2, 0, "c")]


def test_long_transcript_is_one_value(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i} \n" if i == 4095 else f"t{i}") for i in range(9000)]
    (row,) = runs.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert row.transcript == "\n".join(("User: " if r[2] == "user" else "Assistant: ") + r[3] for r in rows)


def test_peers_without_industry(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None), ("3", "x")], "code string, industry string")
    assert {r.code: r.peer_count for r in market.peers(df).collect()} == {"1": 2, "2": None, "3": 2}


def test_restated_report_counts_once(spark):
    statement = spark.createDataFrame(
        [("A", "20230331", "2023-05-01", 1), ("A", "20230331", "2023-06-01", 2), ("A", "20221231", "2023-07-01", 3)],
        "code string, `报告日` string, `更新日期` string, v int",
    )
    requests = statements.with_target(spark.createDataFrame([("A", 2023, 1), ("A", 2023, 3)], "code string, y int, q int"))
    assert sorted((r.q, r.v) for r in statements.asof_statement(statement, requests).collect()) == [(1, 2), (3, 2)]


def test_statement_reports(spark):
    make = lambda column, value: spark.createDataFrame([("A", "20230331", value), ("A", "20220331", value * 2)], f"code string, `报告日` string, `{column}` int")
    tables = {statements.PROFIT: make("净利润", 5), statements.BALANCE: make("资产总计", 7), statements.CASH: make("现金净额", 9)}
    requests = spark.createDataFrame([("A", 2023, 2)], "code string, y int, q int")  # not published yet: the newest before it
    got = statements.statement_report("profit", tables, requests).collect()
    assert [(r["报告日"], r["净利润"]) for r in got] == [("20230331", 5)]
    grown = statements.statement_report("dupont", tables, requests)
    want = [
        (statements.PROFIT, 2023, 5, None), (statements.PROFIT, 2022, 10, None), (statements.BALANCE, 2023, None, 7),
        (statements.BALANCE, 2022, None, 14), (statements.CASH, 2023, None, None), (statements.CASH, 2022, None, None),
    ]
    assert sorted(((r["报表"], r["report_year"], r["净利润"], r["资产总计"]) for r in grown.collect()), key=str) == sorted(want, key=str)
    for kind in statements.KEYWORDS:
        assert statements.statement_report(kind, tables, requests).count() in (1, 6)


def test_simhash_and_counts_of_a_long_text(spark):
    words = [f"w{i % 5000}x" for i in range(20_000)]
    row = spark.createDataFrame([(" ".join(words), words)], "t string, w array<string>").select(text.term_counts(F.col("t")).alias("c"), text.simhash(F.col("w")).alias("s")).first()
    assert len(row.c) == 5000 and set(row.c.values()) == {4}
    low = [int.from_bytes(hashlib.md5(w.encode()).digest()[8:], "big") for w in words]
    assert row.s % 2**64 == sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in low) > len(low))


def test_scans_per_plan(spark, sf_dir):
    from tickerloom.plans import catalog

    most = {"sample_balanced": 8, "classification_report": 4, "scan_index_members": 2, "two_period_reports": 6, "prices_adjusted": 2}
    found = {n: catalog.queries()[n](spark, sf_dir)._jdf.queryExecution().executedPlan().toString().count("FileScan") for n in most}
    assert {n: found[n] for n in most if found[n] > most[n]} == {}


def test_instruments_without_industry_stay(spark):
    latest = spark.createDataFrame([("a", 10.0), ("b", 20.0), ("c", 5.0), ("d", 1.0)], "code string, pe double")
    industry = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "code string, industry string")
    got = {r.code: (r.industry, r.industry_mean, r.peers, r.gap) for r in statements.against_industry(latest, industry, "pe").collect()}
    assert got == {"a": ("x", 15.0, 2, -5.0), "b": ("x", 15.0, 2, 5.0), "c": (None, None, None, None)}
