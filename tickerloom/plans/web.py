"""Queries over web pages, links, requests and report texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions import dates, report_text, request, web
from tickerloom.plans.registry import query
from tickerloom.session import redistribute


#: The character references that the test pages hold.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")]
CONTAINERS_SQL = ["article-content", "story-content", "post-content", "entry-content"]


def visible(x: str) -> str:
    out = f"trim(regexp_replace({x}, '\\s*<[^>]*>\\s*', '', 'g'))"
    for name, value in ENTITIES:
        out = "replace({}, '{}', '{}')".format(out, name, value.replace("'", "''"))
    return out


CLEANED = "regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"
HOLDS = "CASE WHEN regexp_matches({0}, '(?i)<p[\\s>]') THEN {0} END"
ARTICLE = "regexp_extract(body, '(?is)<article[^>]*>(.*)</article>', 1)"
CONTAINERS = ", ".join(HOLDS.format(f"regexp_extract(body, '(?is)<\\w+[^>]*class=\"[^\"]*{c}[^\"]*\"[^>]*>(.*)', 1)") for c in CONTAINERS_SQL)


@query("html_paragraphs", f"""WITH b AS (SELECT page_id, {CLEANED} AS body FROM pages), s AS (SELECT page_id, coalesce({HOLDS.format(ARTICLE)}, {CONTAINERS}, body) AS scope FROM b),
p AS (SELECT page_id, list_slice(string_split(regexp_replace(regexp_replace(scope, '(?i)<p(?:\\s[^>]*)?>', chr(1), 'g'), '(?i)</p>', chr(2), 'g'), chr(1)), 2, 100000000) AS pieces FROM s),
x AS (SELECT page_id, list_filter(list_transform(pieces, lambda q: {visible("split_part(q, chr(2), 1)")}), lambda q: length(q) > 30) AS texts FROM p)
SELECT page_id, length(array_to_string(texts, ' ')) AS n, md5(array_to_string(texts, ' ')) AS digest FROM x""")
def html_paragraphs(t):
    df = redistribute(t.pages, "page_id").select("page_id", web.paragraphs(F.col("html")).alias("x"))
    return df.select("page_id", F.length("x").alias("n"), F.md5("x").alias("digest"))


RAW_LINK = """CASE WHEN page_id % 3 = 0 THEN url ELSE '/link?url=' || replace(replace(replace(url, ':', '%3A'), '/', '%2F'), '&', '%26') || '&eqid=' || page_id::VARCHAR END"""
LINKED_SQL = f"""(SELECT page_id, replace(replace(html, '<h1>', '<h3 class="' || CASE page_id % 4 WHEN 0 THEN 'news-title_1' WHEN 1 THEN 'plain' ELSE 'c-title' END || '"><a href="' || {RAW_LINK} || '">'), '</h1>', '</a></h3>')
 || CASE WHEN page_id % 5 = 0 THEN '<h3><a href="/more">More <b>of</b> this</a></h3>' ELSE '<h3>no link</h3>' END AS html FROM pages)"""


def raw_link():
    encoded = F.col("url")
    for plain, code in ((":", "%3A"), ("/", "%2F"), ("&", "%26")):
        encoded = F.replace(encoded, F.lit(plain), F.lit(code))
    return F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(
        F.concat(F.lit("/link?url="), encoded, F.lit("&eqid="), F.col("page_id").cast("string"))
    )


HINTED = "page_id % 4 <> 1"
TITLES = f"(SELECT page_id, url, page_id % 5 = 0 AS more, {HINTED} AS hinted, unnest(regexp_extract_all(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)) AS h1 FROM pages)"


def linked_pages(t):
    """Pages with their main heading turned into a linked result heading, as a result page has them, in odd but valid markup."""
    kind = F.when(F.col("page_id") % 4 == 0, "news-title_1").when(F.col("page_id") % 4 == 1, "plain").otherwise("c-TITLE")
    opened = F.concat(F.lit("<h3 data-x=\"1>0\" class='"), kind, F.lit("'><em><a\n HREF='"), raw_link(), F.lit("'>"))
    html = F.replace(F.replace(F.col("html"), F.lit("<h1>"), opened), F.lit("</h1>"), F.lit("</a></em></h3>"))
    tail = F.when(F.col("page_id") % 5 == 0, '<h3><a href=/more>More <b>of</b> this &eacute;&#8217;</a></h3>').otherwise("<h3>no link</h3>")
    return redistribute(t.pages, "page_id").select("page_id", F.concat(html, tail).alias("html"))


@query("html_headings", f"""SELECT page_id, pos::INT AS pos, title, href FROM (
SELECT page_id, row_number() OVER (PARTITION BY page_id) - 1 AS pos, {visible('h1')} AS title, {RAW_LINK} AS href FROM {TITLES}
UNION ALL SELECT page_id, count(*), 'Moreofthis é’', '/more' FROM {TITLES} WHERE more AND NOT hinted GROUP BY page_id
UNION ALL SELECT page_id, 0, 'Moreofthis é’', '/more' FROM pages WHERE page_id % 5 = 0 AND NOT regexp_matches(html, '(?i)<h1>'))""")
def html_headings(t):
    found = linked_pages(t).select("page_id", F.posexplode(web.headings(F.col("html"))).alias("pos", "h"))
    return found.select("page_id", "pos", "h.title", "h.href")


def result_pages(t):
    """Search result pages of one page each: the first or the second way finds its heading, or both do."""
    link = F.concat(F.lit("<h3 class='"), F.when(F.col("page_id") % 2 == 0, "c-title").otherwise("x"), F.lit("'><a href='"), raw_link(), F.lit("'>Page "), F.col("page_id").cast("string"), F.lit("</a></h3>"))
    box = F.concat(F.lit('<div class="c-Result"><div>'), link, F.lit("</div><div class=news-content>About<div> page <b>"), F.col("page_id").cast("string"), F.lit("</b></div></div></div>"))
    other = F.when(F.col("page_id") % 3 == 0, "<article class=News><h3><i><a href='/other'>Another &lt;one&gt;</a></i></h3></article>").otherwise("<article class=news><h3>no link</h3></article>")
    skipped = F.lit("<div class=result><h3 class=news><a href=/x>ab</a></h3></div><div class=result><h3 class=news><a href=/x>百度百科 x</a></h3></div>")
    return t.pages.select("page_id", F.concat(skipped, box, other).alias("html"))


TARGET = "CASE WHEN page_id % 3 = 0 THEN url ELSE url_decode(replace(replace(replace(url, ':', '%3A'), '/', '%2F'), '&', '%26')) END"


@query("news_results", f"""SELECT page_id, 'Page ' || page_id AS title, {TARGET} AS link, CASE WHEN page_id % 2 = 0 THEN '' ELSE 'Aboutpage' || page_id END AS abstract, CASE WHEN page_id % 2 = 0 THEN 1 ELSE 2 END AS way FROM pages
UNION ALL SELECT page_id, 'Another <one>', '/other', '', 2 FROM pages WHERE page_id % 3 = 0""")
def news_results(t):
    found = result_pages(t).select("page_id", F.inline(web.news_results(F.col("html"))))
    return found.select("page_id", "title", "link", "abstract", "way")


PARENT_SQL = "regexp_extract(html, '(?is)<article[^>]*>(.*)</article>', 1)"
HEAD_SQL = visible("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")


@query("html_abstract", f"""WITH s AS (SELECT page_id, {PARENT_SQL} AS parent, {HEAD_SQL} AS title FROM pages), e AS (SELECT *, {visible('parent')} AS whole FROM s)
SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 'Shortsummary' || page_id || 'end' ELSE left(trim(CASE WHEN title <> '' AND strpos(whole, title) > 0
  THEN left(whole, strpos(whole, title) - 1) || substr(whole, strpos(whole, title) + length(title)) ELSE whole END), 200) END AS abstract FROM e""")
def html_abstract(t):
    inner = F.regexp_extract("html", r"(?is)<article[^>]*>(.*)</article>", 1)
    summary = F.concat(F.lit("<div class='x c-Abstract'>Short <div><b>summary</b> </div>"), F.col("page_id").cast("string"), F.lit("<!-- </div> --><span>end</span></div>"))
    extra = F.when(F.col("page_id") % 6 == 0, summary).otherwise("")
    df = redistribute(t.pages, "page_id").select("page_id", F.concat(inner, extra).alias("parent"), web.element_text(F.col("html"), "h1").alias("title"))
    return df.select("page_id", web.abstract(F.col("parent"), F.col("title")).alias("abstract"))


@query("url_decode_redirect", f"""SELECT page_id, link, CASE WHEN starts_with(link, '/link?url=') THEN url_decode(regexp_extract(link, 'url=([^&]+)', 1)) ELSE link END AS target
FROM (SELECT page_id, {RAW_LINK} AS link FROM pages)""")
def url_decode_redirect(t):
    return t.pages.select("page_id", raw_link().alias("link")).withColumn("target", web.redirect_target(F.col("link")))


@query("blocked_page_flag", """SELECT page_id, contains(html, '安全验证') OR contains(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), 'timeout') AS blocked
FROM (SELECT page_id, CASE WHEN page_id % 17 = 0 THEN html || '百度安全验证' WHEN page_id % 19 = 0 THEN replace(html, '<title>', '<title>Gateway Timeout ') ELSE html END AS html FROM pages)""")
def blocked_page_flag(t):
    html = (
        F.when(F.col("page_id") % 17 == 0, F.concat("html", F.lit("百度安全验证")))
        .when(F.col("page_id") % 19 == 0, F.replace(F.col("html"), F.lit("<title>"), F.lit("<title>Gateway Timeout ")))
        .otherwise(F.col("html"))
    )
    return t.pages.select("page_id", html.alias("html")).select("page_id", web.blocked(F.col("html")).alias("blocked"))


@query("text_preview", """SELECT doc_id, CASE WHEN length(text) > 300 THEN left(text, 300) || '...' ELSE text END AS p300,
CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END AS p500 FROM documents""")
def text_preview(t):
    return t.documents.select("doc_id", web.preview(F.col("text")).alias("p300"), web.preview(F.col("text"), 500).alias("p500"))


@query("strip_code_fences", """SELECT doc_id, md5(regexp_replace(replace(replace('```markdown' || chr(10) || text || chr(10) || '```' || chr(10), '```markdown', ''), '```', ''), '^\\s+|\\s+$', '', 'g')) AS digest FROM documents""")
def strip_code_fences(t):
    fenced = F.concat(F.lit("```markdown\n"), "text", F.lit("\n```\n"))
    return t.documents.select("doc_id", F.md5(web.strip_fences(fenced)).alias("digest"))


INFO_SQL = """strftime(make_date(2020 + (doc_id % 4)::INT, 1 + (doc_id % 12)::INT, 1 + (doc_id % 28)::INT), '%Y年%m月%d日 (%Y-%m-%d) ') || '星期一' || strftime(make_date(2020, 1, 1), ' %H:%M:%S')"""
CUT_LABELS = ", ".join(
    f"nullif(regexp_replace(regexp_extract(report, '(?is)^(.*?{label}[：:]\\s*' || info_q || '[^\\n]*)', 1), '^\\s+|\\s+$', '', 'g'), '')" for label in report_text.TIME_LABELS
)
CUT_PARTS = ", ".join(
    f"nullif(regexp_replace(regexp_extract(report, '(?is)^(.*?' || {part} || '[^\\n]*)', 1), '^\\s+|\\s+$', '', 'g'), '')"
    for part in ("info_q", "regexp_escape(split_part(info, ' ', 1))", "regexp_escape(split_part(info, ' ', 2))")
)


@query("cut_after_marker", f"""WITH i AS (SELECT doc_id, text, {INFO_SQL} AS info FROM documents),
r AS (SELECT doc_id, info, regexp_escape(info) AS info_q, text || chr(10) || CASE doc_id % 5 WHEN 0 THEN '**分析基准时间：' || info || '** end' WHEN 1 THEN '更新时间: ' || info
  WHEN 2 THEN 'as of ' || split_part(info, ' ', 2) || ' close' WHEN 3 THEN 'see ' || split_part(info, ' ', 1) ELSE 'no time' END || chr(10) || 'tail ' || text AS report FROM i)
SELECT doc_id, length(cut) AS n, md5(cut) AS digest FROM (SELECT doc_id, coalesce({CUT_LABELS}, {CUT_PARTS}, report) AS cut FROM r)""")
def cut_after_marker(t):
    day = F.make_date((F.lit(2020) + F.col("doc_id") % 4).cast("int"), (F.col("doc_id") % 12 + 1).cast("int"), (F.col("doc_id") % 28 + 1).cast("int"))
    info = F.concat(F.date_format(day, "yyyy年MM月dd日 (yyyy-MM-dd) "), F.lit(dates.WEEKDAYS[0]), F.lit(" 00:00:00"))
    piece = lambda n: F.split_part(F.col("info"), F.lit(" "), F.lit(n))
    line = (
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("**分析基准时间："), "info", F.lit("** end")))
        .when(F.col("doc_id") % 5 == 1, F.concat(F.lit("更新时间: "), "info"))
        .when(F.col("doc_id") % 5 == 2, F.concat(F.lit("as of "), piece(2), F.lit(" close")))
        .when(F.col("doc_id") % 5 == 3, F.concat(F.lit("see "), piece(1)))
        .otherwise("no time")
    )
    reports = redistribute(t.documents, "doc_id").select("doc_id", "text", info.alias("info")).select(
        "doc_id", "info", F.concat("text", F.lit("\n"), line, F.lit("\ntail "), "text").alias("report")
    )
    df = reports.select("doc_id", report_text.cut_after_marker(F.col("report"), F.col("info")).alias("x"))
    return df.select("doc_id", F.length("x").alias("n"), F.md5("x").alias("digest"))


# ---- requests ---------------------------------------------------------------------------------


def _sql_group(pattern: str, group: int) -> str:
    if pattern.startswith(r"\b"):  # RE2 knows ASCII word boundaries only
        pattern = r"(?:^|[^0-9A-Za-z_\x{4e00}-\x{9fff}])(\d{5,6})(?:$|[^0-9A-Za-z_\x{4e00}-\x{9fff}])"
    return f"nullif(regexp_extract(query, '{pattern}', {group}), '')"


def _request_sql() -> str:
    arms = " ".join(
        f"WHEN {_sql_group(p, code)} IS NOT NULL THEN {{'company': trim({_sql_group(p, company)}), 'code': {_sql_group(p, code)}}}"
        for p, company, code in request.PAIRS
    )
    company = f"coalesce({', '.join(_sql_group(p, 1) for p in request.COMPANY)})"
    for word in request.STOP_WORDS:
        company = f"trim(replace({company}, '{word}', ''))"
    code = f"coalesce({', '.join(_sql_group(p, 1) for p in request.CODE)})"
    return f"""SELECT request_id, query, r.company AS company, r.code AS code FROM (SELECT request_id, query, CASE {arms}
      ELSE {{'company': CASE WHEN length({company}) >= 2 THEN {company} END, 'code': {code}}} END AS r FROM v_requests)"""


@query("extract_stock_info", _request_sql())
def extract_stock_info(t):
    return t.v_requests.select("request_id", "query", request.stock_request(F.col("query")).alias("r")).select(
        "request_id", "query", "r.company", "r.code"
    )
