"""Log reports: access-log lines from ``events``, application-log lines from ``documents``.

Each event gives one access-log line; every 97th is malformed and some sizes
are ``-``. Each line of each document is one application-log message; one
level in four is unknown to the parser.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.functions.logtext import ACCESS_LINE, APP_LINE
from rowcast.operators import logs
from rowcast.plans.scratch import scratch_path
from rowcast.sources import files
from rowcast.workloads.tables import table


def access_lines(spark: SparkSession, folder: str) -> DataFrame:
    key, user = F.col("event_id"), F.col("user_id")
    status = (
        F.when(F.col("event_type") == "error", F.when(key % 3 == 0, "500").otherwise("404"))
        .when(F.col("event_type") == "signup", "302")
        .otherwise("200")
    )
    line = F.concat(
        F.lit("10.0."), (user % 256).cast("string"), F.lit("."), (key % 256).cast("string"),
        F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0100] "'),
        F.when(F.col("event_type") == "purchase", "POST").otherwise("GET"),
        F.lit(" /"), F.col("event_type"), F.lit("/"), user.cast("string"),
        F.lit(' HTTP/1.1" '), status, F.lit(" "),
        F.when(key % 13 == 0, "-").otherwise((key * 7).cast("string")),
    )
    broken = F.concat(F.lit("unreadable entry "), key.cast("string"))
    return table(spark, folder, "events").select(
        F.when(key % 97 == 0, broken).otherwise(line).alias("value")
    )


def app_lines(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("doc_id")
    level = F.element_at(
        F.array(*[F.lit(x) for x in ("INFO", "WARN", "ERROR", "DEBUG")]),
        (key % 4 + 1).cast("int"),
    )
    head = F.concat(
        F.lit("[2025-11-27 10:"), F.lpad((key % 60).cast("string"), 2, "0"), F.lit(":00] "),
        level, F.lit(" "),
    )
    texts = files.spread(table(spark, folder, "documents").select("doc_id", "text"))
    return texts.select(
        F.explode(F.transform(F.split("text", "\n", -1), lambda part: F.concat(head, part))).alias(
            "value"
        )
    )


def weblog_parsed(spark: SparkSession, folder: str) -> DataFrame:
    """Written as text, read back line by line and parsed."""
    path = scratch_path(spark, "access")
    files.write_text(access_lines(spark, folder), path)
    return logs.parse_access(files.read_text(spark, path)).drop("value")


def weblog_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return logs.status_counts(access_lines(spark, folder))


def weblog_top_urls(spark: SparkSession, folder: str) -> DataFrame:
    return logs.top_urls(access_lines(spark, folder))


def weblog_error_rate(spark: SparkSession, folder: str) -> DataFrame:
    return logs.error_rate(access_lines(spark, folder))


def applog_level_counts(spark: SparkSession, folder: str) -> DataFrame:
    return logs.level_counts(app_lines(spark, folder))


def applog_errors(spark: SparkSession, folder: str) -> DataFrame:
    return logs.errors(app_lines(spark, folder)).drop("value")


def applog_top_words(spark: SparkSession, folder: str) -> DataFrame:
    return logs.top_words(app_lines(spark, folder))


QUERIES = {
    "weblog_parsed": weblog_parsed,
    "weblog_status_counts": weblog_status_counts,
    "weblog_top_urls": weblog_top_urls,
    "weblog_error_rate": weblog_error_rate,
    "applog_level_counts": applog_level_counts,
    "applog_errors": applog_errors,
    "applog_top_words": applog_top_words,
}

_ACCESS = r"""
WITH lines AS (
    SELECT CASE WHEN event_id % 97 = 0 THEN 'unreadable entry ' || event_id ELSE
        '10.0.' || (user_id % 256) || '.' || (event_id % 256) || ' - - ['
        || STRFTIME(ts, '%d/%b/%Y:%H:%M:%S') || ' +0100] "'
        || CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END
        || ' /' || event_type || '/' || user_id || ' HTTP/1.1" '
        || CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN '500'
                WHEN event_type = 'error' THEN '404'
                WHEN event_type = 'signup' THEN '302' ELSE '200' END
        || ' ' || CASE WHEN event_id % 13 = 0 THEN '-' ELSE CAST(event_id * 7 AS VARCHAR) END
        END AS value
    FROM events
), cut AS (
    SELECT REGEXP_EXTRACT(value,
        '{access_line}',
        ['ip', 'timestamp', 'method', 'url', 'http_ver', 'status', 'size']) AS p
    FROM lines
), parsed AS (
    SELECT p.ip AS ip, p.timestamp AS timestamp, p.method AS method, p.url AS url,
           p.http_ver AS http_ver, TRY_CAST(p.status AS INTEGER) AS status,
           TRY_CAST(p.size AS BIGINT) AS size,
           CAST(EPOCH(TRY_STRPTIME(LEFT(p.timestamp, 20), '%d/%b/%Y:%H:%M:%S')) - 3600 AS BIGINT)
               AS epoch_seconds
    FROM cut
)
"""

_APP = r"""
WITH lines AS (
    SELECT '[2025-11-27 10:' || LPAD(CAST(doc_id % 60 AS VARCHAR), 2, '0') || ':00] '
        || CASE doc_id % 4 WHEN 0 THEN 'INFO' WHEN 1 THEN 'WARN' WHEN 2 THEN 'ERROR'
                ELSE 'DEBUG' END
        || ' ' || UNNEST(STRING_SPLIT(text, CHR(10))) AS value
    FROM documents
), hits AS (
    SELECT value, REGEXP_MATCHES(value, '{app_line}') AS hit,
           REGEXP_EXTRACT(value, '{app_line}',
                          ['timestamp', 'level', 'message']) AS p
    FROM lines
), parsed AS (
    SELECT TRY_CAST(CASE WHEN hit THEN p.timestamp END AS TIMESTAMP) AS timestamp,
           CASE WHEN hit THEN p.level END AS level, CASE WHEN hit THEN p.message END AS message
    FROM hits
)
"""

_ACCESS = _ACCESS.replace("{access_line}", ACCESS_LINE)
_APP = _APP.replace("{app_line}", APP_LINE)

ORACLE = {
    "weblog_parsed": _ACCESS
    + "SELECT ip, timestamp, method, url, http_ver, status, size, epoch_seconds FROM parsed",
    "weblog_status_counts": _ACCESS
    + "SELECT status, COUNT(*) AS count FROM parsed GROUP BY status ORDER BY status",
    "weblog_top_urls": _ACCESS
    + "SELECT url, COUNT(*) AS hits FROM parsed GROUP BY url ORDER BY hits DESC, url",
    "weblog_error_rate": _ACCESS
    + """SELECT COUNT(*) AS total_requests,
    COUNT(*) FILTER (WHERE status >= 400 AND status < 600) AS error_count,
    CAST(COUNT(*) FILTER (WHERE status >= 400 AND status < 600) AS DOUBLE) / COUNT(*)
        AS error_rate FROM parsed""",
    "applog_level_counts": _APP
    + """SELECT level, COUNT(*) AS count FROM parsed WHERE level IS NOT NULL
    GROUP BY level ORDER BY count DESC, level""",
    "applog_errors": _APP
    + "SELECT timestamp, level, message FROM parsed WHERE level = 'ERROR'",
    "applog_top_words": _APP
    + """, words AS (
        SELECT UNNEST(REGEXP_EXTRACT_ALL(LOWER(message), '[a-zA-Z]+')) AS word
        FROM parsed WHERE message IS NOT NULL
    )
    SELECT word, COUNT(*) AS count FROM words GROUP BY word
    ORDER BY count DESC, word LIMIT 10""",
}
