from __future__ import annotations

import datetime
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from rowcast.functions.logtext import ACCESS_LINE, APP_LINE
from rowcast.operators import logs

ACCESS = [
    '10.1.2.3 - - [05/Mar/2024:08:00:09 +0100] "GET /start HTTP/1.1" 200 77',
    '10.1.2.4 - bob [05/Mar/2024:08:00:10 +0100] "GET /list?page=2 HTTP/1.0" 200 4096',
    '10.1.2.5 - - [05/Mar/2024:08:01:00 +0100] "PUT /item/9 HTTP/1.1" 302 15',
    '10.1.2.6 - - [05/Mar/2024:08:01:30 +0100] "GET /gone HTTP/1.1" 404 9',
    '10.1.2.3 - - [05/Mar/2024:08:02:00 +0100] "GET /start HTTP/1.1" 500 0',
]
BROKEN = ["", "nonsense", '1.1.1.1 - - [x] "GET / HTTP/1.1" 200 -']


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_access_counts(spark):
    table = lines(spark, ACCESS)
    assert [tuple(r) for r in logs.status_counts(table).collect()] == [
        (200, 2), (302, 1), (404, 1), (500, 1),
    ]
    assert [tuple(r) for r in logs.top_urls(table).collect()][0] == ("/start", 2)
    assert tuple(logs.error_rate(table).first()) == (5, 2, 0.4)
    assert tuple(logs.error_rate(lines(spark, [])).first()) == (0, 0, 0.0)


def test_access_fields_and_malformed_lines(spark):
    rows = {r.value: r for r in logs.parse_access(lines(spark, ACCESS + BROKEN)).collect()}
    first = rows[ACCESS[0]]
    assert (first.ip, first.method, first.url, first.http_ver, first.status, first.size) == (
        "10.1.2.3", "GET", "/start", "HTTP/1.1", 200, 77,
    )
    moment = datetime.datetime(2024, 3, 5, 7, 0, 9, tzinfo=datetime.timezone.utc)
    assert first.epoch_seconds == int(moment.timestamp())
    assert (rows["nonsense"].ip, rows["nonsense"].status, rows["nonsense"].size) == ("", None, None)
    dash = rows[BROKEN[2]]
    assert (dash.status, dash.size, dash.epoch_seconds) == (200, None, None)


APP = [
    "[2025-01-02 03:04:05] ERROR disk full, disk slow",
    "[2025-01-02 03:04:06] INFO Disk ok",
    "[oops] WARN Zażółć",
    "[2025-01-02 03:04:07] DEBUG disk disk disk",
    "no brackets",
    "prefix [a] [2025-01-02 03:04:08] INFO tail",
]


def test_app_log(spark):
    table = lines(spark, APP)
    rows = {r.value: r for r in logs.parse_app(table).collect()}
    assert rows[APP[0]].timestamp == datetime.datetime(2025, 1, 2, 3, 4, 5)
    assert (rows[APP[0]].level, rows[APP[0]].message) == ("ERROR", "disk full, disk slow")
    assert (rows[APP[2]].timestamp, rows[APP[2]].message) == (None, "Zażółć")
    assert tuple(rows[APP[3]])[1:] == (None, None, None)
    assert [tuple(r) for r in logs.level_counts(table).collect()] == [
        ("INFO", 2), ("ERROR", 1), ("WARN", 1),
    ]
    assert [r.message for r in logs.errors(table).collect()] == ["disk full, disk slow"]
    words = [tuple(r) for r in logs.top_words(table).collect()]
    assert words[0] == ("disk", 3)
    # Only ASCII letters count, so accents split words; ties are alphabetical.
    assert words[1:] == [("full", 1), ("ok", 1), ("slow", 1), ("tail", 1), ("za", 1)]


TOKENS = st.sampled_from(
    ["[", "]", " ", "  ", "INFO", "WARN", "ERROR", "DEBUG", "x", "-", '"GET', "/a", 'HTTP/1.1"',
     "200", "[t]", "1.2.3.4", "\t", "é", "\r", " ", "$1", "\\"]
)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(TOKENS, max_size=14).map(" ".join), min_size=1, max_size=40))
def test_one_match_per_line_agrees_with_python(spark, texts):
    """Lines of random pieces, against Python's ``re`` with ASCII classes."""
    rows = logs.parse_app(lines(spark, texts)).collect()
    for text, row in zip(texts, rows):
        found = re.search(APP_LINE, text, re.ASCII)
        want = (found.group(2), found.group(3)) if found else (None, None)
        assert (row.level, row.message) == want
    rows = logs.parse_access(lines(spark, texts)).collect()
    for text, row in zip(texts, rows):
        found = re.search(ACCESS_LINE, text, re.ASCII)
        assert (row.ip, row.url) == ((found.group(1), found.group(4)) if found else ("", ""))
