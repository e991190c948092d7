"""DuckDB SQL that computes each registered query from the given tables.

Shared snippets spell out the reader rules in DuckDB terms: ``LINES(t)``
splits a whole text into ``readLine`` lines; ``SPLIT1`` / ``SPLIT_RE`` are
``String.split`` with its trailing-empty rule; ``BLANK`` is the blank-line
test. Staged file sets are described by the same fixed numbers as in
``staging`` and ``queries``.
"""

from __future__ import annotations

from rowsmith.plans import queries as Q
from rowsmith.plans import staging as S


def LINES(t: str) -> str:
    parts = f"regexp_split_to_array({t}, '\\r\\n|\\n|\\r')"
    return (
        f"(CASE WHEN {t} = '' THEN []::VARCHAR[] "
        f"WHEN {parts}[-1] = '' THEN {parts}[1:len({parts}) - 1] ELSE {parts} END)"
    )


def SPLIT1(x: str, ch: str) -> str:
    """Java ``split`` on a one-character delimiter (trailing empties dropped, '' -> [''])."""
    esc = ch.replace("'", "''")
    return (
        f"(CASE WHEN {x} = '' THEN ['']::VARCHAR[] "
        f"WHEN rtrim({x}, '{esc}') = '' THEN []::VARCHAR[] "
        f"ELSE string_split(rtrim({x}, '{esc}'), '{esc}') END)"
    )


def SPLIT_RE(x: str, regex: str) -> str:
    """Java ``split`` on a general regex."""
    parts = f"regexp_split_to_array({x}, '{regex}')"
    return (
        f"(CASE WHEN {x} = '' THEN ['']::VARCHAR[] "
        f"ELSE list_slice({parts}, 1, coalesce(list_max([i FOR e, i IN {parts} IF e <> '']), 0)) END)"
    )


def WORDS(x: str) -> str:
    return SPLIT1(x, " ")


def BLANK(x: str) -> str:
    return f"(regexp_full_match({x}, '[\\x00-\\x20]*') OR starts_with({x}, chr(13)) OR starts_with({x}, chr(10)))"


def NUMBERED(lst: str) -> str:
    """``unnest`` pair: the items of a list and their 1-based positions."""
    return f"unnest(range(1, len({lst}) + 1))"


LINEITEM_ROWS = """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem
"""

LINEITEM_LINE = "concat_ws(',', " + ", ".join(
    f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in S.LINEITEM_COLUMNS
) + ")"

WORD_COUNT = f"""
WITH lines AS (SELECT unnest({LINES('text')}) AS line FROM documents),
words AS (SELECT unnest({WORDS('line')}) AS word FROM lines)
SELECT word, count(*) AS cnt FROM words GROUP BY word
"""

TOKENIZE = f"""
WITH d AS (SELECT doc_id, {LINES('text')} AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, {NUMBERED('ls')} AS line_no FROM d),
w AS (SELECT doc_id, line_no, {WORDS('line')} AS ws FROM l)
SELECT doc_id, line_no, {NUMBERED('ws')} AS word_no, unnest(ws) AS word FROM w
"""

_ODD = f"repeat(' ', CAST(doc_id % 4 % 3 AS INT)) || substr('{S.NEAR_LINE_ENDS}', CAST(doc_id % 3 AS INT) + 1, 1)"
SKIP_BLANK_LINES = f"""
SELECT value FROM (SELECT unnest({LINES(f"(text || chr(10) || chr(10) || {_ODD} || chr(10))")}) AS value FROM documents)
WHERE NOT {BLANK('value')}
"""

_DOC_ARCHIVE_LINES = f"""
a AS (SELECT doc_id // {S.DOCS_PER_ARCHIVE} AS g, string_agg(text, '' ORDER BY doc_id) AS t FROM documents GROUP BY 1),
al AS (SELECT g, {LINES('t')} AS ls FROM a),
l AS (SELECT g, unnest(ls) AS value, {NUMBERED('ls')} AS line_no FROM al)
"""

SKIP_HEADER_LINES = f"""
WITH {_DOC_ARCHIVE_LINES}
SELECT printf('docs-%06d.zip', g) AS file_name, line_no, value FROM l
WHERE line_no >= {Q.HEADER_FIRST_DATA_LINE} AND NOT {BLANK('value')}
"""

_SENTINEL = Q.SENTINEL_LINE.replace("'", "''")
STOP_AT_SENTINEL = f"""
WITH {_DOC_ARCHIVE_LINES},
s AS (SELECT g, min(line_no) AS stop FROM l WHERE value = '{_SENTINEL}' GROUP BY g)
SELECT printf('docs-%06d.zip', l.g) AS file_name, line_no, value FROM l LEFT JOIN s ON l.g = s.g
WHERE (s.stop IS NULL OR line_no < s.stop) AND NOT {BLANK('value')}
"""

SPLIT_ARCHIVE_SCAN = f"""
WITH {_DOC_ARCHIVE_LINES},
s AS (SELECT g, min(line_no) AS stop FROM l
      WHERE value = '{_SENTINEL}' AND line_no >= {Q.HEADER_FIRST_DATA_LINE} GROUP BY g)
SELECT printf('docs-%06d.zip', l.g) AS file_name, line_no, value FROM l LEFT JOIN s ON l.g = s.g
WHERE line_no >= {Q.HEADER_FIRST_DATA_LINE} AND (s.stop IS NULL OR line_no < s.stop) AND NOT {BLANK('value')}
"""

EXTERNAL_TABLE_SQL = Q.EXTERNAL_TABLE_SQL.format(table=f"({LINEITEM_ROWS})")

SPLIT_INVARIANT_SCAN = """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
       CAST(sum(l_linenumber) AS BIGINT) AS sum_linenumber,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""

_YEARS = ", ".join(Q.SELECTED_YEARS.split("|"))

FILE_NAME_FILTER = LINEITEM_ROWS + f" WHERE year(l_shipdate) IN ({_YEARS})"

PAYLOAD_SIZE_FILTER = f"""
SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS body_bytes FROM pages
WHERE html IS NULL OR strlen(html) <= {Q.BODY_LIMIT}
"""

SPLIT_FIELDS = f"""
WITH t AS (SELECT page_id, {SPLIT_RE('url', Q.URL_DELIMITER)} AS f FROM pages)
SELECT page_id, {NUMBERED('f')} AS field_no, unnest(f) AS field FROM t
"""

TYPED_PROJECTION = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice, l_returnflag,
       l_returnflag = 'R' AS is_returned, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem
"""

COLUMN_PRUNING = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, CAST(NULL AS VARCHAR) AS l_comment
FROM lineitem
"""

COUNT_ONLY_SCAN = "SELECT count(*) AS n_records FROM lineitem"

FORMAT_LINES = f"SELECT {LINEITEM_LINE} AS value FROM lineitem"

SCAN_AUDIT = f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       year(l_shipdate) IN ({_YEARS}) AS matched,
       CAST(sum(strlen({LINEITEM_LINE}) + 1) AS BIGINT) AS bytes,
       CASE WHEN year(l_shipdate) IN ({_YEARS}) THEN count(*) END AS lines
FROM lineitem GROUP BY year(l_shipdate)
"""

ARCHIVE_AUDIT = f"""
SELECT printf('docs-%06d.zip', doc_id // {S.DOCS_PER_ARCHIVE}) AS file_name, true AS matched, true AS is_zip,
       count(*) AS entries, CAST(sum(strlen(text)) AS BIGINT) AS text_bytes
FROM documents GROUP BY doc_id // {S.DOCS_PER_ARCHIVE}
"""

REPORT = "CAST(json_object('http_user_agent', event_type, 'request_body', props) AS VARCHAR)"

ENCODE_EVENTS = f"SELECT event_id, {REPORT} AS message FROM events"

EVENT_ENVELOPE = f"SELECT event_id, 'key' AS key, {REPORT} AS value, 'test' AS topic FROM events"

KAFKA_VALUES = f"SELECT {REPORT} AS value FROM events"

BATCHED_WORD_COUNT = f"""
WITH lines AS (SELECT doc_id // {S.DOCS_PER_BUCKET} AS bucket, unnest({LINES('text')}) AS line FROM documents),
words AS (SELECT bucket, unnest({WORDS('line')}) AS word FROM lines)
SELECT bucket, word, count(*) AS cnt FROM words GROUP BY bucket, word
"""

ENCODED_SCAN = f"SELECT unnest({LINES('text')}) AS value FROM documents"

INTERVAL_WORD_COUNT = f"""
SELECT time_bucket(INTERVAL '{Q.INTERVAL}', ts) AS window_start, word, count(*) AS cnt
FROM (SELECT ts, unnest({WORDS('event_type')}) AS word FROM events) GROUP BY 1, 2
"""


STREAM_PREVIEW = f"""
WITH lines AS (SELECT doc_id // {S.PREVIEW_DOCS_PER_BUCKET} AS bucket, unnest({LINES('text')}) AS line FROM documents)
SELECT bucket, least(10, count(*)) AS previewed, least(10, count(*)) AS found FROM lines GROUP BY bucket
"""

GBK_SCAN = f"""
SELECT o_orderkey || ',' || substr('{S.TWO_BYTE_CHARS}', CAST(o_orderkey % 4 AS INT) + 1, 1) || ',' || o_orderstatus AS value
FROM orders
"""

ARCHIVE_NAME_FILTER = f"""
WITH {_DOC_ARCHIVE_LINES}
SELECT printf('docs-%06d.zip', g) AS file_name, line_no, value FROM l
WHERE contains('{Q.ARCHIVE_DIGITS}', CAST(g % 10 AS VARCHAR)) AND NOT {BLANK('value')}
"""

FORMAT_NULL_CELLS = """
SELECT CAST(l_orderkey AS VARCHAR) || ',' || coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, 'NULL')
       || ',' || coalesce(CASE WHEN l_tax > 0.04 THEN CAST(l_partkey AS VARCHAR) END, 'NULL') AS value
FROM lineitem
"""

ENCODE_ABSENT_FIELDS = f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(json_object('http_user_agent', event_type) AS VARCHAR) ELSE {REPORT} END AS message
FROM events
"""


UTF16_SCAN = f"""
SELECT o_orderkey || ',' || substr('{S.WIDE_SIGNS}', CAST(o_orderkey % 4 AS INT) + 1, 1) || ',' || o_orderstatus AS value
FROM orders
"""

SPLIT_AUDIT = f"""
SELECT at_most, CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS lines,
       CAST(sum(strlen({LINEITEM_LINE}) + 1) AS BIGINT) AS bytes, true AS bounded
FROM lineitem, (SELECT unnest([{', '.join(map(str, Q.SPLIT_SIZES))}]) AS at_most) GROUP BY ALL
"""

USING_FILE_PRUNE = Q.USING_FILES_SQL.format(
    table=f"""(
  SELECT *, printf('lineitem-%06d.zip', l_orderkey // {S.ORDERS_PER_ARCHIVE}) AS src FROM ({LINEITEM_ROWS})
  WHERE contains('{Q.ARCHIVE_DIGITS}', CAST(l_orderkey // {S.ORDERS_PER_ARCHIVE} % 10 AS VARCHAR))
)"""
)

DELIVERY_REPORT = f"""
WITH records AS (SELECT value, strlen(value) AS bytes FROM ({KAFKA_VALUES}))
SELECT value, count(*) FILTER (bytes <= {Q.RECORD_LIMIT}) AS n_sent, count(*) FILTER (bytes <= {Q.RECORD_LIMIT}) AS n_arrived,
  count(*) FILTER (bytes > {Q.RECORD_LIMIT}) AS n_dead,
  CAST(CASE WHEN bytes <= {Q.RECORD_LIMIT} AND bytes % {Q.RETRIED_BYTES} = 0 THEN 2 ELSE 1 END AS INTEGER) AS attempts,
  CASE WHEN bytes > {Q.RECORD_LIMIT} THEN printf('record of %d bytes, at most {Q.RECORD_LIMIT}', bytes) END AS error
FROM records GROUP BY value, bytes
"""


def oracle_sql() -> dict[str, str]:
    return {
        "word_count": WORD_COUNT,
        "file_word_count": WORD_COUNT,
        "tokenize": TOKENIZE,
        "skip_blank_lines": SKIP_BLANK_LINES,
        "skip_header_lines": SKIP_HEADER_LINES,
        "stop_at_sentinel": STOP_AT_SENTINEL,
        "zip_scan": LINEITEM_ROWS,
        "split_archive_scan": SPLIT_ARCHIVE_SCAN,
        "delimited_scan": LINEITEM_ROWS,
        "external_table_sql": EXTERNAL_TABLE_SQL,
        "multi_file_scan": LINEITEM_ROWS,
        "split_invariant_scan": SPLIT_INVARIANT_SCAN,
        "encoded_scan": ENCODED_SCAN,
        "file_name_filter": FILE_NAME_FILTER,
        "payload_size_filter": PAYLOAD_SIZE_FILTER,
        "split_fields": SPLIT_FIELDS,
        "typed_projection": TYPED_PROJECTION,
        "column_pruning": COLUMN_PRUNING,
        "count_only_scan": COUNT_ONLY_SCAN,
        "format_lines": FORMAT_LINES,
        "delimited_round_trip": LINEITEM_ROWS,
        "materialize_scan": LINEITEM_ROWS,
        "scan_audit": SCAN_AUDIT,
        "archive_audit": ARCHIVE_AUDIT,
        "encode_events": ENCODE_EVENTS,
        "event_envelope": EVENT_ENVELOPE,
        "kafka_values": KAFKA_VALUES,
        "stream_word_count": WORD_COUNT,
        "batched_word_count": BATCHED_WORD_COUNT,
        "interval_word_count": INTERVAL_WORD_COUNT,
        "stream_preview": STREAM_PREVIEW,
        "gbk_scan": GBK_SCAN,
        "archive_name_filter": ARCHIVE_NAME_FILTER,
        "format_null_cells": FORMAT_NULL_CELLS,
        "encode_absent_fields": ENCODE_ABSENT_FIELDS,
        "using_archive_scan": LINEITEM_ROWS,
        "using_file_prune": USING_FILE_PRUNE,
        "using_insert": LINEITEM_ROWS,
        "incremental_copy": LINEITEM_ROWS,
        "utf16_scan": UTF16_SCAN,
        "split_audit": SPLIT_AUDIT,
        "spooled_archive_scan": SPLIT_ARCHIVE_SCAN,
        "archive_stream": SKIP_HEADER_LINES,
        "delivery_report": DELIVERY_REPORT,
    }
