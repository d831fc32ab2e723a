"""The same queries in SQL, parsing the same lines with the plain seven-group pattern."""

from __future__ import annotations

from ..functions.clf import CLF_PATTERN
from .inputs import AGENTS, OFFSETS


def _case(index: str, texts: list[str]) -> str:
    return f"CASE {index} % {len(texts)} " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(texts)) + " END"


# The agents of the test lines, in order, with the classes a person would give them.
_AGENT_CLASSES = [("Chrome", "Desktop"), ("Firefox", "Desktop"), ("Safari", "Mobile"), ("Bot", "Bot"), ("None", "None")]

# Product, version, platform and its version of the same agents, as a person reads them.
_AGENT_DETAILS = [
    "Chrome|120.0.0.0|Windows|10.0|false", "Firefox|121.0|Linux||false", "Safari|17.2|iOS|17.2|false", "ExampleBot|2.1|||true", "||||",
]


def _class(index: int) -> str:
    return _case("user_id", [classes[index] for classes in _AGENT_CLASSES])


_LINES = f"""
requests AS (
  SELECT event_id, ts, user_id, value,
    '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
    '/' || event_type || '/' || (event_id % 20) AS url,
    CASE WHEN event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 500 WHEN 1 THEN 404 ELSE 403 END
         WHEN event_type = 'click' AND event_id % 10 = 0 THEN 304 ELSE 200 END AS status,
    CASE WHEN event_id % 50 = 0 THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS size,
    CASE WHEN user_id % 4 = 0 THEN '-'
         ELSE 'https://Site' || (user_id % 7) || '.example/page/' || (event_id % 10) END AS referrer,
    {_case('user_id', AGENTS)} AS agent,
    {_case('user_id', OFFSETS)} AS zone
  FROM events
),
lines AS (
  SELECT event_id, ts,
    CASE WHEN event_id % 97 = 0 THEN 'corrupt line ' || event_id
    ELSE ip || ' - - [' ||
      CASE WHEN event_id % 101 = 0 THEN 'bad' ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' ' || {{zone}} END ||
      '] "' || method || ' ' || url || ' HTTP/1.1" ' || status || ' ' || size{{tail}} END AS raw_log
  FROM requests
),
fields AS (
  SELECT *, regexp_extract(raw_log, '{CLF_PATTERN}',
      ['ip', 'log_name', 'user_name', 'ts_text', 'request', 'status', 'size']) AS f
  FROM lines
),
matched AS (
  SELECT event_id, ts AS arrived, raw_log, f.ip AS ip, f.log_name AS log_name, f.user_name AS user_name,
    try_strptime(f.ts_text[1:20], '%d/%b/%Y:%H:%M:%S') AS wall_clock,
    f.ts_text[22:26] AS zone,
    coalesce(string_split_regex(f.request, '\\s+')[1], '') AS method,
    coalesce(string_split_regex(f.request, '\\s+')[2], '') AS url,
    coalesce(string_split_regex(f.request, '\\s+')[3], '') AS protocol,
    TRY_CAST(f.status AS INTEGER) AS status_code,
    CASE WHEN f.size = '-' THEN 0 ELSE TRY_CAST(f.size AS BIGINT) END AS content_size,
    nullif(nullif(regexp_extract(raw_log, '"([^"]*)" "([^"]*)"$', 1), ''), '-') AS referrer,
    nullif(nullif(regexp_extract(raw_log, '"([^"]*)" "([^"]*)"$', 2), ''), '-') AS agent
  FROM fields WHERE f.ip <> ''
),
parsed AS (
  SELECT *, wall_clock
      - to_minutes(CAST(zone[1:1] || '1' AS BIGINT) * (60 * CAST(zone[2:3] AS BIGINT) + CAST(zone[4:5] AS BIGINT)))
      AS timestamp
  FROM matched WHERE wall_clock IS NOT NULL
)
"""


def _with(body: str, combined: bool = False, offsets: bool = False) -> str:
    tail = """ || ' "' || referrer || '" "' || agent || '"'""" if combined else ""
    ctes = _LINES.replace("{zone}", "zone" if offsets else "'+0000'").replace("{tail}", tail)
    return f"WITH {ctes.strip()}\n{body.strip()}"


_ERRORS = "SELECT ip, timestamp, url, status_code, method, 'error' AS log_type FROM parsed WHERE status_code >= 400"
_TRAFFIC = """
SELECT date_trunc('minute', timestamp) AS minute, count(*) AS request_count, 'traffic' AS log_type
FROM parsed GROUP BY 1"""
_IPS = """
SELECT time_bucket(INTERVAL '2 minutes', timestamp) AS window_start, ip, count(*) AS request_count,
  'top_ips' AS log_type
FROM parsed GROUP BY 1, 2"""
_URLS = """
SELECT time_bucket(INTERVAL '2 minutes', timestamp) AS window_start, url, count(*) AS request_count,
  'url_analysis' AS log_type
FROM parsed GROUP BY 1, 2"""
_REJECTS = """
SELECT raw_log, 'no_match' AS cause FROM fields WHERE f.ip = ''
UNION ALL SELECT raw_log, 'bad_timestamp' AS cause FROM matched WHERE wall_clock IS NULL"""
_PERCENTILES = """
SELECT status_code, round(quantile_cont(content_size, 0.5), 6) AS p50,
  round(quantile_cont(content_size, 0.9), 6) AS p90, round(quantile_cont(content_size, 0.99), 6) AS p99
FROM parsed GROUP BY 1"""


def _top(key: str, k: int) -> str:
    return f"""
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY request_count DESC, {key}) AS rank, {key}, request_count
  FROM (SELECT {key}, count(*) AS request_count FROM parsed GROUP BY 1)
) WHERE rank <= {k}"""


ORACLE: dict[str, str] = {
    "format_clf": _with("""
SELECT event_id, ip || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "' || method || ' ' || url ||
  ' HTTP/1.1" ' || status || ' ' || size AS raw_log
FROM requests"""),
    "log_files": _with("SELECT raw_log FROM lines"),
    "max_lines": _with("SELECT least(500, count(*)) AS line_count FROM lines"),
    "message_key": _with(r"""
SELECT coalesce(nullif(regexp_extract(raw_log, '^(\d+\.\d+\.\d+\.\d+)', 1), ''), 'unknown') AS key,
  raw_log AS value
FROM lines"""),
    "parse_clf": _with("""
SELECT ip, timestamp, method, url, protocol, status_code, content_size, arrived AS kafka_timestamp, raw_log
FROM parsed"""),
    "buckets": _with("""
SELECT ip, url, timestamp, strftime(timestamp, '%Y-%m-%d %H:00:00') AS hour,
  strftime(timestamp, '%Y-%m-%d %H:%M:00') AS minute
FROM parsed"""),
    "parse_offsets": _with("SELECT event_id, timestamp FROM parsed", offsets=True),
    "parse_wall_clock": _with("SELECT event_id, wall_clock AS timestamp FROM parsed", offsets=True),
    "parse_null_timestamps": _with("""
SELECT event_id, ip, log_name AS remote_log_name, user_name AS remote_user, wall_clock AS timestamp, status_code
FROM matched"""),
    "parse_bad_times_as_now": _with("SELECT event_id, wall_clock IS NULL AS stamped_now FROM matched"),
    "parse_combined": _with("SELECT ip, timestamp, url, referrer, agent FROM parsed", combined=True),
    "rejects": _with(_REJECTS),
    "reject_counts": _with("""
SELECT cause, count(*) AS line_count FROM (
  SELECT 'no_match' AS cause FROM fields WHERE f.ip = ''
  UNION ALL SELECT 'bad_timestamp' AS cause FROM matched WHERE wall_clock IS NULL
) GROUP BY 1"""),
    "reject_fields": _with("""
SELECT event_id, CASE WHEN event_id % 8 = 0 THEN 'bad_timestamp' ELSE 'no_match' END AS cause,
  ['time', 'client', 'log_name', 'user', 'time', 'request', 'status', 'size'][event_id % 8 + 1] AS field,
  CASE event_id % 8 WHEN 0 THEN strpos(raw_log, '[') + 1 WHEN 1 THEN 1 WHEN 2 THEN strpos(raw_log, ' ') WHEN 3 THEN strpos(raw_log, ' ') + 2
    WHEN 4 THEN strpos(raw_log, ' [') WHEN 5 THEN strpos(raw_log, ']') + 1 WHEN 6 THEN strpos(raw_log, '" ') + 1
    ELSE length(regexp_replace(raw_log, ' [^ ]*$', '')) + 1 END AS position
FROM lines WHERE event_id % 97 <> 0 AND (event_id % 8 <> 0 OR event_id % 101 = 0)"""),
    "error_events": _with(_ERRORS),
    "traffic_minute": _with(_TRAFFIC),
    "ip_activity": _with(_IPS),
    "url_activity": _with(_URLS),
    "error_stream": _with(_ERRORS),
    "traffic_stream": _with(_TRAFFIC),
    "ip_stream": _with(_IPS),
    "url_stream": _with(_URLS),
    "rejects_stream": _with(_REJECTS),
    "pipeline_stream": _with(f"""
SELECT 'error_logs' AS analysis, count(*) AS row_count, count(*) AS requests FROM ({_ERRORS})
UNION ALL SELECT 'traffic_by_minute', count(*), sum(request_count)::BIGINT FROM ({_TRAFFIC})
UNION ALL SELECT 'top_ips', count(*), sum(request_count)::BIGINT FROM ({_IPS})
UNION ALL SELECT 'url_analysis', count(*), sum(request_count)::BIGINT FROM ({_URLS})
UNION ALL SELECT 'rejects', count(*), count(*) FROM ({_REJECTS})"""),
    "late_rows": _with("""
SELECT date_trunc('minute', timestamp) AS minute, count(*) AS request_count, 'traffic' AS log_type
FROM parsed, (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events) AS span
WHERE (epoch_us(arrived) - low) // ((high - low) // 3 + 1) >= 1
GROUP BY 1"""),
    "combined_stream": _with(f"""
SELECT 'error_logs' AS analysis, timestamp AS seen_at, ip || ' ' || method || ' ' || url || ' ' || status_code AS key, log_type,
  1::BIGINT AS requests
FROM ({_ERRORS})
UNION ALL SELECT 'traffic_by_minute', minute, '', log_type, request_count FROM ({_TRAFFIC})
UNION ALL SELECT 'top_ips', window_start, ip, log_type, request_count FROM ({_IPS})
UNION ALL SELECT 'url_analysis', window_start, url, log_type, request_count FROM ({_URLS})"""),
    "late_row_counts": _with("""
SELECT analysis, count(*) AS total_rows, count_if(slice = 0)::BIGINT AS total_late_rows, count_if(slice > 0)::BIGINT AS requests
FROM (
  SELECT (epoch_us(arrived) - low) // ((high - low) // 3 + 1) AS slice
  FROM parsed, (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events) AS span
), (VALUES ('traffic_by_minute'), ('top_ips'), ('url_analysis')) AS names(analysis)
GROUP BY analysis"""),
    "paced_stream": _with(_ERRORS),
    "empty_batches": _with("""
SELECT (epoch_us(arrived) - low) // ((high - low) // 3 + 1) AS batch_id, count(*) AS row_count, 2::BIGINT AS last_batch
FROM parsed, (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events) AS span
WHERE status_code >= 400 GROUP BY 1 HAVING batch_id <> 1"""),
    "paced_lines": _with("""
SELECT batch_id, least(size, total - batch_id * size) AS line_count, (SELECT count(*) FROM parsed WHERE status_code >= 400) AS errors
FROM (
  SELECT total, size, unnest(range(0, (total + size - 1) // size)) AS batch_id
  FROM (SELECT count(*) AS total, 1 + count(*) // 10 AS size FROM lines)
)"""),
    "stream_status": _with("""
SELECT 'error_logs' AS name, false AS active, 0::BIGINT AS batch_id, count(*) AS input_rows, 0::BIGINT AS refused_rows,
  0::BIGINT AS stopped
FROM lines"""),
    "live_spikes": _with("""
SELECT window_start, request_count, round(mean, 6) AS baseline, round(mean + 2 * deviation, 6) AS threshold
FROM (
  SELECT window_start, request_count, n, s::DOUBLE / n AS mean, sqrt((q * n - s * s)::DOUBLE) / n AS deviation
  FROM (
    SELECT window_start, request_count, count(*) OVER w AS n, sum(request_count) OVER w AS s,
      sum(request_count * request_count) OVER w AS q
    FROM (SELECT date_trunc('hour', timestamp) AS window_start, count(*) AS request_count FROM parsed GROUP BY 1)
    WINDOW w AS (ORDER BY window_start ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)
  )
) WHERE n >= 24 AND request_count > mean + 2 * deviation
  AND window_start + INTERVAL 62 MINUTE <= (SELECT max(timestamp) FROM parsed)"""),
    "live_spikes_by_url": _with("""
SELECT url, window_start, request_count, round(mean, 6) AS baseline, round(mean + 1.5 * deviation, 6) AS threshold
FROM (
  SELECT url, window_start, request_count, n, s::DOUBLE / n AS mean, sqrt((q * n - s * s)::DOUBLE) / n AS deviation
  FROM (
    SELECT url, window_start, request_count, count(*) OVER w AS n, sum(request_count) OVER w AS s,
      sum(request_count * request_count) OVER w AS q
    FROM (
      SELECT every.url, every.window_start, coalesce(request_count, 0) AS request_count
      FROM (
        SELECT url, unnest(generate_series(min(b), max(b), INTERVAL 6 HOUR)) AS window_start
        FROM (SELECT url, time_bucket(INTERVAL 6 HOUR, timestamp, TIMESTAMP '1970-01-01') AS b FROM parsed) GROUP BY url
      ) AS every LEFT JOIN (
        SELECT url, time_bucket(INTERVAL 6 HOUR, timestamp, TIMESTAMP '1970-01-01') AS window_start, count(*) AS request_count
        FROM parsed GROUP BY 1, 2
      ) AS seen USING (url, window_start)
    )
    WINDOW w AS (PARTITION BY url ORDER BY window_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
  )
) WHERE n >= 8 AND request_count > mean + 1.5 * deviation
  AND window_start + INTERVAL 362 MINUTE <= (SELECT max(timestamp) FROM parsed)"""),
    "live_top_ips": _with(_top("ip", 20)),
    "live_percentiles": _with("""
SELECT status_code, count(content_size) AS value_count, unnest([0.5::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE]) AS percent, true AS within_error
FROM parsed WHERE content_size IS NOT NULL GROUP BY status_code"""),
    "rollup_stream": _with("""
SELECT level, date_trunc(level, timestamp) AS window_start, status_code, count(*) AS request_count
FROM parsed, (SELECT unnest(['minute', 'hour', 'day']) AS level) GROUP BY ALL"""),
    "stored_events": _with("""
SELECT ip, timestamp, method, url, protocol, status_code, content_size, raw_log FROM parsed"""),
    "append_errors": _with(_ERRORS),
    "append_counts": _with("""
SELECT count(*) FILTER (status_code <> 403) AS written, count(*) FILTER (status_code = 403) AS failed,
  count(*) FILTER (status_code <> 403) AS stored, count(*) FILTER (status_code <> 403) AS stamped,
  count(*) FILTER (status_code = 403) AS kept
FROM parsed WHERE status_code >= 400"""),
    "refused_rows": _with("SELECT ip, url, 'forbidden' AS status_code FROM parsed WHERE status_code = 403"),
    "refused_causes": _with(f"""
SELECT 'status_code' AS field, 'forbidden' AS value, 'int' AS expected, count(*) AS row_count
FROM ({_ERRORS}) WHERE status_code = 403 HAVING count(*) > 0"""),
    "document_sink": _with(f"""
SELECT CASE WHEN status_code = 403 THEN 'status 403 is not accepted' ELSE 'taken' END AS reason, status_code, url,
  count(DISTINCT (ip, timestamp, method)) AS documents
FROM ({_ERRORS}) GROUP BY ALL"""),
    "drop_table": _with("""
SELECT count(*) AS rows_before, true AS dropped, false AS dropped_again, 0::BIGINT AS rows_after
FROM parsed WHERE status_code >= 400"""),
    "table_compaction": _with(_TRAFFIC),
    "table_days": _with("""
SELECT date_trunc('minute', timestamp) AS minute, count(*) AS request_count, 'traffic' AS log_type
FROM parsed WHERE CAST(timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-07' GROUP BY 1"""),
    "json_table": _with(_URLS),
    "json_results": _with(_ERRORS),
    "document_ids": _with(f"""
SELECT window_start, ip,
  sha256('{{"window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S') || '.000Z","ip":"' || ip || '"}}')
    AS doc_id
FROM ({_IPS})"""),
    "upsert_latest": _with("""
SELECT ip, url, timestamp, method, status_code, content_size FROM (
  SELECT *, row_number() OVER (
    PARTITION BY ip, url
    ORDER BY status_code >= 400 DESC, timestamp DESC, method DESC, status_code DESC, content_size DESC
  ) AS place FROM parsed
) WHERE place = 1"""),
    "search": _with("""
SELECT timestamp, ip, url, status_code FROM parsed
WHERE status_code = 404 AND starts_with(url, '/error/1')
ORDER BY timestamp DESC, ip, url LIMIT 100"""),
    "search_text": _with("""
SELECT ip, timestamp, url, agent FROM (
  SELECT *, string_split_regex(lower(concat_ws(' ', url, agent)), '[^a-z0-9]+') AS words FROM parsed
) WHERE list_contains(words, 'firefox') AND list_contains(words, 'purchase')""", combined=True),
    "search_text_scripts": _with("""
SELECT ip, timestamp, '/Новости/Café' || url AS url FROM parsed WHERE url LIKE '%5'"""),
    "search_ranked": _with("""
SELECT ip, timestamp, url, agent, round(
    ln(1 + (total - n0 + 0.5) / (n0 + 0.5)) * f0 * 2.2 / (f0 + 1.2 * (0.25 + 0.75 * size / mean))
  + ln(1 + (total - n1 + 0.5) / (n1 + 0.5)) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * size / mean))
  + ln(1 + (total - n2 + 0.5) / (n2 + 0.5)) * f2 * 2.2 / (f2 + 1.2 * (0.25 + 0.75 * size / mean)), 6)::DOUBLE AS score
FROM (
  SELECT *, count(*) OVER ()::DOUBLE AS total, avg(size) OVER () AS mean, count_if(f0 > 0) OVER ()::DOUBLE AS n0,
    count_if(f1 > 0) OVER ()::DOUBLE AS n1, count_if(f2 > 0) OVER ()::DOUBLE AS n2
  FROM (
    SELECT *, len(words)::DOUBLE AS size, len(list_filter(words, lambda w: w = 'firefox'))::DOUBLE AS f0,
      len(list_filter(range(1, len(words)), lambda i: words[i] = 'purchase' AND words[i + 1] = '3'))::DOUBLE AS f1,
      len(list_filter(words, lambda w: w = 'linux'))::DOUBLE AS f2
    FROM (
      SELECT *, list_filter(string_split_regex(lower(concat_ws(' ', url, agent)), '[^a-z0-9]+'), lambda w: w <> '') AS words FROM parsed
    )
  )
) WHERE f0 + f1 + f2 > 0
ORDER BY score DESC, timestamp, ip, url, agent LIMIT 200""", combined=True),
    "table_stats": _with("""
SELECT count(*) AS row_count, min(timestamp) AS first_time, max(timestamp) AS last_time
FROM parsed WHERE status_code >= 400"""),
    "retain": _with("""
SELECT ip, timestamp, url FROM parsed
WHERE timestamp >= TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 10 DAY"""),
    "traffic_hour": _with("""
SELECT date_trunc('hour', timestamp) AS hour, count(*) AS request_count, 'traffic' AS log_type
FROM parsed GROUP BY 1"""),
    "request_rate": _with("""
SELECT date_trunc('minute', timestamp) AS window_start, count(*) AS request_count,
  round(count(*) / 60.0::DOUBLE, 6) AS requests_per_second
FROM parsed GROUP BY 1"""),
    "status_distribution": _with("""
SELECT status_code, count(*) AS request_count,
  round(count(*)::DOUBLE / sum(count(*)) OVER (), 4) AS share
FROM parsed GROUP BY 1"""),
    "error_trend": _with("""
SELECT date_trunc('hour', timestamp) AS window_start, status_code, count(*) AS request_count
FROM parsed WHERE status_code >= 400 GROUP BY 1, 2"""),
    "top_ips": _with(_top("ip", 20)),
    "top_urls": _with(_top("url", 20)),
    "top_urls_daily": _with("""
SELECT * FROM (
  SELECT window_start, row_number() OVER (PARTITION BY window_start ORDER BY request_count DESC, url) AS rank,
    url, request_count
  FROM (SELECT date_trunc('day', timestamp)::TIMESTAMP AS window_start, url, count(*) AS request_count
        FROM parsed GROUP BY 1, 2)
) WHERE rank <= 5"""),
    "heat_map": _with("""
SELECT CAST(dayofweek(timestamp) + 1 AS INTEGER) AS weekday, CAST(hour(timestamp) AS INTEGER) AS hour_of_day,
  count(*) AS request_count
FROM parsed GROUP BY 1, 2"""),
    "agent_stats": _with(f"""
SELECT {_class(0)} AS browser, {_class(1)} AS device, count(*) AS request_count
FROM parsed JOIN requests USING (event_id) GROUP BY 1, 2""", combined=True),
    "product_stats": _with(f"""
SELECT nullif(d[1], '') AS product, nullif(d[2], '') AS version, nullif(d[3], '') AS platform,
  nullif(d[4], '') AS platform_version, CAST(nullif(d[5], '') AS BOOLEAN) AS bot, count(*) AS request_count
FROM (
  SELECT string_split({_case('user_id', _AGENT_DETAILS)}, '|') AS d FROM parsed JOIN requests USING (event_id)
) GROUP BY 1, 2, 3, 4, 5""", combined=True),
    "referrer_stats": _with("""
SELECT lower(regexp_extract(referrer, '^https://([^/]+)', 1)) AS referrer_host, count(*) AS request_count
FROM parsed GROUP BY 1""", combined=True),
    "spikes": _with("""
SELECT window_start, request_count, round(mean, 6) AS baseline, round(mean + 2 * deviation, 6) AS threshold
FROM (
  SELECT window_start, request_count, n, s::DOUBLE / n AS mean, sqrt((q * n - s * s)::DOUBLE) / n AS deviation
  FROM (
    SELECT window_start, request_count, count(*) OVER w AS n, sum(request_count) OVER w AS s,
      sum(request_count * request_count) OVER w AS q
    FROM (SELECT date_trunc('hour', timestamp) AS window_start, count(*) AS request_count FROM parsed GROUP BY 1)
    WINDOW w AS (ORDER BY window_start ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)
  )
) WHERE n >= 24 AND request_count > mean + 2 * deviation"""),
    "spikes_with_gaps": _with("""
SELECT window_start, request_count, round(mean, 6) AS baseline, round(mean + 3 * deviation, 6) AS threshold
FROM (
  SELECT window_start, request_count, n, s::DOUBLE / n AS mean, sqrt((q * n - s * s)::DOUBLE) / n AS deviation
  FROM (
    SELECT window_start, request_count, count(*) OVER w AS n, sum(request_count) OVER w AS s,
      sum(request_count * request_count) OVER w AS q
    FROM (
      SELECT minute AS window_start, coalesce(request_count, 0) AS request_count
      FROM (SELECT unnest(generate_series(min(date_trunc('minute', timestamp)), max(date_trunc('minute', timestamp)),
              INTERVAL 1 MINUTE)) AS minute FROM parsed)
      LEFT JOIN (SELECT date_trunc('minute', timestamp) AS minute, count(*) AS request_count FROM parsed GROUP BY 1)
        USING (minute)
    )
    WINDOW w AS (ORDER BY window_start ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
  )
) WHERE n >= 30 AND request_count > mean + 3 * deviation"""),
    "value_percentiles": _with(_PERCENTILES),
    "value_percentiles_by_cell": _with(_PERCENTILES),
    "locate": _with("""
SELECT ip, timestamp, url, n_name AS place
FROM (
  SELECT *, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
    + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS address
  FROM parsed
) LEFT JOIN nation ON address BETWEEN 167772160 + n_nationkey * 6 AND 167772160 + n_nationkey * 6 + 5"""),
    "locate_networks": _with("""
SELECT ip, timestamp, url, client, CASE
    WHEN page % 2 = 1 THEN coalesce(r_name, CASE WHEN part % 2 = 0 THEN inside.n_name END, 'documentation')
    ELSE coalesce(of_eight.n_name, 'private') END AS place
FROM (
  SELECT *, person % 25 AS part, CASE WHEN page % 2 = 1 THEN '2001:DB8:' || to_hex(person % 25) || '::' || to_hex(person)
    WHEN page % 10 = 0 THEN '::ffff:' || ip ELSE ip END AS client
  FROM (
    SELECT *, CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS person,
      CAST(regexp_extract(url, '[0-9]+$') AS BIGINT) AS page
    FROM parsed
  )
)
LEFT JOIN region ON r_regionkey * 2 = part AND person < 16
LEFT JOIN nation AS inside ON inside.n_nationkey = part
LEFT JOIN nation AS of_eight ON person BETWEEN of_eight.n_nationkey * 8 AND of_eight.n_nationkey * 8 + 7"""),
}
