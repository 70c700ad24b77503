"""The same queries as plain SQL, to check Spark's results against another engine.

The SQL is written from the definitions of the tables and shares no expression
with the Spark code.  Literals carry ``e0`` to stay in DOUBLE.
"""

from __future__ import annotations

_CTES = {
    "injected": (
        (),
        """
        SELECT *, CASE event_type
                 WHEN 'purchase' THEN 0.01e0 + x * x * (3 - 2 * x) * (0.35e0 - 0.01e0)
                 WHEN 'click' THEN 0.005e0
                 WHEN 'view' THEN 0.02e0
                 ELSE 0.01e0 END AS rate
        FROM (SELECT event_id AS sequence, user_id AS user_number, event_type, value,
                     event_id * 50 AS elapsed_ms,
                     greatest(0.0e0, least(1.0e0, (event_id * 50 - 90000.0e0) / 180000.0e0)) AS x,
                     (event_id * 7919 + user_id * 104729) % 10000 AS u,
                     (event_id * 131 + user_id * 17) % 6 AS m
              FROM events)
        """,
    ),
    "moded": (
        ("injected",),
        "SELECT *, CAST(CASE WHEN u < rate * 10000 THEN m ELSE -1 END AS INTEGER) AS mode FROM injected",
    ),
    "raw": (
        ("moded",),
        """
        SELECT CASE WHEN mode <> 4 THEN 'e-' || sequence END AS event_id,
               event_type AS source,
               CASE WHEN mode = 1 THEN
                      CASE sequence % 3 WHEN 0 THEN -50e0 WHEN 1 THEN 250000e0 ELSE 999999e0 END
                    ELSE value END AS amount,
               CASE WHEN mode = 2 THEN
                      CASE sequence % 5 WHEN 0 THEN 'usd' WHEN 1 THEN 'BTC' WHEN 2 THEN 'XYZ' WHEN 3 THEN ''
                                        ELSE 'US' END
                    ELSE CASE (sequence + user_number) % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
                                        WHEN 3 THEN 'JPY' ELSE 'INR' END END AS currency,
               CASE WHEN mode <> 0 THEN 'u-' || user_number END AS user_id,
               CASE WHEN mode = 3 THEN
                      CASE sequence % 3 WHEN 0 THEN 'not-a-date' WHEN 1 THEN '13/45/2026' ELSE '' END
                    ELSE strftime(make_timestamp((1704067200000 + elapsed_ms
                                     - CASE WHEN mode = 5 THEN 1200000 ELSE 0 END) * 1000),
                                  '%Y-%m-%dT%H:%M:%S.%gZ') END AS event_ts,
               make_timestamp((1704067200000 + elapsed_ms) * 1000) AS received_time,
               sequence, mode
        FROM moded
        """,
    ),
    "checked": (
        ("raw",),
        """
        SELECT *,
               concat_ws(',', CASE WHEN v_missing_id THEN 'MISSING_EVENT_ID' END,
                              CASE WHEN v_missing_user THEN 'MISSING_USER_ID' END,
                              CASE WHEN v_amount_range THEN 'AMOUNT_OUT_OF_RANGE' END,
                              CASE WHEN v_bad_currency THEN 'INVALID_CURRENCY' END,
                              CASE WHEN v_bad_timestamp THEN 'MALFORMED_TIMESTAMP' END,
                              CASE WHEN v_stale THEN 'STALE_EVENT' END) AS violations
        FROM (SELECT *,
                     coalesce(event_id, '') = '' AS v_missing_id,
                     coalesce(user_id, '') = '' AS v_missing_user,
                     NOT coalesce(amount BETWEEN 0 AND 100000, false) AS v_amount_range,
                     coalesce(currency, '') NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'INR') AS v_bad_currency,
                     parsed_event_ts IS NULL AS v_bad_timestamp,
                     coalesce(freshness_sec > 300, false) AS v_stale
              FROM (SELECT *, CAST(trunc((epoch_us(received_time) - epoch_us(parsed_event_ts)) / 1000000e0)
                                   AS BIGINT) AS freshness_sec
                    FROM (SELECT *, try_cast(replace(event_ts, 'Z', '') AS TIMESTAMP) AS parsed_event_ts
                          FROM raw)))
        """,
    ),
    "verdict": (("checked",), "SELECT *, violations = '' AS is_valid FROM checked"),
    "metrics": (
        ("verdict",),
        """
        SELECT *, CAST(floor((20000 * bad_events + total_events) / (2e0 * total_events)) AS BIGINT) AS bp
        FROM (SELECT source,
                     time_bucket(INTERVAL '10 seconds', received_time) AS window_start,
                     time_bucket(INTERVAL '10 seconds', received_time) + INTERVAL '10 seconds' AS window_end,
                     count(*) AS total_events,
                     count(*) FILTER (NOT is_valid) AS bad_events,
                     count(*) FILTER (v_missing_id) AS cnt_missing_id,
                     count(*) FILTER (v_missing_user) AS cnt_missing_user,
                     count(*) FILTER (v_amount_range) AS cnt_amount_range,
                     count(*) FILTER (v_bad_currency) AS cnt_bad_currency,
                     count(*) FILTER (v_bad_timestamp) AS cnt_bad_timestamp,
                     count(*) FILTER (v_stale) AS cnt_stale,
                     round(avg(CAST(freshness_sec AS DOUBLE)), 1) AS avg_freshness_sec
              FROM verdict GROUP BY ALL)
        """,
    ),
    "trained": (
        ("metrics",),
        """
        SELECT *,
               CASE WHEN m >= 8 THEN
                 floor((2 * num + m * d) / (2e0 * m * d)) / 100e0 END AS forecast
        FROM (SELECT *, sy * d + (m * sjy - sj * sy) * (m * (m + 1) - sj) AS num
              FROM (SELECT *, m * (m + 1) // 2 AS sj, m * m * (m * m - 1) // 12 AS d,
                           skbp - (k - m) * sy AS sjy
                    FROM (SELECT *, CAST(count(*) OVER f AS BIGINT) AS m, CAST(sum(bp) OVER f AS BIGINT) AS sy,
                                 CAST(sum(k * bp) OVER f AS BIGINT) AS skbp
                          FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY window_start) AS k
                                FROM metrics)
                          WINDOW f AS (PARTITION BY source ORDER BY window_start
                                       ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))))
        """,
    ),
    "damped": (
        ("metrics",),
        """
        SELECT *, greatest(0, least(10000, floor((2 * s + c * (bp - b0) + c) / (2e0 * c)))) / 100e0 AS forecast
        FROM (SELECT *, count(*) OVER f AS c, CAST(sum(bp) OVER f AS BIGINT) AS s, first(bp) OVER f AS b0
              FROM metrics
              WINDOW f AS (PARTITION BY source ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
        """,
    ),
    "alerts": (
        ("trained",),
        """
        SELECT *, CASE WHEN cur >= 2.0e0 THEN 0.0e0
                       WHEN slope > 0.01e0 THEN ((2.0e0 - cur) / slope) * (10e0 / 60e0) END AS eta,
               CASE WHEN cur >= 2.0e0 THEN 'BREACH'
                    WHEN forecast >= 2.0e0 THEN 'WATCH'
                    WHEN slope > 0.01e0 AND ((2.0e0 - cur) / slope) * (10e0 / 60e0) < 5 THEN 'WATCH'
                    ELSE 'OK' END AS status,
               CASE WHEN most = 0 THEN 'NONE'
                    WHEN cnt_bad_currency = most THEN 'INVALID_CURRENCY'
                    WHEN cnt_amount_range = most THEN 'AMOUNT_OUT_OF_RANGE'
                    WHEN cnt_missing_user = most THEN 'MISSING_USER_ID'
                    WHEN cnt_bad_timestamp = most THEN 'MALFORMED_TIMESTAMP'
                    WHEN cnt_stale = most THEN 'STALE_EVENT'
                    ELSE 'MISSING_EVENT_ID' END AS top_reason,
               CASE WHEN cnt_bad_currency > 0 THEN 'INVALID_CURRENCY'
                    WHEN cnt_amount_range > 0 THEN 'AMOUNT_OUT_OF_RANGE'
                    WHEN cnt_missing_user > 0 THEN 'MISSING_USER_ID'
                    WHEN cnt_bad_timestamp > 0 THEN 'MALFORMED_TIMESTAMP'
                    WHEN cnt_stale > 0 THEN 'STALE_EVENT'
                    WHEN cnt_missing_id > 0 THEN 'MISSING_EVENT_ID'
                    ELSE 'NONE' END AS simple_reason,
               CASE WHEN cur >= 2.0e0 THEN 'BREACH' WHEN forecast >= 2.0e0 THEN 'WATCH' ELSE 'OK' END
                 AS simple_status
        FROM (SELECT *, bp / 100e0 AS cur, forecast - bp / 100e0 AS slope,
                     greatest(cnt_missing_id, cnt_missing_user, cnt_amount_range, cnt_bad_currency,
                              cnt_bad_timestamp, cnt_stale) AS most
              FROM trained)
        """,
    ),
    "served_events": (
        ("verdict",),
        """
        SELECT *, time_bucket(INTERVAL '10 seconds', received_time) AS window_start
        FROM verdict
        """,
    ),
    "blanked_events": (
        ("verdict",),
        """
        SELECT * REPLACE (CASE WHEN sequence % 11 IN (0, 1) THEN 'unknown' ELSE source END AS source),
               time_bucket(INTERVAL '10 seconds', received_time) AS window_start
        FROM verdict
        """,
    ),
}

_CTES["arrived"] = (
    ("raw",),
    """
    SELECT * REPLACE (CASE WHEN sequence % 1000 <> 500 THEN received_time END AS received_time),
           CASE WHEN sequence * 2 < last AND sequence % 100 = 7 THEN 3
                ELSE least(3, sequence * 4 // (last + 1)) END AS part
    FROM raw, (SELECT max(sequence) AS last FROM raw)
    """,
)
_CTES["judged_again"] = (
    ("checked",),
    """
    SELECT *, concat_ws(',', CASE WHEN no_id THEN 'NO_ID' END, CASE WHEN bad_amount THEN 'AMOUNT' END,
                        CASE WHEN foreign_money THEN 'FOREIGN' END, CASE WHEN v_bad_timestamp THEN 'NO_TIME' END,
                        CASE WHEN old THEN 'OLD' END) AS found
    FROM (SELECT *, v_missing_id AS no_id, NOT coalesce(amount BETWEEN 1 AND 150, false) AS bad_amount,
                 coalesce(currency, '') NOT IN ('EUR', 'USD') AS foreign_money, coalesce(freshness_sec > 60, false) AS old
          FROM checked)
    """,
)
_CTES["lateness"] = (
    ("arrived",),
    """
    SELECT a.*, coalesce(time_bucket(INTERVAL '10 seconds', a.received_time) + INTERVAL '10 seconds'
                         <= (SELECT max(b.received_time) FROM arrived b WHERE b.part < a.part) - INTERVAL '10 seconds',
                         false) AS late
    FROM arrived a
    """,
)
# Starts of windows, one step of the recursion after the other.
_CTES["anchors"] = (
    ("verdict",),
    """
    SELECT source, min(received_time) AS start FROM verdict GROUP BY source
    UNION ALL
    SELECT a.source, min(v.received_time) FROM anchors a
    JOIN verdict v ON v.source = a.source AND v.received_time >= a.start + INTERVAL '10 seconds'
    GROUP BY a.source
    """,
)
_CTES["anchored"] = (
    ("anchors", "verdict"),
    """
    SELECT v.source, max(a.start) OVER (PARTITION BY v.source, v.sequence) AS start, v.* EXCLUDE (source)
    FROM verdict v JOIN anchors a ON a.source = v.source AND a.start <= v.received_time
    QUALIFY row_number() OVER (PARTITION BY v.sequence ORDER BY a.start DESC) = 1
    """,
)

_ALERT_SELECT = """
SELECT source, epoch_ms(window_end) AS ts, total_events, cur AS current_error_pct,
       forecast AS forecast_error_pct, forecast AS forecast_upper_pct, slope AS error_rate_slope,
       2.0e0 AS sla_pct, eta AS minutes_to_sla_breach, status, top_reason
FROM alerts WHERE forecast IS NOT NULL
"""

_METRIC_SELECT = """
SELECT source, epoch_ms(window_start) AS window_start, epoch_ms(window_end) AS window_end,
       epoch_ms(window_end) - 1 AS window_time, total_events, bad_events, bp / 100e0 AS error_rate_pct,
       cnt_missing_id, cnt_missing_user, cnt_amount_range, cnt_bad_currency, cnt_bad_timestamp, cnt_stale,
       avg_freshness_sec
FROM metrics
"""

_EVENT = "event_id, source, amount, currency, user_id"


def _add_serving(events: str, prefix: str) -> None:
    """The serving pipeline over one flavour of judged events."""
    _CTES[f"{prefix}_reason"] = (
        (events,),
        f"""
        SELECT source, window_start, code FROM (
          SELECT *, row_number() OVER (PARTITION BY source, window_start
                                       ORDER BY n DESC, seen, list_position(
                                         ['MISSING_EVENT_ID', 'MISSING_USER_ID', 'AMOUNT_OUT_OF_RANGE',
                                          'INVALID_CURRENCY', 'MALFORMED_TIMESTAMP', 'STALE_EVENT'], code)) AS place
          FROM (SELECT source, window_start, code, count(*) AS n, min(received_time) AS seen
                FROM (SELECT source, window_start, received_time, unnest(string_split(violations, ',')) AS code
                      FROM {events} WHERE NOT is_valid)
                GROUP BY ALL))
        WHERE place = 1
        """,
    )
    _CTES[f"{prefix}_rates"] = (
        (events,),
        f"""
        SELECT *, CAST(floor((20000 * bad + total_events) / (2e0 * total_events)) AS BIGINT) AS bp
        FROM (SELECT source, window_start, count(*) AS total_events, count(*) FILTER (NOT is_valid) AS bad
              FROM {events} GROUP BY ALL)
        """,
    )
    _CTES[f"{prefix}_alerts"] = (
        (f"{prefix}_rates", f"{prefix}_reason"),
        f"""
        SELECT source, window_start, epoch_ms(window_start) + 10000 AS ts, total_events, cur AS current_error_pct,
               forecast AS forecast_error_pct, forecast AS forecast_upper_pct,
               CASE WHEN cur >= 2.0e0 THEN 0.0e0
                    WHEN forecast > cur THEN ((2.0e0 - cur) / (forecast - cur)) * (10e0 / 60e0)
                    END AS minutes_to_sla_breach,
               CASE WHEN cur >= 2.0e0 THEN 'BREACH' WHEN forecast >= 2.0e0 THEN 'WATCH' ELSE 'OK' END AS status,
               coalesce(code, 'NONE') AS top_reason,
               row_number() OVER (PARTITION BY source ORDER BY window_start DESC) AS nth
        FROM (SELECT *, bp / 100e0 AS cur,
                     greatest(0, least(10000, floor((2 * s + c * (bp - b0) + c) / (2e0 * c)))) / 100e0 AS forecast
              FROM (SELECT *, count(*) OVER f AS c, CAST(sum(bp) OVER f AS BIGINT) AS s, first(bp) OVER f AS b0
                    FROM {prefix}_rates
                    WINDOW f AS (PARTITION BY source ORDER BY window_start
                                 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)))
        LEFT JOIN {prefix}_reason USING (source, window_start)
        """,
    )


_add_serving("served_events", "serving")
_add_serving("blanked_events", "blanked")

_SERVING_COLUMNS = (
    "source, ts, total_events, current_error_pct, forecast_error_pct, forecast_upper_pct,"
    " minutes_to_sla_breach, status, top_reason"
)
_CTES["board"] = (
    ("serving_alerts",),
    f"""
    SELECT {_SERVING_COLUMNS},
           CASE status WHEN 'BREACH' THEN 0 WHEN 'WATCH' THEN 1 WHEN 'OK' THEN 2 ELSE 3 END AS severity
    FROM serving_alerts WHERE nth = 1
    """,
)
_CTES["worst_history"] = (
    ("board", "serving_alerts"),
    """
    SELECT source, ts, current_error_pct AS current, forecast_error_pct AS forecast, forecast_upper_pct AS upper
    FROM serving_alerts
    WHERE nth <= 40 AND source = (SELECT source FROM board
                                  ORDER BY severity, minutes_to_sla_breach NULLS LAST, source LIMIT 1)
    """,
)
_CTES["feed"] = (
    ("verdict",),
    """
    SELECT * FROM (
      SELECT CAST(row_number() OVER (ORDER BY received_time DESC) AS INTEGER) AS rank,
             source, event_id, violations, received_time
      FROM verdict WHERE NOT is_valid) WHERE rank <= 50
    """,
)

_FINAL: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_events": (
        ("raw",),
        f"SELECT {_EVENT}, event_ts, epoch_ms(received_time) AS received_time, sequence, mode FROM raw",
    ),
    "inject_rate": (
        ("moded",),
        "SELECT sequence AS event_id, event_type AS source, elapsed_ms, rate, mode FROM moded",
    ),
    "wire_decode": (
        ("raw",),
        """
        SELECT sequence, epoch_ms(received_time) AS received_time,
               CASE WHEN whole THEN event_id END AS event_id, CASE WHEN whole THEN source END AS source,
               CASE WHEN whole THEN amount END AS amount, CASE WHEN whole THEN currency END AS currency,
               CASE WHEN whole THEN user_id END AS user_id, CASE WHEN whole THEN event_ts END AS event_ts,
               CASE WHEN whole THEN 'decoded' ELSE 'corrupt' END AS wire_state
        FROM (SELECT *, sequence % 50 <> 7 AS whole FROM raw)
        """,
    ),
    "events_checked": (
        ("checked",),
        f"""
        SELECT {_EVENT}, event_ts, epoch_ms(received_time) AS received_time, sequence,
               epoch_ms(parsed_event_ts) AS parsed_event_ts, freshness_sec, v_missing_id, v_missing_user,
               v_amount_range, v_bad_currency, v_bad_timestamp, v_stale, violations
        FROM checked
        """,
    ),
    "violations": (("checked",), "SELECT sequence, mode, violations FROM checked"),
    "events_verdict": (("verdict",), f"SELECT sequence, {_EVENT}, event_ts, violations, is_valid FROM verdict"),
    "clean_events": (
        ("verdict",),
        f"SELECT {_EVENT}, epoch_ms(parsed_event_ts) AS event_time FROM verdict WHERE is_valid",
    ),
    "quarantine_events": (
        ("verdict",),
        f"""
        SELECT {_EVENT}, event_ts AS raw_event_ts, violations, epoch_ms(received_time) AS quarantined_at
        FROM verdict WHERE NOT is_valid
        """,
    ),
    "route_counts": (
        ("verdict",),
        """
        SELECT 'clean_events' AS lane, count(*) FILTER (is_valid) AS rows FROM verdict
        UNION ALL SELECT 'quarantine_events', count(*) FILTER (NOT is_valid) FROM verdict
        """,
    ),
    "dq_metrics": (("metrics",), _METRIC_SELECT),
    "reason_counts": (
        ("verdict",),
        """
        SELECT source, epoch_ms(w) AS window_start, epoch_ms(w) + 10000 AS window_end, reason, count(*) AS n
        FROM (SELECT source, time_bucket(INTERVAL '10 seconds', received_time) AS w,
                     unnest(string_split(violations, ',')) AS reason
              FROM verdict WHERE NOT is_valid)
        GROUP BY source, w, reason
        """,
    ),
    "top_reason_full": (
        ("alerts",),
        """
        SELECT source, epoch_ms(window_start) AS window_start, epoch_ms(window_end) AS window_end, top_reason
        FROM alerts
        """,
    ),
    "top_reason_simple": (
        ("alerts",),
        """
        SELECT source, epoch_ms(window_start) AS window_start, epoch_ms(window_end) AS window_end,
               simple_reason AS top_reason
        FROM alerts
        """,
    ),
    "top_reason_serving": (
        ("serving_alerts",),
        "SELECT source, ts - 10000 AS window_start, ts AS window_end, top_reason FROM serving_alerts",
    ),
    "forecast_damped": (
        ("damped",),
        """
        SELECT source, epoch_ms(window_start) AS window_start, epoch_ms(window_end) AS window_end,
               bp / 100e0 AS error_rate_pct, forecast AS forecast_error_pct
        FROM damped
        """,
    ),
    "forecast_trend": (
        ("trained",),
        """
        SELECT source, epoch_ms(window_start) AS window_start, epoch_ms(window_end) AS window_end,
               bp / 100e0 AS error_rate_pct, forecast AS forecast_error_pct
        FROM trained
        """,
    ),
    "dq_alerts": (("alerts",), _ALERT_SELECT),
    "dq_alerts_simple": (
        ("alerts",),
        """
        SELECT source, epoch_ms(window_end) AS ts, total_events, cur AS current_error_pct,
               forecast AS forecast_error_pct, simple_status AS status, simple_reason AS top_reason
        FROM alerts WHERE forecast IS NOT NULL
        """,
    ),
    "serving_alerts": (("serving_alerts",), f"SELECT {_SERVING_COLUMNS} FROM serving_alerts"),
    "serving_windows": (("blanked_alerts",), f"SELECT {_SERVING_COLUMNS} FROM blanked_alerts"),
    "source_health": (
        ("alerts",),
        """
        SELECT source, status, cur AS current_error_pct, forecast AS forecast_error_pct,
               floor(eta * 10e0 + 0.5e0) / 10e0 AS eta_min, top_reason
        FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY window_end DESC) AS nth
              FROM alerts WHERE forecast IS NOT NULL)
        WHERE nth = 1
        """,
    ),
    "source_history": (
        ("serving_alerts",),
        """
        SELECT source, ts, current_error_pct AS current, forecast_error_pct AS forecast,
               forecast_upper_pct AS upper
        FROM serving_alerts WHERE nth <= 40
        """,
    ),
    "latest_raw": (
        ("raw",),
        f"""
        SELECT * FROM (
          SELECT {_EVENT}, event_ts, epoch_ms(received_time) AS received,
                 CAST(row_number() OVER (ORDER BY received_time DESC) AS INTEGER) AS rank FROM raw)
        WHERE rank <= 20
        """,
    ),
    "latest_verdicts": (
        ("verdict",),
        """
        SELECT * FROM (
          SELECT CAST(row_number() OVER (ORDER BY received_time DESC) AS INTEGER) AS rank, source, event_id,
                 amount, currency, is_valid, violations, epoch_ms(received_time) AS received_time FROM verdict)
        WHERE rank <= 25
        """,
    ),
    "latest_quarantine": (
        ("feed",),
        """
        SELECT rank, source, event_id, violations, epoch_ms(received_time) AS quarantined_at
        FROM feed WHERE rank <= 25
        """,
    ),
    "latest_metrics": (
        ("metrics",),
        """
        SELECT * FROM (
          SELECT source, total_events, bad_events, bp / 100e0 AS error_rate_pct, avg_freshness_sec,
                 epoch_ms(window_end) AS window_end,
                 CAST(row_number() OVER (ORDER BY window_end DESC, source) AS INTEGER) AS rank FROM metrics)
        WHERE rank <= 25
        """,
    ),
    "dlq_feed": (
        ("feed",),
        "SELECT rank, source, event_id, violations, epoch_ms(received_time) AS at FROM feed",
    ),
    "dlq_report": (
        ("feed",),
        """
        SELECT rank, strftime(received_time, '%H:%M:%S') AS time, coalesce(source, '—') AS source,
               coalesce(event_id, 'null') AS event_id, replace(violations, ',', ' ') AS failed_rules
        FROM feed
        """,
    ),
    "health_board": (("board",), "SELECT * FROM board"),
    "health_report": (
        ("board",),
        """
        SELECT source, status, printf('%.2f%%', current_error_pct) AS error_rate,
               printf('%.2f%%', forecast_error_pct) AS forecast,
               CASE WHEN minutes_to_sla_breach IS NULL THEN '—'
                    WHEN minutes_to_sla_breach <= 0 THEN 'now'
                    WHEN minutes_to_sla_breach < 1
                      THEN CAST(CAST(floor(minutes_to_sla_breach * 60e0 + 0.5e0) AS BIGINT) AS VARCHAR) || 's'
                    ELSE printf('%.1f min', floor(minutes_to_sla_breach * 10e0 + 0.5e0) / 10e0)
                    END AS time_to_breach,
               CAST(total_events AS VARCHAR) AS events_per_window,
               nullif(top_reason, 'NONE') AS top_failure_mode, severity
        FROM board
        """,
    ),
    "status_counts": (
        ("board",),
        """
        SELECT count(*) FILTER (status = 'BREACH') AS breaching, count(*) FILTER (status = 'WATCH') AS watching
        FROM board
        """,
    ),
    "worst_source_history": (("worst_history",), "SELECT * FROM worst_history"),
    "chart_bounds": (
        ("worst_history",),
        """
        SELECT data_max, points, CASE WHEN data_max <= 10 THEN 10e0 ELSE ceil(data_max / 10e0) * 10e0 END AS axis_max
        FROM (SELECT greatest(4.0e0, max(current), max(forecast)) AS data_max, count(*) AS points FROM worst_history)
        """,
    ),
    "alerts_reload": (
        ("alerts",),
        """
        SELECT source, epoch_ms(window_end) AS ts,
               CASE WHEN total_events % 7 = 0 THEN 0e0 ELSE cur END AS current,
               CASE WHEN total_events % 5 = 0 THEN 0e0 ELSE forecast END AS forecast,
               CASE WHEN total_events % 3 = 0 THEN 0e0 ELSE forecast END AS upper
        FROM alerts WHERE forecast IS NOT NULL AND total_events % 13 NOT IN (0, 1)
        """,
    ),
    "quarantine_reload": (
        ("verdict",),
        """
        SELECT source, event_id, CASE WHEN event_id IS NULL THEN '' ELSE violations END AS violations,
               epoch_ms(received_time) AS at
        FROM verdict WHERE NOT is_valid
        """,
    ),
    "stored_alerts": (("alerts",), _ALERT_SELECT),
    "batched_alerts": (("alerts",), _ALERT_SELECT),
    "committed_alerts": (("alerts",), _ALERT_SELECT),
    "batched_serving_alerts": (("blanked_alerts",), f"SELECT {_SERVING_COLUMNS} FROM blanked_alerts"),
    "stored_serving_alerts": (("blanked_alerts",), f"SELECT {_SERVING_COLUMNS} FROM blanked_alerts"),
    "stream_route": (
        ("verdict",),
        f"""
        SELECT CASE WHEN is_valid THEN 'clean_events' ELSE 'quarantine_events' END AS lane, {_EVENT},
               epoch_ms(CASE WHEN is_valid THEN parsed_event_ts ELSE received_time END) AS time_ms, violations
        FROM verdict
        """,
    ),
    "stream_metrics": (("metrics",), _METRIC_SELECT),
    "stream_alerts": (("alerts",), _ALERT_SELECT),
    "stream_serving_alerts": (
        ("serving_alerts",),
        f"SELECT {_SERVING_COLUMNS} FROM serving_alerts",
    ),
    "late_events": (
        ("lateness",),
        """
        SELECT event_id, source, amount, currency, user_id, event_ts, epoch_ms(received_time) AS received_time, late
        FROM lateness WHERE late OR received_time IS NULL
        """,
    ),
    "event_totals": (
        ("lateness",),
        """
        SELECT count(*) AS events, count(*) FILTER (NOT late AND received_time IS NOT NULL) AS counted,
               count(*) FILTER (late) AS late, count(*) FILTER (received_time IS NULL) AS timeless,
               count(*) FILTER (NOT late AND received_time IS NOT NULL) AS in_windows
        FROM lateness
        """,
    ),
    "anchored_windows": (
        ("anchored",),
        """
        SELECT source, epoch_ms(start) AS window_start, epoch_ms(start + INTERVAL '10 seconds') AS window_end,
               total_events, bad_events, floor((20000 * bad_events + total_events) / (2e0 * total_events)) / 100e0 AS error_rate_pct,
               cnt_missing_id, cnt_missing_user, cnt_amount_range, cnt_bad_currency, cnt_bad_timestamp, cnt_stale, avg_freshness_sec
        FROM (SELECT source, start, count(*) AS total_events, count(*) FILTER (NOT is_valid) AS bad_events,
                     count(*) FILTER (v_missing_id) AS cnt_missing_id, count(*) FILTER (v_missing_user) AS cnt_missing_user,
                     count(*) FILTER (v_amount_range) AS cnt_amount_range, count(*) FILTER (v_bad_currency) AS cnt_bad_currency,
                     count(*) FILTER (v_bad_timestamp) AS cnt_bad_timestamp, count(*) FILTER (v_stale) AS cnt_stale,
                     round(avg(CAST(freshness_sec AS DOUBLE)), 1) AS avg_freshness_sec
              FROM anchored GROUP BY ALL)
        """,
    ),
    "contract_metrics": (
        ("judged_again",),
        """
        SELECT source, epoch_ms(window_start) AS window_start, epoch_ms(window_start) + 10000 AS window_end, total_events, bad_events,
               floor((20000 * bad_events + total_events) / (2e0 * total_events)) / 100e0 AS error_rate_pct,
               cnt_no_id, cnt_amount, cnt_foreign, cnt_no_time, cnt_old
        FROM (SELECT source, time_bucket(INTERVAL '10 seconds', received_time) AS window_start, count(*) AS total_events,
                     count(*) FILTER (found <> '') AS bad_events, count(*) FILTER (no_id) AS cnt_no_id,
                     count(*) FILTER (bad_amount) AS cnt_amount, count(*) FILTER (foreign_money) AS cnt_foreign,
                     count(*) FILTER (v_bad_timestamp) AS cnt_no_time, count(*) FILTER (old) AS cnt_old
              FROM judged_again GROUP BY ALL)
        """,
    ),
    "contract_rejects": (
        ("judged_again",),
        f"""
        SELECT {_EVENT}, event_ts AS raw_event_ts, found AS violations, epoch_ms(received_time) AS quarantined_at
        FROM judged_again WHERE found <> ''
        """,
    ),
    "quarantine_replay": (
        ("verdict",),
        """
        SELECT event_id, source, currency, violations, CASE WHEN passes THEN 1 ELSE 2 END AS attempts, passes AS released
        FROM (SELECT *, violations = 'INVALID_CURRENCY' AND coalesce(currency IN ('BTC', 'usd'), false) AS passes
              FROM verdict WHERE NOT is_valid)
        """,
    ),
    "replayed_clean": (
        ("verdict",),
        f"""
        SELECT {_EVENT}, epoch_ms(parsed_event_ts) AS event_time
        FROM verdict WHERE is_valid OR (violations = 'INVALID_CURRENCY' AND currency IN ('BTC', 'usd'))
        """,
    ),
    "stored_newest_rejects": (
        ("verdict",),
        """
        SELECT row_number() OVER (ORDER BY moved DESC, event_id NULLS FIRST, source NULLS FIRST) AS rank,
               source, event_id, violations, epoch_ms(moved) AS quarantined_at
        FROM (SELECT *, received_time + to_days(CAST(sequence % 7 AS INTEGER)) AS moved FROM verdict WHERE NOT is_valid)
        ORDER BY moved DESC, event_id NULLS FIRST, source NULLS FIRST LIMIT 25
        """,
    ),
}


# What a stream keeps current is what a batch shows at the end.
_FINAL |= {
    "stored_events": (("raw",), f"SELECT {_EVENT}, event_ts, epoch_ms(received_time) AS received_time FROM raw"),
    "stream_replayed": _FINAL["stream_route"],
}
_FINAL |= {"wire_stream": _FINAL["stream_route"], "live_board": _FINAL["health_board"], "live_history": _FINAL["source_history"]}


def _needed(names: tuple[str, ...]) -> list[str]:
    """The named tables and what they are built on, each after its inputs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for base in _CTES[name][0]:
            visit(base)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _sql(names: tuple[str, ...], final: str) -> str:
    ctes = ",\n".join(f"{name} AS ({_CTES[name][1].strip()})" for name in _needed(names))
    return f"WITH {'RECURSIVE ' if 'anchors' in _needed(names) else ''}{ctes}\n{final.strip()}"


# The same rows, read through manifests.
_FINAL["committed_rejects"] = _FINAL["quarantine_events"]

ORACLE: dict[str, str] = {key: _sql(names, final) for key, (names, final) in _FINAL.items()}
