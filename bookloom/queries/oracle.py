"""The same results in plain SQL for DuckDB, over the view `events`."""

from __future__ import annotations

from bookloom import schemas
from bookloom.queries.adapters import API, TYPE_ID
from bookloom.queries.registry import DAY, END, START, WEEKS

NY = "America/New_York"


def local(ts: str) -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE '{NY}')"


def named(column: str) -> str:
    return f"{column} IS NOT NULL AND trim({column}) <> ''"


def money(expression: str, scale: int = 2) -> str:
    return f"round({expression}, {scale})"


def title(column: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(replace({column}, '_', ' '), '[A-Za-z]+|[^A-Za-z]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')")


WITH_K = """
source_rows AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE event_type WHEN 'click' THEN 'facebook_paid_ads' WHEN 'view' THEN 'youtube_paid_ads'
      WHEN 'purchase' THEN 'tiktok_paid_ads' WHEN 'signup' THEN '  ' END AS channel
  FROM events
)"""

BOOKINGS = WITH_K + """,
bookings AS (
  SELECT 'b' || CAST(event_id // 2 AS VARCHAR) AS booking_id,
    's' || CAST(event_id // 3 AS VARCHAR) AS scheduled_event_id,
    channel,
    CASE k % 5 WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN 'cmp_3' WHEN 4 THEN ' cmp_4 ' END AS utm_campaign,
    CASE WHEN k <> 7 THEN ts END AS booking_created_at,
    ts + INTERVAL 30 SECOND AS webhook_received_at,
    ts + INTERVAL 26 HOUR AS scheduled_event_start,
    CASE WHEN user_id % 12 = 0 THEN ' ' ELSE 'emp' || CAST(user_id % 12 AS VARCHAR) END AS organizer_email,
    CASE k % 10 WHEN 0 THEN 'canceled' WHEN 1 THEN 'cancelled' WHEN 2 THEN NULL ELSE 'active' END AS invitee_status,
    CAST(ts AS DATE) AS day
  FROM source_rows
)"""

SPEND = """,
spend AS (
  SELECT CAST(ts AS DATE) AS day, channel, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS spend
  FROM source_rows
  WHERE trim(channel) <> '' AND (channel <> 'tiktok_paid_ads' OR day(ts) % 2 = 1)
  GROUP BY ALL
)"""


def daily_cte(days: str = "TRUE", count: str = "DISTINCT booking_id") -> str:
    return f"""
daily AS (
  SELECT channel, count({count}) AS bookings, day AS booking_date FROM bookings
  WHERE {named('channel')} AND {days} GROUP BY channel, day
)"""


# Bookings and amounts as rows of one list; a channel counts if it has both.
CPB = f"""
cpb AS (
  SELECT channel, sum(amount) AS total_spend, count(DISTINCT booking_id) AS total_bookings,
    {money('sum(amount) / count(DISTINCT booking_id)')} AS cpb
  FROM (SELECT channel, booking_id, NULL AS amount FROM bookings UNION ALL SELECT channel, NULL, spend FROM spend)
  WHERE {named('channel')}
  GROUP BY channel
  HAVING count(booking_id) > 0 AND count(amount) > 0
)"""

CUMULATIVE = daily_cte() + """,
cumulative AS (
  SELECT channel AS source, bookings,
    CAST(sum(bookings) OVER (PARTITION BY channel ORDER BY booking_date ROWS UNBOUNDED PRECEDING) AS BIGINT)
      AS cumulative_bookings,
    booking_date AS dt
  FROM daily
)"""


def campaign_cte(division: str = "/", days: str = "TRUE") -> str:
    return f"""
labelled AS (
  SELECT DISTINCT day, channel, CASE WHEN {named('utm_campaign')} THEN trim(utm_campaign) ELSE '(none)' END AS label, booking_id
  FROM bookings WHERE {named('channel')} AND {days}
),
shares AS (
  SELECT day, channel, label, count(DISTINCT booking_id) AS own,
    max(count(DISTINCT booking_id)) OVER (PARTITION BY day, channel) AS every
  FROM labelled GROUP BY GROUPING SETS ((day, channel, label), (day, channel))
  QUALIFY label IS NOT NULL
),
campaign_daily AS (
  SELECT channel AS source, label AS campaign, own AS total_bookings, coalesce(spend, 0) * (own {division} every) AS total_spend,
    {money(f'coalesce(spend, 0) * (own {division} every) / own')} AS cpb, day AS dt
  FROM shares LEFT JOIN spend USING (day, channel)
)"""


TIMES = f"""
times AS (
  SELECT source, booking_id, CAST(hour(wall) AS INTEGER) AS hour_of_day, CAST(isodow(wall) AS INTEGER) AS dow_num,
    strftime(wall, '%a') AS dow_name, CAST(wall AS DATE) AS booking_date_local, day
  FROM (
    SELECT channel AS source, booking_id, {local('coalesce(booking_created_at, webhook_received_at)')} AS wall, day
    FROM bookings WHERE {named('channel')})
  WHERE wall IS NOT NULL
)"""

MEETINGS = f"""
meetings AS (
  SELECT employee_id, meeting_id, CAST(wall AS DATE) AS meeting_date, CAST(date_trunc('week', wall) AS DATE) AS week_start_date
  FROM (
    SELECT organizer_email AS employee_id, scheduled_event_id AS meeting_id, {local('scheduled_event_start')} AS wall
    FROM bookings
    WHERE {named('organizer_email')} AND coalesce(invitee_status, '') NOT IN ('canceled', 'cancelled'))
)"""


def between(column: str, start: str = START, end: str = END) -> str:
    return f"{column} BETWEEN DATE '{start}' AND DATE '{end}'"


def from_bookings(select: str, *ctes: str) -> str:
    return "WITH " + BOOKINGS + "".join("," + c for c in ctes) + "\n" + select


def with_spend(select: str, *ctes: str) -> str:
    return "WITH " + BOOKINGS + SPEND + "".join("," + c for c in ctes) + "\n" + select


def days_of(column: str, table: str) -> str:
    return f"SELECT min({column}) AS min_d, max({column}) AS max_d FROM {table}"


DAILY_COLUMNS = "SELECT channel, bookings, booking_date FROM daily"
CUMULATIVE_COLUMNS = "SELECT source, bookings, cumulative_bookings, dt FROM cumulative"
CAMPAIGN_COLUMNS = (
    f"SELECT source, campaign, total_bookings, {money('total_spend', 4)} AS total_spend, cpb, dt FROM campaign_daily")
TIME_COLUMNS = "SELECT source, booking_id, hour_of_day, dow_num, dow_name, booking_date_local FROM times"
MEETING_COLUMNS = "SELECT employee_id, meeting_id, meeting_date, week_start_date FROM meetings"
CPB_COLUMNS = f"SELECT channel, {money('total_spend', 4)} AS total_spend, total_bookings, cpb FROM cpb"

TWO = "source IN ('facebook_paid_ads', 'youtube_paid_ads')"

# Silver

WEBHOOKS = WITH_K + f""",
webhooks AS (
  SELECT *, ts + INTERVAL 30 SECOND AS received_at,
    '{API}/scheduled_events/S' || CAST(event_id // 3 AS VARCHAR) AS meeting_uri,
    '{API}/scheduled_events/S' || CAST(event_id // 3 AS VARCHAR) || '/invitees/B' || CAST(event_id // 2 AS VARCHAR)
      AS invitee,
    CASE k % 5 WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN 'cmp_3' WHEN 4 THEN ' cmp_4 ' END AS utm_campaign,
    CASE k % 10 WHEN 0 THEN 'canceled' WHEN 1 THEN 'cancelled' WHEN 2 THEN NULL ELSE 'active' END AS status,
    CASE WHEN user_id % 12 <> 0 THEN 'emp' || CAST(user_id % 12 AS VARCHAR) END AS employee,
    CASE WHEN k = 12 THEN '' WHEN event_type = 'error' THEN 'invitee.canceled' WHEN event_type <> 'signup' THEN 'invitee.created'
      END AS hook,
    '{API}/event_types/' || CASE event_type WHEN 'click' THEN '{TYPE_ID["facebook_paid_ads"]}'
      WHEN 'view' THEN '{TYPE_ID["youtube_paid_ads"]}' WHEN 'purchase' THEN '{TYPE_ID["tiktok_paid_ads"]}'
      ELSE 'other' END AS type_url
  FROM source_rows
)"""

SILVER = WEBHOOKS + f""",
silver AS (
  SELECT CASE WHEN k = 8 THEN '' WHEN k NOT IN (9, 10) THEN 'B' || CAST(event_id // 2 AS VARCHAR) END AS booking_id,
    CASE WHEN k <> 10 THEN 'S' || CAST(event_id // 3 AS VARCHAR) END AS scheduled_event_id,
    type_url AS event_type_url,
    nullif(channel, '  ') AS channel,
    'Intro call' AS event_name, hook AS webhook_event_name,
    CASE WHEN k <> 7 THEN ts END AS booking_created_at,
    CAST(ts + INTERVAL 26 HOUR AS DATE) AS booking_date,
    date_trunc('second', ts + INTERVAL 26 HOUR) AS scheduled_event_start,
    CAST(NULL AS TIMESTAMP) AS scheduled_event_end,
    'user.' || CAST(user_id AS VARCHAR) AS invitee_email, 'Name ' || CAST(user_id AS VARCHAR) AS invitee_name,
    status AS invitee_status,
    CASE WHEN k = 8 THEN invitee || '/x' WHEN k NOT IN (9, 10) THEN invitee END AS invitee_uri,
    'America/New_York' AS invitee_timezone, k % 2 = 0 AS rescheduled,
    CAST(NULL AS VARCHAR) AS cancel_url, CAST(NULL AS VARCHAR) AS reschedule_url,
    CAST(NULL AS VARCHAR) AS text_reminder_number,
    employee AS organizer_email, upper(employee) AS organizer_name, '{API}/users/' || employee AS organizer_uri,
    'zoom' AS location_type, '{API}/join' AS location_url,
    event_type AS utm_source, utm_campaign,
    CAST(NULL AS VARCHAR) AS utm_medium, CAST(NULL AS VARCHAR) AS utm_content, CAST(NULL AS VARCHAR) AS utm_term,
    ts AS webhook_received_at, '{API}/users/owner' AS webhook_received_by,
    strftime(received_at, '%Y-%m-%d') AS dt
  FROM webhooks
)"""

CLEAN_SPEND = WITH_K + """,
clean_spend AS (
  SELECT dt, channel, spend FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, channel ORDER BY source_file DESC, spend DESC NULLS LAST) AS n
    FROM (
      SELECT strftime(ts, '%Y-%m-%d') AS dt, channel, CASE WHEN k <> 7 THEN value END AS spend,
        k % 3 AS source_file
      FROM source_rows WHERE k <> 8 AND channel IS NOT NULL))
  WHERE n = 1
)"""

# Intake: what is stored, under which key, and which copy stays

STORED = WEBHOOKS + """,
routed AS (
  SELECT received_at, event_id AS row_id, strftime(received_at, '%Y-%m-%d') AS dt,
    CASE WHEN k = 3 THEN 'not_an_object' WHEN k = 6 THEN 'bad_base64' END AS reason,
    CASE WHEN k IN (4, 11) THEN 'unknown_event' ELSE coalesce(nullif(hook, ''), 'unknown_event') END AS event,
    CASE WHEN k IN (4, 10, 11) THEN NULL WHEN k = 8 THEN sha256(invitee || '/x') WHEN k = 9 THEN sha256(meeting_uri)
      ELSE sha256(invitee) END AS event_id,
    CASE WHEN k = 4 THEN 'junk ' || CAST(event_id AS VARCHAR) END AS raw,
    CASE WHEN k NOT IN (4, 11) THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS created_at,
    CASE WHEN k = 3 THEN '[1, 2]' WHEN k = 6 THEN 'abc' END AS body, k IN (5, 6) AS is_base64
  FROM webhooks
),
copies AS (
  SELECT *, row_number() OVER (w ORDER BY received_at DESC) AS n, row_number() OVER (w ORDER BY received_at) AS nth
  FROM routed WHERE reason IS NULL WINDOW w AS (PARTITION BY dt, event, coalesce(event_id, CAST(row_id AS VARCHAR)))
),
stored AS (SELECT * FROM copies WHERE n = 1)"""

INTAKE = "WITH " + STORED + "\nSELECT dt, event, event_id, received_at, created_at, raw FROM stored"
REJECTED = "WITH " + STORED + "\nSELECT body, is_base64, received_at, reason, dt FROM routed WHERE reason IS NOT NULL"

INTAKE_COLUMNS = "\nSELECT dt, event, event_id, received_at, created_at, raw FROM "

# All silver columns of the copies that stay; text that is no JSON and empty objects have none but the day.
FROM_INTAKE = "WITH " + STORED + "," + SILVER.removeprefix(WEBHOOKS + ",").replace(
    "AS dt\n  FROM webhooks", "AS dt, event_id AS row_id, k\n  FROM webhooks") + "\nSELECT " + ", ".join(
    "s.dt" if c == "dt" else f"CASE WHEN w.k NOT IN (4, 11) THEN w.{c} END AS {c}" for c in schemas.EVENTS.columns
) + "\nFROM stored s JOIN silver w USING (row_id)"

# Reports

DETAIL = f"detail AS (SELECT * FROM daily WHERE {between('booking_date')})"
TREND_DAILY = f"detail AS (SELECT * FROM cumulative WHERE {between('dt')})"


def pivot(row: str, column: str, cell: str, table: str, values: list[str], total: bool = False) -> str:
    cells = [f"{cell.format(v=v)} AS \"{v}\"" for v in values]
    if total:
        cells.append("+".join(cell.format(v=v) for v in values) + ' AS "TOTAL"')
    return f"SELECT {row}, {', '.join(cells)} FROM {table} GROUP BY {row}".replace("{column}", column)


CHANNELS = ["facebook_paid_ads", "youtube_paid_ads", "tiktok_paid_ads"]
CAMPAIGNS = ["(none)", "cmp_3", "cmp_4"]
AVERAGE_CHANNEL = "CAST(coalesce(avg(bookings) FILTER (channel = '{v}'), 0) AS DOUBLE)"
AVERAGE_SOURCE = "CAST(coalesce(avg(bookings) FILTER (source = '{v}'), 0) AS DOUBLE)"


def kpis(period: str, group: str, name: str, table: str) -> str:
    return (
        f"SELECT CAST(sum(n) AS BIGINT) AS total_bookings, round_even(avg(n) * 100, 0) / 100 AS avg_per_period, "
        f"(SELECT count(DISTINCT {group}) FROM {table}) AS {name} "
        f"FROM (SELECT {period}, sum(bookings) AS n FROM {table} GROUP BY {period})")


def weekly_cte(where: str) -> str:
    return f"""
weekly AS (
  SELECT week_start, source, bookings, CAST(sum(bookings) OVER (
    PARTITION BY source ORDER BY week_start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_bookings
  FROM (
    SELECT CAST(date_trunc('week', dt) AS DATE) AS week_start, source, CAST(sum(bookings) AS BIGINT) AS bookings
    FROM cumulative WHERE {where} GROUP BY ALL)
)"""


def attribution_cte(where: str) -> str:
    return f"""
agg AS (
  SELECT source, campaign, CAST(sum(total_bookings) AS BIGINT) AS bookings, {money('sum(total_spend)')} AS spend,
    {money('sum(total_spend) / nullif(sum(total_bookings), 0)')} AS cpb
  FROM campaign_daily WHERE {where} GROUP BY source, campaign
)"""


def attribution(select: str, where: str = between("dt")) -> str:
    return with_spend(select, campaign_cte(), attribution_cte(where))


ATTRIBUTION_COLUMNS = f"SELECT *, {title('source')} AS source_display, campaign AS campaign_display FROM agg"


def slots(keys: str, where: str) -> str:
    return from_bookings(
        f"SELECT {keys}, count(DISTINCT booking_id) AS bookings FROM times WHERE {where} GROUP BY {keys}", TIMES)


def load_cte(where: str, division: str = "/") -> str:
    return f"""
weeks AS (
  SELECT employee_id, week_start_date, count(DISTINCT meeting_id) AS meetings FROM meetings WHERE {where} GROUP BY ALL
),
load AS (
  SELECT employee_id, CAST(sum(meetings) AS BIGINT) AS total_meetings, count(DISTINCT week_start_date) AS weeks_present,
    CAST({money(f'sum(meetings) {division} nullif(count(DISTINCT week_start_date), 0)')} AS DOUBLE) AS avg_meetings_per_week
  FROM weeks GROUP BY employee_id
)"""


def carried(start: str, end: str) -> str:
    """Stored totals before `start`, plus the running sum of the days of the range."""
    return from_bookings(f"""
SELECT d.channel AS source, d.bookings,
  CAST(coalesce((SELECT max(c.cumulative_bookings) FROM cumulative c WHERE c.source = d.channel AND c.dt < DATE '{start}'), 0)
    + sum(d.bookings) OVER (PARTITION BY d.channel ORDER BY d.booking_date ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS cumulative_bookings, d.booking_date AS dt
FROM daily d WHERE {between('d.booking_date', start, end)}""", CUMULATIVE)


FULL_MONTHS = between("week_start_date", WEEKS[0], "2024-01-29")

ORACLE: dict[str, str] = {
    "events_silver": "WITH " + SILVER + "\nSELECT * FROM silver",
    "events_silver_mapping_table": "WITH " + SILVER + """
SELECT * REPLACE (CASE WHEN utm_source IN ('click', 'view') THEN utm_source END AS channel) FROM silver""",
    "spend_silver": "WITH " + CLEAN_SPEND + "\nSELECT * FROM clean_spend",

    "events_silver_from_files": "WITH " + SILVER + f"\nSELECT * FROM silver WHERE {between('CAST(dt AS DATE)')}",
    "events_silver_from_compacted": "WITH " + SILVER + f"\nSELECT * FROM silver WHERE {between('CAST(dt AS DATE)')}",
    "spend_silver_from_arrays": "WITH " + CLEAN_SPEND + "\nSELECT * FROM clean_spend",
    "spend_silver_from_files": "WITH " + WITH_K + """
SELECT channel, arg_max(spend, file) AS spend, dt
FROM (
  SELECT channel, k % 3 AS file, strftime(ts, '%Y-%m-%d') AS dt,
    CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS spend
  FROM source_rows WHERE channel IS NOT NULL AND day(ts) > 5 * (k % 3) GROUP BY ALL)
GROUP BY channel, dt""",

    "daily_bookings_by_channel_rows": from_bookings(DAILY_COLUMNS, daily_cte(count="booking_id")),
    "daily_bookings_by_channel_distinct": from_bookings(DAILY_COLUMNS, daily_cte()),
    "cpb_by_channel": with_spend(CPB_COLUMNS, CPB),
    "cumulative_bookings_by_source": from_bookings(CUMULATIVE_COLUMNS, CUMULATIVE),
    "channel_campaign_daily_proportional": with_spend(CAMPAIGN_COLUMNS, campaign_cte()),
    "channel_campaign_daily_integer": with_spend(CAMPAIGN_COLUMNS, campaign_cte("//")),
    "booking_time_features": from_bookings(TIME_COLUMNS, TIMES),
    "employee_meetings_features": from_bookings(MEETING_COLUMNS, MEETINGS),

    "daily_bookings_increment_day": from_bookings(DAILY_COLUMNS, daily_cte(f"day = DATE '{DAY}'")),
    "daily_bookings_increment_range": from_bookings(DAILY_COLUMNS, daily_cte(between("day"))),
    "cumulative_increment_day": carried(DAY, DAY),
    "cumulative_increment_range": carried(START, END),
    "cumulative_latest_before": from_bookings(
        f"SELECT source, max_by(cumulative_bookings, dt) AS prev FROM cumulative WHERE dt < DATE '{DAY}' GROUP BY source",
        CUMULATIVE),
    "campaign_increment_day": with_spend(CAMPAIGN_COLUMNS, campaign_cte(days=f"day = DATE '{DAY}'")),
    "campaign_increment_range": with_spend(CAMPAIGN_COLUMNS, campaign_cte(days=between("day"))),
    "time_features_increment_local_day": from_bookings(
        f"{TIME_COLUMNS} WHERE booking_date_local = DATE '{DAY}'", TIMES),
    "time_features_increment_ingest_range": from_bookings(f"{TIME_COLUMNS} WHERE {between('day')}", TIMES),
    "meeting_features_increment_day": from_bookings(f"{MEETING_COLUMNS} WHERE meeting_date = DATE '{DAY}'", MEETINGS),
    "meeting_features_increment_weeks": from_bookings(
        f"{MEETING_COLUMNS} WHERE week_start_date IN (DATE '{WEEKS[0]}', DATE '{WEEKS[1]}')", MEETINGS),

    "refreshed_daily_bookings": from_bookings(DAILY_COLUMNS, daily_cte()),
    "refreshed_cpb": with_spend(CPB_COLUMNS, CPB),
    "refreshed_cpb_daily": with_spend(CPB_COLUMNS, CPB),
    "refreshed_cumulative": from_bookings(CUMULATIVE_COLUMNS, CUMULATIVE),
    "refreshed_cumulative_blocks": from_bookings(CUMULATIVE_COLUMNS, CUMULATIVE),
    "refreshed_campaign_daily": with_spend(CAMPAIGN_COLUMNS, campaign_cte()),
    "refreshed_time_features": from_bookings(TIME_COLUMNS, TIMES),
    "refreshed_time_features_pruned": from_bookings(f"{TIME_COLUMNS} WHERE {between('booking_date_local', START, DAY)}", TIMES),
    "refreshed_meeting_features": from_bookings(MEETING_COLUMNS, MEETINGS),

    "daily_run_bookings": from_bookings(DAILY_COLUMNS, daily_cte(f"day = DATE '{DAY}'")),

    "table_append": from_bookings(
        f"{DAILY_COLUMNS} UNION ALL {DAILY_COLUMNS} WHERE booking_date = DATE '{DAY}'", daily_cte()),
    "table_overwrite_partitions": from_bookings(f"""
{DAILY_COLUMNS} WHERE NOT ({between('booking_date')})
UNION ALL
SELECT channel, count(booking_id), day FROM bookings
WHERE {named('channel')} AND {between('day', START, DAY)} GROUP BY ALL""", daily_cte()),
    "table_replace_days": "WITH " + CLEAN_SPEND + SPEND + f"""
SELECT channel, spend, strftime(day, '%Y-%m-%d') AS dt FROM spend WHERE NOT ({between('day')})
UNION ALL
SELECT channel, spend, dt FROM clean_spend WHERE {between('CAST(dt AS DATE)')}""",
    "catalog_row_counts": with_spend("""
SELECT 'bookloom_check.booking_events' AS table_name, count(*) AS n_rows FROM bookings
UNION ALL SELECT 'bookloom_check.events_spend', count(*) FROM spend"""),
    "catalog_samples": "WITH " + SILVER + SPEND + """
SELECT 'bookloom_check.booking_events' AS table_name, "row" FROM (
  SELECT concat_ws('|', coalesce(booking_id, ''), coalesce(channel, ''), coalesce(invitee_email, ''), dt) AS "row" FROM silver
  ORDER BY sha256("row") LIMIT 10)
UNION ALL SELECT 'bookloom_check.events_spend', "row" FROM (
  SELECT concat_ws('|', channel, strftime(day, '%Y-%m-%d')) AS "row" FROM spend ORDER BY sha256("row") LIMIT 10)""",
    "catalog_compared": with_spend(f"""
SELECT strftime(day, '%Y-%m-%d') AS dt, count(*) AS n_expected, count(*) FILTER (day <> DATE '{START}') AS n_stored,
  CASE WHEN day = DATE '{START}' THEN 'missing' WHEN day = DATE '{DAY}' THEN 'changed' ELSE 'same' END AS status
FROM spend GROUP BY day"""),
    "catalog_swapped_cpb": with_spend(CPB_COLUMNS, CPB),
    "csv_export": from_bookings(DAILY_COLUMNS, daily_cte()),

    "webhook_intake": INTAKE,
    "webhook_intake_by_key": INTAKE,
    "webhook_intake_rejects": REJECTED,
    "stream_webhook_intake": INTAKE,
    "stream_webhook_intake_rejects": REJECTED,
    "stream_webhook_intake_first_copy": "WITH " + STORED + INTAKE_COLUMNS + "copies WHERE nth = 1",
    "stream_webhook_intake_later_copies": "WITH " + STORED + INTAKE_COLUMNS + "copies WHERE nth > 1",
    "stream_events_silver": FROM_INTAKE,
    "events_silver_replayed": FROM_INTAKE + f" WHERE {between('CAST(s.dt AS DATE)')}",

    "report_daily_range": from_bookings(days_of("booking_date", "daily"), daily_cte()),
    "report_daily_detail": from_bookings("SELECT booking_date, channel, bookings FROM detail", daily_cte(), DETAIL),
    "report_daily_kpis": from_bookings(
        kpis("booking_date", "channel", "channels", "detail"), daily_cte(), DETAIL),
    "report_daily_pivot": from_bookings(
        pivot("booking_date", "channel", AVERAGE_CHANNEL, "detail", CHANNELS, total=True), daily_cte(), DETAIL),
    "report_daily_pivot_discovered": from_bookings(
        pivot("booking_date", "channel", AVERAGE_CHANNEL, "daily", CHANNELS, total=True), daily_cte()),

    "report_cpb_leaderboard": with_spend(
        f"SELECT channel, {money('total_spend', 4)} AS total_spend, total_bookings, cpb, {title('channel')} AS channel_display "
        "FROM cpb", CPB),
    "report_cpb_kpis": with_spend(
        f"SELECT CAST(sum(total_bookings) AS BIGINT) AS total_bookings, {money('sum(total_spend)', 4)} AS total_spend, "
        f"{money('coalesce(sum(total_spend) / nullif(sum(total_bookings), 0), 0)', 4)} AS avg_cpb_weighted FROM cpb", CPB),

    "report_trend_sources": from_bookings("SELECT DISTINCT source FROM cumulative", CUMULATIVE),
    "report_trend_range": from_bookings(days_of("dt", "cumulative"), CUMULATIVE),
    "report_trend_daily": from_bookings(
        f"SELECT dt, source, bookings, cumulative_bookings FROM detail WHERE {TWO}", CUMULATIVE, TREND_DAILY),
    "report_trend_daily_kpis": from_bookings(
        kpis("dt", "source", "sources", f"(SELECT * FROM detail WHERE {TWO})"), CUMULATIVE, TREND_DAILY),
    "report_trend_daily_pivot": from_bookings(
        pivot("dt", "source", AVERAGE_SOURCE, "detail", CHANNELS), CUMULATIVE, TREND_DAILY),
    "report_trend_weekly": from_bookings("SELECT * FROM weekly", CUMULATIVE, weekly_cte(f"{between('dt')} AND {TWO}")),
    "report_trend_weekly_kpis": from_bookings(
        kpis("week_start", "source", "sources", "weekly"), CUMULATIVE, weekly_cte(between("dt"))),
    "report_trend_weekly_pivot": from_bookings(
        pivot("week_start", "source", AVERAGE_SOURCE, "weekly", CHANNELS), CUMULATIVE, weekly_cte("TRUE")),

    "report_attribution_campaigns": with_spend("SELECT DISTINCT campaign FROM campaign_daily", campaign_cte()),
    "report_attribution_range": with_spend(days_of("dt", "campaign_daily"), campaign_cte()),
    "report_attribution": attribution(ATTRIBUTION_COLUMNS),
    "report_attribution_filtered": attribution(
        ATTRIBUTION_COLUMNS, f"{between('dt')} AND {TWO} AND campaign IN ('cmp_3', 'cmp_4')"),
    "report_attribution_leaderboard": attribution("SELECT source, campaign, bookings, spend, cpb FROM agg"),
    "report_attribution_kpis": attribution(
        f"SELECT CAST(sum(bookings) AS BIGINT) AS total_bookings, {money('sum(spend)', 4)} AS total_spend, "
        f"{money('coalesce(sum(spend) / nullif(sum(bookings), 0), 0)', 4)} AS blended_cpb FROM agg"),
    "report_attribution_top_sources": attribution(
        f"SELECT source, CAST(sum(bookings) AS BIGINT) AS bookings, {money('sum(spend)', 4)} AS spend, "
        f"{money('sum(spend) / nullif(sum(bookings), 0)', 4)} AS cpb, {title('source')} AS source_display "
        "FROM agg GROUP BY source ORDER BY bookings DESC, source LIMIT 2"),
    "report_attribution_cpb_pivot": attribution(
        pivot("source", "campaign", "avg(cpb) FILTER (campaign = '{v}')", "agg", CAMPAIGNS)),
    "report_attribution_bookings_pivot": attribution(pivot(
        "source", "campaign", "CAST(coalesce(sum(bookings) FILTER (campaign = '{v}'), 0) AS BIGINT)", "agg", CAMPAIGNS)),

    "report_attribution_page_headings": attribution("""
SELECT campaign AS heading, n - 1 AS place, (n - 1) // 2 AS page, CAST((n - 1) % 2 AS INTEGER) AS slot
FROM (SELECT DISTINCT campaign, dense_rank() OVER (ORDER BY campaign) AS n FROM agg)"""),
    "report_attribution_pages": attribution("""
SELECT source, (n - 1) // 2 AS page, CAST(coalesce(sum(bookings) FILTER (n % 2 = 1), 0) AS BIGINT) AS c0,
  CAST(coalesce(sum(bookings) FILTER (n % 2 = 0), 0) AS BIGINT) AS c1
FROM (SELECT *, dense_rank() OVER (ORDER BY campaign) AS n FROM agg) GROUP BY ALL"""),

    "report_slots_range": from_bookings(days_of("booking_date_local", "times"), TIMES),
    "report_slots_sources": from_bookings("SELECT DISTINCT source FROM times", TIMES),
    "report_slots_heatmap": slots("dow_num, dow_name, hour_of_day", between("booking_date_local")),
    "report_slots_by_hour": slots("hour_of_day", f"{between('booking_date_local')} AND {TWO}"),
    "report_slots_heatmap_from_sets": slots("dow_num, dow_name, hour_of_day", between("booking_date_local")),
    "report_slots_by_hour_from_sets": slots("hour_of_day", f"{between('booking_date_local')} AND {TWO}"),
    "report_slots_by_weekday": slots("dow_num, dow_name", between("booking_date_local")),

    "report_load_range": from_bookings(days_of("week_start_date", "meetings"), MEETINGS),
    "report_load_employees": from_bookings("SELECT DISTINCT employee_id FROM meetings", MEETINGS),
    "report_load_by_employee": from_bookings("SELECT * FROM load", MEETINGS, load_cte(FULL_MONTHS)),
    "report_load_by_employee_from_sets": from_bookings("SELECT * FROM load", MEETINGS, load_cte(FULL_MONTHS)),
    "report_load_by_employee_integer": from_bookings("SELECT * FROM load", MEETINGS, load_cte("TRUE", "//")),
    "report_load_by_employee_selected": from_bookings("SELECT * FROM load", MEETINGS, load_cte(
        f"{between('week_start_date', *WEEKS)} AND employee_id IN ('emp1', 'emp2', 'emp3')")),
    "report_load_kpis": from_bookings(
        "SELECT CAST(sum(total_meetings) AS BIGINT) AS total_meetings, max(total_meetings) AS max_meetings, "
        "min(total_meetings) AS min_meetings FROM load", MEETINGS, load_cte(FULL_MONTHS)),
    "report_load_weekly": from_bookings("SELECT * FROM weeks", MEETINGS, load_cte(FULL_MONTHS)),

    "text_functions": from_bookings(f"""
SELECT DISTINCT booking_id, coalesce({named('channel')}, FALSE) AS has_channel, nullif(trim(utm_campaign), '') AS campaign,
  coalesce(nullif(utm_campaign, ''), '(none)') AS campaign_display, {title('channel')} AS channel_display FROM bookings"""),
    "time_functions": from_bookings(f"""
SELECT booking_id, wall AS local, CAST(wall AS DATE) AS local_date, CAST(date_trunc('week', wall) AS DATE) AS week_start,
  CAST(hour(wall) AS INTEGER) AS hour_of_day, CAST(isodow(wall) AS INTEGER) AS dow_num, strftime(wall, '%a') AS dow_name,
  day - 1 AS day_before
FROM (SELECT *, {local('scheduled_event_start')} AS wall FROM bookings)"""),
}
