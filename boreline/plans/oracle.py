"""DuckDB text of the shared views, used to check results."""

from __future__ import annotations

from ..sources.testviews import GAP_SECONDS, LONG_GAP_SECONDS


def r(expr: str, places: int = 6) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def staged(source: str, gap: float, name: str) -> str:
    """Gap stages of a view with ``name, record_ts``."""
    return f"""
{name} AS (
  SELECT * EXCLUDE (is_new), CAST(SUM(is_new) OVER (PARTITION BY name ORDER BY record_ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stage_num_td
  FROM (
    SELECT *, CASE WHEN LAG(record_ts) OVER w IS NULL OR epoch_us(record_ts) - epoch_us(LAG(record_ts) OVER w) >= {int(gap)}000000
                   THEN 1 ELSE 0 END AS is_new
    FROM {source} WINDOW w AS (PARTITION BY name ORDER BY record_ts)
  )
)"""


def windows(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT name, stage_num_td, arg_max(fleet_name, record_ts) AS fleet_name, arg_max(pad_name, record_ts) AS pad_name,
         arg_max(id, record_ts) AS well_id, arg_max(api_num, record_ts) AS api_num,
         MIN(record_ts) AS stage_start_ts, MAX(record_ts) AS stage_end_ts,
         MIN(created_ts) AS first_created_ts, MAX(created_ts) AS last_created_ts, COUNT(*) AS sample_count,
         AVG(rate_slurry) AS avg_rate_slurry, MAX(rate_slurry) AS max_rate_slurry,
         AVG(press_mainline) AS avg_press_mainline, MAX(press_mainline) AS max_press_mainline,
         AVG(prop_conc_blend_denso) AS avg_prop_conc_blend_denso, MAX(prop_conc_blend_denso) AS max_prop_conc_blend_denso
  FROM {source} GROUP BY name, stage_num_td
)"""


def label_view(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT name, stage_num_td, record_ts AS datetime_fmt,
         CASE WHEN event_id % 11 = 0 THEN 'NA' WHEN event_id % 13 = 0 THEN 'shut_off'
              WHEN event_type = 'signup' THEN 'stage_start' WHEN event_type = 'click' THEN 'ramp_up'
              WHEN event_type = 'view' THEN 'slurry' WHEN event_type = 'purchase' THEN 'ramp_down'
              WHEN event_type = 'error' THEN 'stage_end' END AS substage,
         rate_slurry, press_mainline, prop_conc_blend_denso, event_id
  FROM {source}
)"""


def marker_view(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT name, stage_num_td, record_ts AS datetime_fmt,
         CASE event_type WHEN 'signup' THEN 'PRE' WHEN 'click' THEN 'LOW' WHEN 'view' THEN 'MID_TRIAL'
                         WHEN 'purchase' THEN 'MID' WHEN 'error' THEN 'PRE_LOW' END AS substage,
         rate_slurry, press_mainline, prop_conc_blend_denso
  FROM {source}
)"""


VIEWS = {
    "tel": """
tel AS (
  SELECT CASE WHEN e.event_id % 17 <> 0 THEN e.ts + to_minutes(CAST(e.event_id % 7 AS INTEGER)) END AS created_ts,
         e.ts AS record_ts, 'W' || CAST(e.user_id AS VARCHAR) AS name, CAST(e.event_id AS VARCHAR) AS id,
         CAST(e.user_id AS VARCHAR) AS api_num, e.value AS rate_slurry,
         CAST(e.event_id % 100 AS DOUBLE) AS prop_conc_target, CAST(e.event_id % 50 AS DOUBLE) AS prop_conc_blend_denso,
         CAST(e.event_id % 20 AS DOUBLE) AS prop_conc_blend_auger, CAST(e.event_id % 10 AS DOUBLE) AS prop_conc_inline,
         CAST(regexp_extract(e.props, '"k": *([0-9]+)', 1) AS DOUBLE) * 10 AS press_mainline,
         CASE WHEN e.event_id % 19 = 0 THEN '' ELSE r.r_name END AS fleet_name, n.n_name AS pad_name, e.event_id, e.event_type, e.user_id
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)""",
    "stg": staged("tel", GAP_SECONDS, "stg"),
    "long": staged("tel", LONG_GAP_SECONDS, "long"),
    "win": windows("stg", "win"),
    "lwin": windows("long", "lwin"),
    "lab": label_view("long", "lab"),
    "mark": marker_view("long", "mark"),
    "hist": """
hist AS (
  SELECT name, CAST(CEIL(extract(day FROM record_ts) / 7.0) AS BIGINT) AS stage_num, record_ts AS datetime_fmt, created_ts,
         CAST(user_id AS DOUBLE) AS frac_id, rate_slurry, press_mainline, prop_conc_blend_denso,
         CAST(event_id % 3 + 1 AS DOUBLE) AS records_in_bucket
  FROM tel
)""",
    "hidx": """
hidx AS (
  SELECT name, stage_num, MIN(datetime_fmt) AS stage_start_ts, MAX(datetime_fmt) AS stage_end_ts, COUNT(*) AS sample_count,
         SUM(records_in_bucket) AS source_record_count, AVG(rate_slurry) AS avg_rate_slurry, MAX(press_mainline) AS max_press_mainline
  FROM hist GROUP BY name, stage_num
)""",
    "wells": f"""
wells AS (
  SELECT name, arg_max(fleet_name, record_ts) AS fleet_name, arg_max(pad_name, record_ts) AS pad_name,
         arg_max(pad_name, record_ts) AS well_family, arg_max(id, record_ts) AS well_id, arg_max(api_num, record_ts) AS api_num,
         {text('MIN(record_ts)')} AS first_record_ts, {text('MAX(record_ts)')} AS last_record_ts,
         {text('COALESCE(MIN(created_ts), MIN(record_ts))')} AS first_created_ts,
         {text('COALESCE(MAX(created_ts), MAX(record_ts))')} AS last_created_ts, COUNT(*) AS sample_count,
         MIN(record_ts) AS first_ts, MAX(record_ts) AS last_ts
  FROM tel GROUP BY name
)""",
    "ann": """
ann AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS annotation_id, o_orderpriority AS layer_id, 'W' || CAST(o_custkey AS VARCHAR) AS name,
         TIMESTAMP '2024-01-01' + to_minutes(CAST((o_orderkey * 37) % 43200 AS INTEGER)) AS start_time,
         TIMESTAMP '2024-01-01' + to_minutes(CAST((o_orderkey * 37) % 43200 AS INTEGER)) + to_hours(CAST(o_orderkey % 5 AS INTEGER)) AS end_time,
         CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'active' END AS status
  FROM orders
)""",
    "lay": """
lay AS (
  SELECT DISTINCT o_orderpriority AS layer_id, 'user' || substr(o_orderpriority, 1, 1) AS owner_email,
         substr(o_orderpriority, 1, 1) <> '1' AS is_editable, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS display_order
  FROM orders
)""",
    "man": """
man AS (
  SELECT name, stage_num_td, md5(name || '|' || CAST(stage_num_td AS VARCHAR)) AS active_run_id,
         CASE WHEN stage_num_td % 9 = 0 THEN 'retired' ELSE 'active' END AS status, 'ds-v1' AS algorithm_version, sample_count AS source_rows
  FROM win
)""",
    "pres": """
pres AS (
  SELECT name AS well_name, stage_num_td AS stage_num,
         MAX(CASE WHEN substage = 'stage_start' THEN 1 ELSE 0 END) AS stage_start, MAX(CASE WHEN substage = 'ramp_up' THEN 1 ELSE 0 END) AS ramp_up,
         MAX(CASE WHEN substage IN ('design', 'slurry') THEN 1 ELSE 0 END) AS design, MAX(CASE WHEN substage = 'ramp_down' THEN 1 ELSE 0 END) AS ramp_down,
         MAX(CASE WHEN substage = 'shut_off' THEN 1 ELSE 0 END) AS shut_off, MAX(CASE WHEN substage = 'stage_end' THEN 1 ELSE 0 END) AS stage_end
  FROM plab WHERE lower(substage) <> 'na' GROUP BY 1, 2
)""",
    "plab": label_view("stg", "plab"),
}

NEEDS = {
    "stg": ["tel"], "long": ["tel"], "win": ["stg"], "lwin": ["long"], "lab": ["long"], "mark": ["long"], "hist": ["tel"], "hidx": ["hist"],
    "wells": ["tel"], "man": ["win"], "pres": ["plab"], "plab": ["stg"],
}


def sql(views: str, body: str, *extra: str) -> str:
    """``WITH`` the named views (and what they need), extra views, then the body."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in views.split():
        add(name)
    parts = [VIEWS[n] for n in order] + list(extra)
    return ("WITH " + ",".join(parts) if parts else "") + "\n" + body
