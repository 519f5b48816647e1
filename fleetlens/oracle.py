"""DuckDB statements that state each query's result independently, over the base tables only."""

from __future__ import annotations

from fleetlens.catalog import (
    EXTENT_LINES, IDLE_AFTER, IDLE_POLL, LINE, LOG_FORMS, LOG_STREAMS, RAW_DIGITS, TTL_SECONDS, UPSERT_CUT,
)
from fleetlens.functions import display
from fleetlens.operators.logmetrics import seconds_of
from fleetlens.plans import panels
from fleetlens.plans.panels import Panel
from fleetlens.schemas import TABLES

POSITIONS = """
SELECT event_id, c, cl, sl, lt0, lt1, qv, p, a, epoch_ms(gps) AS ta,
       strftime(gps - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS ta_tempo, py, px, event_time
FROM (SELECT *, date_trunc('second', event_time) - to_seconds(event_id % 12) AS gps
FROM (SELECT event_id,
  concat('L', lpad(CAST(user_id % 10 AS VARCHAR), 2, '0'), '-10') AS c, CAST(user_id % 10 AS INT) AS cl,
  CAST(1 + event_id % 2 AS INT) AS sl,
  concat('TERM ', CAST(user_id % 10 AS VARCHAR)) AS lt0, concat('ORIG ', CAST(user_id % 10 AS VARCHAR)) AS lt1,
  CAST(15 AS INT) AS qv, CAST(user_id AS INT) AS p, user_id % 3 = 0 AS a,
  CAST(-23.55 AS DOUBLE) + CAST(0.0001 AS DOUBLE) * (CAST(floor(value * 100) AS BIGINT) % 400) AS py,
  CAST(-46.63 AS DOUBLE) + CAST(0.0001 AS DOUBLE) * (event_id * 37 % 400) AS px,
  make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60) AS event_time
FROM events))
"""

SHAPES = """
SELECT concat('S', CAST(o_orderkey % 20 AS VARCHAR)) AS shape_id,
  CAST(-23.55 AS DOUBLE) + CAST(0.00001 AS DOUBLE) * (o_orderkey * 7 % 4000) AS shape_pt_lat,
  CAST(-46.63 AS DOUBLE) + CAST(0.00001 AS DOUBLE) * (o_custkey * 13 % 4000) AS shape_pt_lon,
  CAST(o_orderkey % 2000 AS DOUBLE) * 100 AS shape_dist_traveled
FROM orders
"""

TRIPS = """
SELECT concat('L', lpad(CAST(c_custkey % 10 AS VARCHAR), 2, '0'), '-10') AS route_id,
  concat('S', CAST(c_custkey % 20 AS VARCHAR)) AS shape_id,
  CAST(c_custkey // 10 AS INT) % 2 AS direction_id
FROM customer
"""

LOGS = """
SELECT ts,
  CASE event_type WHEN 'view' THEN 'kafka' WHEN 'click' THEN 'flink-taskmanager' WHEN 'error' THEN 'flink-jobmanager'
    WHEN 'signup' THEN 'schema-registry' ELSE 'python-producer' END AS container,
  CASE WHEN event_id % 5 = 0 THEN 'stderr' ELSE 'stdout' END AS stream,
  CASE
    WHEN event_type = 'error' AND event_id % 3 = 0
      THEN concat('Checkpoint ', CAST(event_id AS VARCHAR), ' completed in ', CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR), ' ms')
    WHEN event_type = 'error' AND event_id % 3 = 1 THEN concat('JobFailedException job=', CAST(event_id AS VARCHAR))
    WHEN event_type = 'error' THEN concat('Sink: sink_', CASE event_id % 4 WHEN 0 THEN 'speed' WHEN 1 THEN 'headway'
      WHEN 2 THEN 'status' ELSE 'latest_pos' END)
    WHEN event_type = 'signup' AND event_id % 17 = 0 THEN concat('DeserializationException for id ', CAST(event_id AS VARCHAR))
    WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'HTTP GET /schemas/ids/1'
    WHEN event_type = 'signup' THEN 'HTTP POST Registering new schema'
    WHEN event_type = 'view' AND event_id % 7 = 0 THEN concat('INFO connection accepted from client ', CAST(event_id AS VARCHAR))
    WHEN event_type = 'view' THEN concat('partition ', CAST(event_id % 4 AS VARCHAR), ' replica isr ok posicoes')
    WHEN event_type = 'purchase' THEN concat('mensagem enviada offset=', CAST(event_id AS VARCHAR))
    WHEN event_id % 11 = 0 THEN concat('java.lang.OutOfMemoryError in task ', CAST(event_id AS VARCHAR))
    ELSE concat('task heartbeat ', CAST(event_id AS VARCHAR)) END AS line
FROM events
"""


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"12742.0 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2.0), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2.0), 2))))"
    )


# Named building blocks; each may read the ones above it.
BLOCKS = {
    "positions": POSITIONS,
    "shapes": SHAPES,
    "trips": TRIPS,
    "logs": LOGS,
    "fixes": """
SELECT *, lag(py) OVER v AS from_py, lag(px) OVER v AS from_px, lag(event_time) OVER v AS from_time
FROM positions WINDOW v AS (PARTITION BY p ORDER BY event_time, event_id)""",
    "steps": f"""
SELECT *, {_km('from_py', 'from_px', 'py', 'px')} AS km, date_sub('second', from_time, event_time) AS secs FROM fixes""",
    "speeds": """
SELECT event_id, c AS linha, p, event_time, km / (CAST(secs AS DOUBLE) / 3600.0) AS speed_kmh
FROM steps WHERE secs > 0""",
    "neighbours": """
SELECT *, lag(py) OVER n AS near_py, lag(px) OVER n AS near_px, lag(p) OVER n AS near_p
FROM positions WINDOW n AS (PARTITION BY c, sl ORDER BY event_time, event_id)""",
    "gaps": f"""
SELECT event_id, c AS linha, sl, p, event_time, {_km('near_py', 'near_px', 'py', 'px')} AS gap_km
FROM neighbours WHERE near_p IS NOT NULL AND near_p <> p""",
    "headways": """
SELECT g.event_id, s.linha, s.p, s.event_time, speed_kmh, gap_km, gap_km / speed_kmh * 60.0 AS headway_min
FROM speeds s JOIN gaps g ON s.linha = g.linha AND s.p = g.p AND s.event_time = g.event_time
WHERE speed_kmh BETWEEN 5.0 AND 120.0 AND gap_km > 0.05 AND gap_km / speed_kmh * 60.0 <= 120.0""",
    "motion": """
SELECT s.event_id, s.c AS linha, s.sl, s.p, s.event_time,
  coalesce(km / nullif(CAST(secs AS DOUBLE) / 3600.0, 0), 0.0) AS speed_kmh, g.event_id AS gap_event_id, gap_km
FROM steps s LEFT JOIN gaps g ON s.c = g.linha AND s.p = g.p AND s.event_time = g.event_time""",
    "latest": """
SELECT p AS prefixo, c AS linha, lt0 AS letreiro_terminal, lt1 AS letreiro_origem, py AS latitude, px AS longitude,
  a AS acessivel, event_time AS ultima_atualizacao
FROM positions QUALIFY row_number() OVER (PARTITION BY p ORDER BY event_time DESC, event_id DESC) = 1""",
    "status": f"""
SELECT p AS prefixo, linha, CASE sl WHEN 2 THEN '{display.INBOUND}' ELSE '{display.OUTBOUND}' END AS sentido,
  round(speed_kmh, 1) AS velocidade_kmh, round(assumed, 2) AS headway_minutos,
  CASE WHEN speed_kmh <= 2.0 THEN '{display.STOPPED}' WHEN assumed > 10.0 THEN '{display.DELAYED}'
    ELSE '{display.NORMAL}' END AS status,
  event_time AS ultima_atualizacao
FROM (SELECT *, CASE WHEN speed_kmh < 3.0 THEN 9.72 ELSE coalesce(gap_km / speed_kmh * 60.0, 7.5) END AS assumed
  FROM motion)
QUALIFY row_number() OVER (PARTITION BY p ORDER BY event_time DESC, event_id DESC) = 1""",
    "catalogue": """
SELECT c AS linha, lt1 AS letreiro_origem, lt0 AS letreiro_terminal, c || ' | ' || lt1 || ' - ' || lt0 AS linha_descricao,
  event_time AS ultima_atualizacao
FROM positions WHERE c IS NOT NULL AND lt0 IS NOT NULL AND lt1 IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY c ORDER BY event_time DESC, event_id DESC) = 1""",
    "placed": """
SELECT prefixo, linha, (SELECT shape_dist_traveled FROM shapes
  WHERE shape_pt_lat BETWEEN latitude - 0.01 AND latitude + 0.01
    AND shape_pt_lon BETWEEN longitude - 0.01 AND longitude + 0.01
  ORDER BY (shape_pt_lat - latitude) * (shape_pt_lat - latitude) + (shape_pt_lon - longitude) * (shape_pt_lon - longitude),
    shape_dist_traveled LIMIT 1) AS metres
FROM latest""",
    "passed": """
SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 2 SECOND AS mark FROM positions""",
    "passed_status": f"""
SELECT p AS prefixo, linha, CASE sl WHEN 2 THEN '{display.INBOUND}' ELSE '{display.OUTBOUND}' END AS sentido,
  round(speed_kmh, 1) AS velocidade_kmh, round(assumed, 2) AS headway_minutos,
  CASE WHEN speed_kmh <= 2.0 THEN '{display.STOPPED}' WHEN assumed > 10.0 THEN '{display.DELAYED}'
    ELSE '{display.NORMAL}' END AS status,
  event_time AS ultima_atualizacao
FROM (SELECT *, CASE WHEN speed_kmh < 3.0 THEN 9.72 ELSE coalesce(gap_km / speed_kmh * 60.0, 7.5) END AS assumed
  FROM motion WHERE event_time <= (SELECT mark FROM passed))
QUALIFY row_number() OVER (PARTITION BY p ORDER BY event_time DESC, event_id DESC) = 1""",
    "extents": """
SELECT route_id AS linha, direction_id, max(shape_dist_traveled) / 1000.0 AS dist_km
FROM shapes JOIN (SELECT DISTINCT route_id, shape_id, direction_id FROM trips) t USING (shape_id)
GROUP BY route_id, direction_id""",
}

_NEEDS = {
    "fixes": ["positions"], "steps": ["fixes"], "speeds": ["steps"], "neighbours": ["positions"], "gaps": ["neighbours"],
    "headways": ["speeds", "gaps"], "motion": ["steps", "gaps"], "latest": ["positions"], "status": ["motion"],
    "passed": ["positions"], "passed_status": ["motion", "passed"], "catalogue": ["positions"], "placed": ["latest", "shapes"], "extents": ["shapes", "trips"],
}


def _closure(names: tuple[str, ...]) -> set[str]:
    found: set[str] = set()
    for name in names:
        found |= {name} | _closure(tuple(_NEEDS.get(name, ())))
    return found


def _only_near(column: str, keys: str) -> str:
    """LAG of a column where the row before is at most the time to live away."""
    window = f"OVER (PARTITION BY {keys} ORDER BY event_time, event_id)"
    return f"CASE WHEN event_time - lag(event_time) {window} <= to_seconds({TTL_SECONDS}) THEN lag({column}) {window} END"


# LAGs with a time to live, in the places of "fixes" and "neighbours".
TTL_BLOCKS = {
    "fixes": f"SELECT *, {_only_near('py', 'p')} AS from_py, {_only_near('px', 'p')} AS from_px, "
             f"{_only_near('event_time', 'p')} AS from_time FROM positions",
    "neighbours": f"SELECT *, {_only_near('py', 'c, sl')} AS near_py, {_only_near('px', 'c, sl')} AS near_px, "
                  f"{_only_near('p', 'c, sl')} AS near_p FROM positions",
}


def _sql(body: str, *blocks: str) -> str:
    """``body`` with the named blocks and all they read put in front as common table expressions."""
    wanted = _closure(blocks)
    ctes = ", ".join(f"{name} AS ({text.strip()})" for name, text in BLOCKS.items() if name in wanted)
    return f"WITH {ctes} {body.strip()}"


_SPEED = ("round(avg(speed_kmh), 2) AS velocidade_media, round(max(speed_kmh), 2) AS velocidade_maxima, "
          "round(min(speed_kmh), 2) AS velocidade_minima")
_HEADWAY = ("round(avg(headway_min), 2) AS headway_medio, round(min(headway_min), 2) AS headway_minimo, "
            "round(max(headway_min), 2) AS headway_maximo")
_MINUTE = ("date_trunc('minute', event_time) AS janela_inicio, "
           "date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS janela_fim")

_ACTIVE = "SELECT c AS linha, count(DISTINCT p) AS total_onibus_ativos, max(event_time) AS ultima_atualizacao FROM positions"
_SPEED_LINE = f"SELECT linha, {_SPEED}, max(event_time) AS ultima_atualizacao FROM speeds WHERE speed_kmh <= 120"
_SPEED_HIST = f"SELECT linha, {_MINUTE}, {_SPEED} FROM speeds WHERE speed_kmh <= 120"
_HEADWAY_LINE = f"SELECT linha, {_HEADWAY}, max(event_time) AS ultima_atualizacao FROM headways"
_HEADWAY_HIST = f"SELECT linha, {_MINUTE}, {_HEADWAY} FROM headways"


def _comma(value: str, places: int) -> str:
    return f"replace(CAST(CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,15)), {places}) AS DECIMAL(24,{places})) AS VARCHAR), '.', ',')"


_WHOLE_SECONDS = "CAST(floor(CAST(headway_minutos AS DECIMAL(12,2)) * 60) AS BIGINT)"
_PANEL = f"""
SELECT prefixo, sentido,
  CAST(CAST(round(CAST(CAST(velocidade_kmh AS VARCHAR) AS DECIMAL(38,15)), 1) AS DECIMAL(24,1)) AS VARCHAR) || ' km/h' AS velocidade,
  lpad(CAST({_WHOLE_SECONDS} // 60 % 60 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST({_WHOLE_SECONDS} % 60 AS VARCHAR), 2, '0') || ' min' AS headway,
  CASE status WHEN '{display.STOPPED}' THEN '{display.STATUS_BADGES[display.STOPPED]}'
    WHEN '{display.DELAYED}' THEN '{display.STATUS_BADGES[display.DELAYED]}' ELSE '{display.STATUS_BADGE_ELSE}' END AS status,
  strftime(ultima_atualizacao, '%H:%M:%S') AS ultima_posicao
FROM status
"""

_LENGTH = f"""
SELECT linha,
  {_comma('coalesce(max(CASE direction_id WHEN 0 THEN dist_km END), 0)', 2)} || ' km' AS extensao_ida,
  {_comma('coalesce(max(CASE direction_id WHEN 1 THEN dist_km END), 0)', 2)} || ' km' AS extensao_volta,
  {_comma('sum(dist_km)', 2)} || ' km' AS extensao_total_ida_e_volta
FROM extents
"""

_SPACING = f"""
SELECT linha, prefixo AS onibus, onibus_a_frente, {_comma('metres', 1)} AS km_acumulado_rota,
  replace(CAST(gap AS VARCHAR), '.', ',') AS dist_entre_onibus_km,
  CASE WHEN gap <= 0.20 THEN '{display.BUNCHED}' WHEN gap >= 5.0 THEN '{display.SERVICE_GAP}'
    WHEN gap >= 3.0 THEN '{display.WIDE}' ELSE '{display.REGULAR}' END AS diagnostico_operacional
FROM (SELECT *, CAST(round(CAST(CAST((metres - lag(metres) OVER w) / 1000.0 AS VARCHAR) AS DECIMAL(38,15)), 2) AS DECIMAL(24,2)) AS gap,
    lag(prefixo) OVER w AS onibus_a_frente
  FROM placed WINDOW w AS (PARTITION BY linha ORDER BY metres NULLS LAST, prefixo))
WHERE gap IS NOT NULL
"""

_RAW = """
raw AS (SELECT event_id, c, CAST(cl AS VARCHAR) AS cl, CAST(sl AS VARCHAR) AS sl, lt0, lt1, CAST(qv AS VARCHAR) AS qv,
  CASE WHEN event_id % 13 = 0 THEN 'bus-' || CAST(p AS VARCHAR) WHEN event_id % 17 <> 0 THEN CAST(p AS VARCHAR) END AS p,
  CASE WHEN event_id % 19 = 0 THEN 'maybe' WHEN a THEN 'true' ELSE 'false' END AS a,
  CASE WHEN event_id % 23 = 0 THEN 'yesterday' ELSE CAST(ta AS VARCHAR) END AS ta, ta_tempo,
  printf('%.4f', py) AS py, printf('%.4f', px) AS px, p AS vehicle, a AS flag, ta AS millis
FROM positions)
"""
_BAD = "event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0"
_CARELESS = """
careless AS (SELECT event_id, CASE WHEN event_id % 29 <> 0 THEN p END AS prefixo,
  CASE WHEN event_id % 11 <> 0 THEN c END AS linha,
  CASE WHEN event_id % 13 = 0 THEN repeat(lt0, 20) ELSE lt0 END AS letreiro_terminal,
  CASE WHEN event_id % 7 <> 0 THEN lt1 END AS letreiro_origem, py AS latitude,
  CASE WHEN event_id % 31 <> 0 THEN px END AS longitude, a AS acessivel, event_time AS ultima_atualizacao FROM positions)
"""


def _with(extra: str, body: str, *blocks: str) -> str:
    """Like :func:`_sql` with one more common table expression at the end."""
    return _sql("", *blocks).rstrip() + f", {extra.strip()} {body.strip()}"


_REPORT = "c, cl, sl, lt0, lt1, qv, p, a, ta, ta_tempo, py, px"
_ISO_REPORT = f"SELECT {_REPORT} FROM positions"
_D = RAW_DIGITS
_EXTENT_LIST = ", ".join(f"'{line}'" for line in EXTENT_LINES)
_JSON_FIELDS = ", ".join(f"'{f.strip()}', {f.strip()}" for f in _REPORT.split(","))


def _panel_sql(panel: Panel, digits: int = RAW_DIGITS) -> str:
    """A panel's metric, computed line by line instead of by bins."""
    tests = [f"{label} = '{value}'" for label, value in panel.equal.items()]
    tests += [f"regexp_full_match({label}, '{regex}')" for label, regex in panel.matching.items()]
    if panel.line:
        tests.append(f"regexp_matches(line, '{panel.line}')")
    extracted = {"jobs": panels.JOB_NAME, "checkpoint_p95": panels.CHECKPOINT_MS}.get(panel.measure)
    if extracted:
        tests.append(f"regexp_matches(line, '{extracted}')")
    chosen = "SELECT * FROM logs WHERE " + " AND ".join(tests)
    if panel.measure == "lines":
        return _sql(f"SELECT ts, container, stream, line FROM ({chosen})", "logs")

    width, stride = seconds_of(panel.span), seconds_of(panel.step or panel.span)
    bin_start = f"make_timestamp(epoch_us(ts) // {stride * 1_000_000} * {stride * 1_000_000})"
    found = f", regexp_extract(line, '{extracted}', 1) AS found" if extracted else ""
    windows = (
        f"windows AS (SELECT *, window_end - to_seconds({width}) AS window_start FROM (SELECT * {found}, "
        f"{bin_start} + to_seconds({stride} * unnest(range(1, {width // stride + 1}))) AS window_end FROM ({chosen})))"
    )
    times = "window_start, window_end"

    def one(value: str, labels: str = "") -> str:
        prefix = f"{labels}, " if labels else ""
        return f"SELECT {prefix}{times}, {value} AS value FROM windows GROUP BY {prefix}{times}"

    simple = {
        "live_containers": one("count(DISTINCT container)"),
        "series": one("count(DISTINCT container || '/' || stream)"),
        "jobs": one("count(DISTINCT found)"),
        "checkpoint_p95": one(f"round(quantile_cont(CAST(found AS DOUBLE), 0.95), {digits})", "container, stream"),
        "entries_by_series": one("count(*)", "container, stream"),
    }
    if panel.measure in simple:
        return _with(windows, simple[panel.measure], "logs")

    amount = "CAST(sum(strlen(line)) AS BIGINT)" if panel.measure.startswith("bytes") else "count(*)"
    per_second = panel.measure in ("rate", "rate_by_container", "bytes_by_container")
    value = f"round({amount} / {float(width)}::DOUBLE, {digits})" if per_second else amount
    labels = "container" if panel.measure.endswith("_by_container") else ""
    metric = one(value, labels)
    if panel.default is None:
        return _with(windows, metric, "logs")
    kind = "DOUBLE" if per_second else "BIGINT"
    steps = (
        f"steps AS (SELECT window_start, window_start + to_seconds({stride}) AS window_end FROM (SELECT unnest("
        f"generate_series(make_timestamp(epoch_us(min(ts)) // {stride}000000 * {stride}000000), "
        f"make_timestamp(epoch_us(max(ts)) // {stride}000000 * {stride}000000), to_seconds({stride}))) AS window_start FROM logs))"
    )
    constant = f"CAST({panel.default} AS {kind})"
    if labels:
        body = (f"SELECT container, {times}, value FROM ({metric}) UNION ALL "
                f"SELECT NULL AS container, {times}, {constant} AS value FROM steps")
    else:
        body = f"SELECT {times}, coalesce(value, {constant}) AS value FROM steps LEFT JOIN ({metric}) USING ({times})"
    return _with(f"{windows}, {steps}", body, "logs")


_BROKEN_PAYLOADS = """
SELECT 'unknown' AS key, unnest(['{"l":[{"c":"' || n_name || '","cl":1,"vs":[{"p":', '{"l":[{"c":"' || n_name || '","vs":{"p":1}}]}',
  '<html><body>' || n_name || '</body></html>']) AS value FROM nation"""

ORACLES: dict[str, str] = {
    "active_vehicles": _sql(f"{_ACTIVE} GROUP BY c", "positions"),
    "speed_by_line": _sql(f"{_SPEED_LINE} GROUP BY linha", "speeds"),
    "speed_history": _sql(f"{_SPEED_HIST} GROUP BY linha, date_trunc('minute', event_time)", "speeds"),
    "headway_by_line": _sql(f"{_HEADWAY_LINE} GROUP BY linha", "headways"),
    "headway_history": _sql(f"{_HEADWAY_HIST} GROUP BY linha, date_trunc('minute', event_time)", "headways"),
    "latest_position": _sql("SELECT * FROM latest", "latest"),
    "vehicle_status": _sql("SELECT * FROM status", "status"),
    "line_catalogue": _sql("SELECT * FROM catalogue", "catalogue"),
    "gps_timestamp": _sql(
        "SELECT event_id, ta_tempo, strptime(ta_tempo, '%Y-%m-%d %H:%M:%S') AS ta_ts FROM positions", "positions"
    ),
    "gps_time_parts": _sql("SELECT event_id, ta, ta_tempo FROM positions", "positions"),
    "vehicle_lag": _sql("SELECT event_id, p, from_py, from_px, from_time FROM fixes", "fixes"),
    "adjacent_lag": _sql("SELECT event_id, c, sl, p, near_py, near_px, near_p FROM neighbours", "neighbours"),
    "segment_distance": _sql(
        f"SELECT event_id, p, round(km, {_D}) AS distance_km, secs AS seconds FROM steps WHERE secs > 0", "steps"
    ),
    "instant_speed": _sql(f"SELECT * REPLACE (round(speed_kmh, {_D}) AS speed_kmh) FROM speeds", "speeds"),
    "speed_valid": _sql(
        f"SELECT * REPLACE (round(speed_kmh, {_D}) AS speed_kmh) FROM speeds WHERE speeds.speed_kmh <= 120", "speeds"
    ),
    "line_gaps": _sql(f"SELECT * REPLACE (round(gap_km, {_D}) AS gap_km) FROM gaps", "gaps"),
    "headway_events": _sql(
        f"SELECT * REPLACE (round(speed_kmh, {_D}) AS speed_kmh, round(gap_km, {_D}) AS gap_km, "
        f"round(headway_min, {_D}) AS headway_min) FROM headways", "headways"
    ),
    "vehicle_motion_left": _sql(
        f"SELECT * REPLACE (round(speed_kmh, {_D}) AS speed_kmh, round(gap_km, {_D}) AS gap_km) FROM motion", "motion"
    ),
    "direction_label": _sql(
        f"SELECT event_id, sl, CASE sl WHEN 2 THEN '{display.INBOUND}' ELSE '{display.OUTBOUND}' END AS sentido "
        "FROM positions", "positions"
    ),
    "decimal_comma": _sql(f"SELECT event_id, {_comma('py', 2)} AS py_text FROM positions", "positions"),
    "lookup_line": _sql(f"{_ACTIVE} WHERE c = '{LINE}' GROUP BY c", "positions"),
    "lookup_line_speed": _sql(f"{_SPEED_LINE} AND linha = '{LINE}' GROUP BY linha", "speeds"),
    "lookup_line_headway": _sql(f"{_HEADWAY_LINE} WHERE linha = '{LINE}' GROUP BY linha", "headways"),
    "speed_history_line": _sql(
        f"{_SPEED_HIST} AND linha = '{LINE}' GROUP BY linha, date_trunc('minute', event_time) ORDER BY janela_fim DESC",
        "speeds"
    ),
    "headway_history_line": _sql(
        f"{_HEADWAY_HIST} WHERE linha = '{LINE}' GROUP BY linha, date_trunc('minute', event_time) "
        "ORDER BY janela_fim DESC", "headways"
    ),
    "positions_sample": _sql(f"SELECT * FROM latest WHERE linha = '{LINE}' ORDER BY prefixo LIMIT 10", "latest"),
    "operations_panel": _sql(f"{_PANEL} WHERE linha = '{LINE}'", "status"),
    "operations_panel_all": _sql(_PANEL, "status"),
    "line_filter_options": _sql(
        "SELECT linha AS __value, linha_descricao AS __text FROM catalogue ORDER BY linha", "catalogue"
    ),
    "nearest_shape": _sql("SELECT prefixo, linha, metres AS dist_percorrida_metros FROM placed", "placed"),
    "route_spacing": _sql(_SPACING, "placed"),
    "distinct_trips": _sql("SELECT DISTINCT route_id, shape_id, direction_id FROM trips", "trips"),
    "route_extent": _sql("SELECT * FROM extents", "extents"),
    "route_length": _sql(f"{_LENGTH} WHERE linha IN ({_EXTENT_LIST}) GROUP BY linha ORDER BY linha", "extents"),
    "route_length_all": _sql(f"{_LENGTH} GROUP BY linha ORDER BY linha", "extents"),
    "flatten_feed": _sql(_ISO_REPORT, "positions"),
    "flatten_checked": _sql(_ISO_REPORT, "positions"),
    "valid_reports": _with(
        _RAW,
        "SELECT event_id, c, CAST(cl AS INT) AS cl, CAST(sl AS INT) AS sl, lt0, lt1, CAST(qv AS INT) AS qv, vehicle AS p, "
        "flag AS a, millis AS ta, ta_tempo, CAST(py AS DOUBLE) AS py, CAST(px AS DOUBLE) AS px "
        f"FROM raw WHERE NOT ({_BAD})", "positions"
    ),
    "dead_letter": _with(
        _RAW,
        "SELECT coalesce(p, 'unknown') AS key, CAST(json_object("
        f"{_JSON_FIELDS}) AS VARCHAR) AS value FROM raw WHERE {_BAD}", "positions"
    ),
    "keyed_messages": _sql(
        f"SELECT CAST(p AS VARCHAR) AS key, CAST(json_object({_JSON_FIELDS}) AS VARCHAR) AS value FROM positions",
        "positions"
    ),
    "dead_payloads": f"SELECT key, value FROM ({_BROKEN_PAYLOADS})",
    "ingest_messages": _sql(
        f"SELECT 'posicoes_sptrans' AS topic, CAST(p AS VARCHAR) AS key, "
        f"CAST(json_object({_JSON_FIELDS}) AS VARCHAR) AS value FROM positions "
        f"UNION ALL SELECT 'posicoes_sptrans_dlq', key, value FROM ({_BROKEN_PAYLOADS})",
        "positions"
    ),
    "upsert_merge": _sql("SELECT * FROM latest", "latest"),
    "constraint_violations": _with(
        _CARELESS,
        "SELECT rule, total FROM (SELECT unnest(['not_null:prefixo', 'not_null:linha', 'not_null:longitude', "
        "'max_length:letreiro_terminal', 'primary_key:prefixo']) AS rule, unnest([count(*) FILTER (prefixo IS NULL), "
        "count(*) FILTER (linha IS NULL), count(*) FILTER (longitude IS NULL), "
        "count(*) FILTER (length(letreiro_terminal) > 100), count(prefixo) - count(DISTINCT prefixo)]) AS total "
        "FROM careless) WHERE total > 0", "positions"
    ),
    "constraint_rejects": _with(
        _CARELESS,
        "SELECT * FROM (SELECT * EXCLUDE (event_id), concat_ws(',', "
        "CASE WHEN length(letreiro_terminal) > 100 THEN 'max_length:letreiro_terminal' END, "
        "CASE WHEN linha IS NULL THEN 'not_null:linha' END, CASE WHEN longitude IS NULL THEN 'not_null:longitude' END, "
        "CASE WHEN prefixo IS NULL THEN 'not_null:prefixo' END) AS broken FROM careless) WHERE broken <> ''", "positions"
    ),
    "log_line_filter": _sql(
        "SELECT ts, container, stream, line FROM logs WHERE regexp_matches(line, '(?i)(checkpoint|completed)')", "logs"
    ),
    **{form: _panel_sql(panels.PANELS[key]) for form, key in LOG_FORMS.items()},
    **{f"panel_{key}": _panel_sql(p) for key, p in panels.PANELS.items() if key not in LOG_FORMS.values()},
}

_ARRIVALS = f"""
arrivals AS (SELECT part, event_time, arrived, make_timestamp(epoch_us(arrived) // {IDLE_POLL * 1_000_000} * {IDLE_POLL * 1_000_000}) AS poll
  FROM (SELECT event_id % 4 AS part, event_time, CASE WHEN event_id % 4 = 3 THEN event_time + INTERVAL 20 MINUTE
    WHEN event_id % 4 = 2 AND event_time >= TIMESTAMP '2024-01-01 02:00:00' AND event_time < TIMESTAMP '2024-01-01 04:00:00'
      THEN TIMESTAMP '2024-01-01 04:00:01' ELSE event_time END AS arrived
  FROM positions WHERE event_id % 4 <> 1 OR event_time < TIMESTAMP '2024-01-01 06:00:00')),
polls AS (SELECT DISTINCT poll, poll + to_seconds({IDLE_POLL}) AS ends FROM arrivals),
sent AS (SELECT poll, part, max(event_time) AS newest, max(arrived) AS seen FROM arrivals GROUP BY ALL),
known AS (SELECT p.poll, p.ends, s.part, max(s.newest) AS newest, max(s.seen) AS seen FROM polls p JOIN sent s ON s.poll <= p.poll GROUP BY ALL),
least AS (SELECT poll, ends, min(newest) FILTER (WHERE ends - seen <= to_seconds({IDLE_AFTER})) AS least,
    count(*) FILTER (WHERE ends - seen <= to_seconds({IDLE_AFTER})) AS active, count(*) FILTER (WHERE ends - seen > to_seconds({IDLE_AFTER})) AS idle
  FROM known GROUP BY ALL),
marks AS (SELECT *, max(least - INTERVAL 2 SECOND) OVER (ORDER BY poll) AS watermark FROM least),
met AS (SELECT poll, lag(watermark) OVER (ORDER BY poll) AS met FROM marks),
counts AS (SELECT poll, count(*) AS rows, count(*) FILTER (WHERE event_time <= met) AS late FROM arrivals JOIN met USING (poll) GROUP BY poll)
"""

def _closed_panel(panel: Panel) -> str:
    """A panel's rows whose range the watermark has passed."""
    mark = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 SECOND FROM logs)"
    sql = _panel_sql(panel)
    return f"{_sql('', 'logs')} SELECT * FROM ({sql}) WHERE window_end <= {mark}"


def _replaced(sql: str) -> str:
    for name, text in TTL_BLOCKS.items():
        sql = sql.replace(f"{name} AS ({BLOCKS[name].strip()})", f"{name} AS ({text})")
    return sql


# Continuous jobs. Ordered rows come out once the watermark, two seconds behind the newest report, has passed them.
_PASSED = "event_time <= (SELECT mark FROM passed)"
_CLOSED = "date_trunc('minute', event_time) + INTERVAL 1 MINUTE <= (SELECT mark FROM passed)"
ORACLES |= {
    "adjacent_lag_chunked": ORACLES["adjacent_lag"],
    "nearest_shape_stored": ORACLES["nearest_shape"],
    "route_spacing_stored": ORACLES["route_spacing"],
    "log_scan_stored": ORACLES["log_scan"],
    "headway_by_line_chunked": ORACLES["headway_by_line"],
    "stream_active_vehicles": ORACLES["active_vehicles"],
    "stream_speed_by_line": _sql(f"{_SPEED_LINE} AND {_PASSED} GROUP BY linha", "speeds", "passed"),
    "stream_speed_history": _sql(
        f"{_SPEED_HIST} AND {_CLOSED} GROUP BY linha, date_trunc('minute', event_time)", "speeds", "passed"
    ),
    "stream_headway_by_line": _sql(f"{_HEADWAY_LINE} WHERE {_PASSED} GROUP BY linha", "headways", "passed"),
    "stream_headway_history": _sql(
        f"{_HEADWAY_HIST} WHERE {_CLOSED} GROUP BY linha, date_trunc('minute', event_time)", "headways", "passed"
    ),
    "stream_latest_position": ORACLES["latest_position"],
    "stream_vehicle_status": _sql("SELECT * FROM passed_status", "passed_status"),
    "stream_line_catalogue": ORACLES["line_catalogue"],
    **{name: _closed_panel(panel) for name, panel in LOG_STREAMS.items()},
    "log_quantile_sketch": _sql(f"""
SELECT container, stream, time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
  count(*) AS "values", true AS within
FROM logs WHERE container = 'flink-jobmanager' AND regexp_matches(line, '{panels.CHECKPOINT_MS}')
  AND ts < (SELECT date_trunc('hour', date_trunc('milliseconds', max(ts)) - INTERVAL 2 SECOND) FROM logs) GROUP BY ALL""", "logs"),
    "active_vehicles_sketch": _sql("""
SELECT c AS linha, date_trunc('hour', event_time) AS window_start, count(DISTINCT p) AS total_onibus_ativos, true AS within
FROM positions WHERE event_time < (SELECT date_trunc('minute', date_trunc('milliseconds', max(event_time)) - INTERVAL 2 SECOND) FROM positions)
GROUP BY ALL""", "positions"),
    "stream_headway_events": _sql(
        f"""SELECT event_id, linha, p, event_time, round(speed_kmh, {_D}) AS speed_kmh, round(gap_km, {_D}) AS gap_km,
  round(headway_min, {_D}) AS headway_min FROM headways WHERE {_PASSED}""", "headways", "passed"),
    "stream_motion_left": _sql(
        f"""SELECT event_id, linha, sl, p, event_time, round(speed_kmh, {_D}) AS speed_kmh, gap_event_id, round(gap_km, {_D}) AS gap_km
FROM motion WHERE {_PASSED}""", "motion", "passed"),
    "stream_vehicle_status_ttl": _replaced(_sql("SELECT * FROM passed_status", "passed_status")),
    "stream_idle_partitions": _with(
        _ARRIVALS, """SELECT ends AS janela_fim, watermark, active, idle, rows, late FROM marks JOIN counts USING (poll)
WHERE poll < (SELECT max(poll) FROM polls)""", "positions"),
}


def _all_jobs() -> str:
    parts = []
    for name, (table, spec) in zip(STREAM_TABLES, TABLES.items(), strict=True):
        parts.append(f"SELECT '{table}' AS tabela, count(*) AS linhas, count(DISTINCT {spec.keys[0]}) AS chaves, "
                     f"max({spec.updated}) AS ultima FROM ({ORACLES[name]})")
    return " UNION ALL ".join(parts)


# The job that keeps each table, in the order of the tables.
STREAM_TABLES = ("stream_active_vehicles", "stream_speed_by_line", "stream_speed_history", "stream_headway_by_line",
                 "stream_headway_history", "stream_latest_position", "stream_vehicle_status", "stream_line_catalogue")
ORACLES["stream_all_jobs"] = _all_jobs()
