"""Independent SQL statements of every registered query, for an ANSI engine (DuckDB).

They read the given tables (``events``, ``customer``) directly and restate each
rule in SQL: the telemetry view, the lookups, the band CASE, the alert OR, the
windows (``time_bucket``) and the seeded hash.
Column names and types match the Spark results so the two can be compared.
"""

from __future__ import annotations

# Every value is written out here, not imported from the code that is checked.
GEAR_BOUNDS = (0, 30, 60, 90, 120, 150, 180)
SPEED_LIMIT = 120
RPM_LIMIT = 6000
COUNTED_COLORS = ("Black", "White", "Silver")
CAR_MODEL_ROWS = ((1, "Mazda", "3"), (2, "Mazda", "6"), (3, "Toyota", "Corolla"), (4, "Hyundai", "i20"),
                  (5, "Kia", "Sportage"), (6, "Kia", "Rio"), (7, "Kia", "Picanto"))
CAR_COLOR_ROWS = ((1, "Black"), (2, "Red"), (3, "Gray"), (4, "White"), (5, "Green"), (6, "Blue"), (7, "Pink"))

# ---------------------------------------------------------------- hashing in SQL
_MULS = (2654435761, 2246822519, 3266489917)


def hash_ctes(source: str, id_expr: str, salts: dict[str, int], name: str = "hx") -> tuple[str, str]:
    """CTEs adding one 31-bit hash column per ``{column: salt}`` to ``source``.

    Same integer mix as ``gearwatch.functions.hashing.hash31``.  Returns the CTE
    text (without a leading WITH) and the name of the last CTE.
    """
    m = 2147483648
    s0 = f"{name}0 AS (SELECT *, xor(({id_expr}), ({id_expr}) >> 31) % {m} AS __fold FROM {source})"
    a = ", ".join(f"((__fold + {salt * 7919 + 1}) * {_MULS[0]}) % {m} AS __a_{c}" for c, salt in salts.items())
    b = ", ".join(f"(xor(__a_{c}, __a_{c} >> 15) * {_MULS[1]}) % {m} AS __b_{c}" for c in salts)
    cc = ", ".join(f"(xor(__b_{c}, __b_{c} >> 13) * {_MULS[2]}) % {m} AS __c_{c}" for c in salts)
    h = ", ".join(f"xor(__c_{c}, __c_{c} >> 16) AS {c}" for c in salts)
    ctes = [
        s0,
        f"{name}1 AS (SELECT *, {a} FROM {name}0)",
        f"{name}2 AS (SELECT *, {b} FROM {name}1)",
        f"{name}3 AS (SELECT *, {cc} FROM {name}2)",
        f"{name}4 AS (SELECT *, {h} FROM {name}3)",
    ]
    return ",\n".join(ctes), f"{name}4"


# ---------------------------------------------------------------- shared views
def band_case(col: str = "speed") -> str:
    whens = " ".join(f"WHEN {col} < {b} THEN {i}" for i, b in enumerate(GEAR_BOUNDS))
    return f"CAST(CASE {whens} ELSE {len(GEAR_BOUNDS)} END AS INTEGER)"


EV = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS event_time,
         TRY_CAST(user_id AS INTEGER) AS car_id,
         value AS speed,
         TRY_CAST(500 + 65 * CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS INTEGER) AS rpm,
         CAST(1 + event_id % 6 AS INTEGER) AS gear
  FROM events)"""

ALL_CARS = """cars AS (
  SELECT c_custkey AS car_id, 100000000 + c_custkey AS driver_id,
         CAST(c_nationkey % 7 + 1 AS BIGINT) AS model_id, CAST(c_custkey % 7 + 1 AS BIGINT) AS color_id,
         c_mktsegment
  FROM customer)"""
# every fifth car has no id yet
CARS = ALL_CARS.replace("c_custkey AS car_id", "CASE WHEN c_custkey % 5 <> 4 THEN c_custkey END AS car_id")


def _values(rows, cols) -> str:
    def lit(v):
        return f"CAST({v} AS BIGINT)" if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


MODELS = f"models AS ({_values(CAR_MODEL_ROWS, ['model_id', 'brand_name', 'model_name'])})"
COLORS = f"colors AS ({_values(CAR_COLOR_ROWS, ['color_id', 'color_name'])})"

ENRICHED_COLS = ("event_id, event_time, car_id, driver_id, brand_name, model_name, color_name, "
                 "speed, rpm, gear, expected_gear")

ENR = f"""enr AS (
  SELECT ev.event_id, ev.event_time, ev.car_id, TRY_CAST(c.driver_id AS INTEGER) AS driver_id,
         m.brand_name, m.model_name, k.color_name, ev.speed, ev.rpm, ev.gear,
         {band_case('ev.speed')} AS expected_gear, ev.ts
  FROM ev LEFT JOIN cars c ON ev.car_id = c.car_id
          LEFT JOIN models m ON c.model_id = m.model_id
          LEFT JOIN colors k ON c.color_id = k.color_id)"""

ALERT_PRED = f"(speed > {SPEED_LIMIT} OR rpm > {RPM_LIMIT} OR gear <> expected_gear)"
ALERTS = f"alerts AS (SELECT * FROM enr WHERE {ALERT_PRED})"

BASE = ",\n".join([EV, CARS, MODELS, COLORS, ENR, ALERTS])


def windows_select(source: str, time_col: str = "ts", minutes: int = 15) -> str:
    cats = ", ".join(
        f"CAST(sum(CASE WHEN color_name = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS num_of_{c.lower()}"
        for c in COUNTED_COLORS)
    b = f"time_bucket(INTERVAL {minutes} MINUTE, {time_col})"
    return f"""SELECT {b} AS window_start, {b} + INTERVAL {minutes} MINUTE AS window_end,
       count(*) AS num_of_rows, {cats},
       max(speed) AS maximum_speed, max(gear) AS maximum_gear, max(rpm) AS maximum_rpm
FROM {source} WHERE {time_col} IS NOT NULL GROUP BY ALL"""


def with_base(sql: str, extra: str = "") -> str:
    return f"WITH {BASE}{',' + extra if extra else ''}\n{sql}"


# ---------------------------------------------------------------- per query
def _json_text(columns: str, texts: set[str]) -> str:
    """Spark's JSON text of ``columns``: fields in order, NULL fields left out."""
    parts = []
    for f in columns.split(", "):
        val = f"to_json({f})" if f in texts else f"CAST({f} AS VARCHAR)"
        parts.append(f"CASE WHEN {f} IS NOT NULL THEN '\"{f}\":' || {val} END")
    return f"'{{' || concat_ws(',', {', '.join(parts)}) || '}}'"


def _json_encode() -> str:
    texts = {"event_id", "event_time", "brand_name", "model_name", "color_name"}
    return with_base(f"SELECT {_json_text(ENRICHED_COLS, texts)} AS value FROM enr")


def _json_damage() -> str:
    ctes, last = hash_ctes("ev", "CAST(event_id AS BIGINT)", {"h": 31})
    return f"""WITH {EV},
{ctes},
cls AS (SELECT *, h % 8 AS k FROM {last})
SELECT CASE WHEN k >= 5 THEN event_id END AS event_id,
       CASE WHEN k = 7 THEN event_time END AS event_time,
       CASE WHEN k = 7 THEN car_id END AS car_id,
       CASE WHEN k = 5 THEN 150.0 WHEN k = 7 THEN speed END::DOUBLE AS speed,
       CASE WHEN k >= 6 THEN rpm END AS rpm,
       CASE WHEN k = 7 THEN gear END AS gear
FROM cls"""


def _json_quarantine() -> str:
    ctes, last = hash_ctes("ev", "CAST(event_id AS BIGINT)", {"h": 31})
    whole = _json_text("event_id, event_time, car_id, speed, rpm, gear", {"event_id", "event_time"})
    return f"""WITH {EV},
{ctes},
cls AS (SELECT *, h % 8 AS k FROM {last})
SELECT CASE WHEN k >= 5 THEN event_id END AS event_id,
       CASE WHEN k = 7 THEN event_time END AS event_time,
       CASE WHEN k = 7 THEN car_id END AS car_id,
       CASE WHEN k = 5 THEN 150.0 WHEN k = 7 THEN speed END::DOUBLE AS speed,
       CASE WHEN k >= 6 THEN rpm END AS rpm,
       CASE WHEN k = 7 THEN gear END AS gear,
       k <> 7 AS damaged,
       CASE k WHEN 0 THEN '{{bad' || {whole} WHEN 1 THEN 'null' WHEN 2 THEN '[' || {whole} || ']' WHEN 3 THEN ''
              WHEN 5 THEN '{{"event_id":"' || event_id || '","car_id":99999999999,"speed":150,"rpm":3200.0,"gear":"4"}}'
              WHEN 6 THEN '{{"event_id":"' || event_id || '","speed":"fast","rpm":' || coalesce(CAST(rpm AS VARCHAR), 'null')
                          || ',"extra":1}}' END AS text
FROM cls"""


def _null_logic() -> str:
    ctes, last = hash_ctes("ev0", "CAST(event_id AS BIGINT)", {"h": 41})
    return f"""WITH {CARS}, {MODELS}, {COLORS},
ev0 AS ({EV[len('ev AS ('):-1]}),
{ctes},
ev AS (SELECT event_id, ts, event_time, car_id,
              CASE WHEN h % 4 IN (0, 3) THEN NULL ELSE speed END AS speed,
              CASE WHEN h % 4 IN (2, 3) THEN NULL ELSE rpm END AS rpm,
              CASE WHEN h % 4 IN (1, 3) THEN NULL ELSE gear END AS gear
       FROM {last}),
{ENR},
{ALERTS}
SELECT event_id, speed, rpm, gear, expected_gear FROM alerts"""


def _remapped(salt: int, column: str, value: str) -> str:
    """The shared views with one event column replaced for a third of the events."""
    ctes, last = hash_ctes("ev0", "CAST(event_id AS BIGINT)", {"h": salt})
    cols = ["event_id", "ts", "event_time", "car_id", "speed", "rpm", "gear"]
    sel = ", ".join(f"CASE WHEN h % 3 = 0 THEN {value} ELSE {c} END AS {c}" if c == column else c
                    for c in cols)
    return f"""WITH {CARS}, {MODELS}, {COLORS},
ev0 AS ({EV[len('ev AS ('):-1]}),
{ctes},
ev AS (SELECT {sel} FROM {last}),
{ENR},
{ALERTS}"""


def _hot_car() -> str:
    """A third of the events on car 7, a seventh of the others without a car."""
    hot, a = hash_ctes("ev0", "CAST(event_id AS BIGINT)", {"h": 61})
    none, b = hash_ctes(a, "CAST(event_id AS BIGINT)", {"g": 62}, name="gx")
    return f"""WITH {CARS}, {MODELS}, {COLORS},
ev0 AS ({EV[len('ev AS ('):-1]}),
{hot},
{none},
ev AS (SELECT event_id, ts, event_time, CASE WHEN h % 3 = 0 THEN CAST(7 AS INTEGER) WHEN g % 7 <> 0 THEN car_id END AS car_id,
              speed, rpm, gear FROM {b}),
{ENR},
{ALERTS}"""


def _parse_event_time() -> str:
    ctes, last = hash_ctes("ev", "CAST(event_id AS BIGINT)", {"h": 51})
    return f"""WITH {EV},
{ctes},
cls AS (SELECT *, h % 4 AS k FROM {last})
SELECT event_id,
       CASE k WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')
              WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
              WHEN 2 THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%f+02:00')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS event_time,
       CASE k WHEN 0 THEN ts WHEN 1 THEN date_trunc('millisecond', ts) WHEN 2 THEN ts END AS event_time_ts
FROM cls"""


def _inject_alert() -> str:
    row = ("SELECT TIMESTAMP '2024-01-15 12:05:00' AS ts, 'Blue' AS color_name, CAST(150.5 AS DOUBLE) AS speed, "
           "CAST(3200 AS INTEGER) AS rpm, CAST(4 AS INTEGER) AS gear")
    return with_base(windows_select("all_alerts"),
                     f"all_alerts AS (SELECT ts, color_name, speed, rpm, gear FROM alerts UNION ALL {row})")


def statements() -> dict[str, str]:
    enriched = with_base(f"SELECT {ENRICHED_COLS} FROM enr")
    alerts = with_base(f"SELECT {ENRICHED_COLS} FROM alerts")
    windows = with_base(windows_select("alerts"))
    return {
        "scan_events": f"WITH {EV}\nSELECT event_id, ts, event_time, car_id, speed, rpm, gear FROM ev",
        "scan_dim": f"WITH {ALL_CARS}\nSELECT car_id, driver_id, model_id, color_id FROM cars",
        "dim_roundtrip": f"WITH {ALL_CARS}\nSELECT car_id, driver_id, model_id, color_id FROM cars",
        "literal_dims": f"""WITH {ALL_CARS}, {MODELS}, {COLORS}
SELECT c.car_id, c.driver_id, m.brand_name, m.model_name, k.color_name
FROM cars c LEFT JOIN models m ON c.model_id = m.model_id LEFT JOIN colors k ON c.color_id = k.color_id""",
        "expected_gear": f"WITH {EV}\nSELECT event_id, speed, {band_case()} AS expected_gear FROM ev",
        "enrich_left": f"""WITH {EV}, {CARS}
SELECT ev.event_id, ev.car_id, c.driver_id, c.model_id, c.color_id
FROM ev LEFT JOIN cars c ON ev.car_id = c.car_id""",
        "join_fanout": f"""WITH {EV}, {CARS},
fan AS (SELECT car_id, driver_id FROM cars
        UNION ALL SELECT car_id, driver_id + 500000000 FROM cars WHERE c_mktsegment = 'AUTOMOBILE')
SELECT ev.event_id, ev.car_id, f.driver_id FROM ev LEFT JOIN fan f ON ev.car_id = f.car_id""",
        "enrich_snowflake": enriched,
        "enrich_hot_car": _hot_car()
        + f"\nSELECT {ENRICHED_COLS} FROM enr",
        "json_roundtrip": enriched,
        "json_encode": _json_encode(),
        "json_damage": _json_damage(),
        "json_quarantine": _json_quarantine(),
        "rule_speed": with_base(f"SELECT {ENRICHED_COLS} FROM enr WHERE speed > {SPEED_LIMIT}"),
        "rule_rpm": with_base(f"SELECT {ENRICHED_COLS} FROM enr WHERE rpm > {RPM_LIMIT}"),
        "rule_gear": with_base(f"SELECT {ENRICHED_COLS} FROM enr WHERE gear <> expected_gear"),
        "alerts_any": alerts,
        "alerts_null_logic": _null_logic(),
        "parse_event_time": _parse_event_time(),
        "window_metrics": windows,
        "fused_alert_windows": windows,
        "window_hot": _remapped(71, "ts", "TIMESTAMP '2024-01-10 10:07:00'") + "\n" + windows_select("alerts"),
        "staged_topic_hops": windows,
        "inject_alert": _inject_alert(),
        "preview": with_base(f"SELECT {ENRICHED_COLS} FROM alerts ORDER BY ts, event_id LIMIT 5"),
        "stream_enrich": enriched,
        "stream_alerts": alerts,
        "stream_window_complete": windows,
        "stream_window_update": windows,
        "stream_window_append": with_base(
            "SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM alerts) - INTERVAL 48 HOUR",
            f"w AS ({windows_select('alerts')})"),
        "stream_late_data": with_base(windows_select("later"), """later AS (
  SELECT * FROM alerts WHERE ts >= (
    SELECT date_trunc('hour', min(ts) + (max(ts) - min(ts)) / 2) FROM events))"""),
        "stream_restart": windows,
        "stream_window_partials": windows,
        "stream_late_rows": with_base(
            f"""SELECT *, false AS late FROM ({windows_select('counted')})
UNION ALL SELECT *, true AS late FROM ({windows_select('behind')})""",
            """halves AS (SELECT *, ts >= (SELECT date_trunc('hour', min(ts) + (max(ts) - min(ts)) / 2) FROM events) AS first FROM alerts),
marked AS (SELECT *, NOT first AND time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE
             <= (SELECT max(ts) FROM halves WHERE first) - INTERVAL 48 HOUR AS is_late FROM halves),
counted AS (SELECT * FROM marked WHERE NOT coalesce(is_late, false)), behind AS (SELECT * FROM marked WHERE is_late)"""),
        "stream_fused": windows,
        "topic_chain_stream": windows,
        "stream_refreshed_dims": with_base(f"""SELECT {ENRICHED_COLS.replace('driver_id', "CAST(driver_id + CASE WHEN ts >= "
            "(SELECT date_trunc('hour', min(ts) + (max(ts) - min(ts)) / 2) FROM events) THEN 500000000 ELSE 0 END AS INTEGER) AS driver_id")}
FROM enr"""),
        "topic_chain_dedup": windows,
        "topic_chain_ordered": with_base('SELECT car_id, count(*) AS n_records, CAST(0 AS BIGINT) AS n_breaks, '
                                         'min(ts) AS "first", max(ts) AS "last" FROM alerts GROUP BY car_id'),
        "stream_state_audit": with_base(
            """SELECT window_start, window_end, false AS behind, m AS mode FROM w, (VALUES ('update'), ('append')) modes(m)
WHERE window_end > (SELECT max(ts) FROM alerts) - INTERVAL 48 HOUR""", f"w AS ({windows_select('alerts')})"),
        "topic_from_latest": with_base(f"""SELECT {ENRICHED_COLS} FROM alerts
WHERE ts >= (SELECT date_trunc('hour', min(ts) + (max(ts) - min(ts)) / 2) FROM events)"""),
    }
