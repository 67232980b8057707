"""For each catalogue query the SQL another engine can run on the same tables."""

from __future__ import annotations

from odolake import schemas as S

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
D = "CAST({} AS DOUBLE)".format


def _ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def _even(expr: str, digits: int) -> str:
    scale = D(10**digits)
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


EV = """ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(100 AS DOUBLE) - value / CAST(4 AS DOUBLE) AS battery
  FROM events)"""

BRONZE = EV + """, bronze AS (
  SELECT event_id + 1 AS id,
    CASE WHEN user_id % 50 = 0 THEN 'VF-U' || user_id ELSE printf('VF-%03d', user_id) END AS vehicle_id, ts AS event_timestamp,
    ts + to_seconds(k) AS received_at, battery AS battery_pct,
    battery * CAST(0.5625 AS DOUBLE) AS state_of_charge_kwh,
    CAST(300 AS DOUBLE) + battery * CAST(0.85 AS DOUBLE) AS voltage_v,
    CASE WHEN event_type = 'click' THEN -(k * CAST(1.25 AS DOUBLE) + CAST(2 AS DOUBLE))
         ELSE k * CAST(1.75 AS DOUBLE) + CAST(12.5 AS DOUBLE) END AS current_a,
    CASE WHEN event_type = 'error' AND k = 99 THEN NULL
         ELSE CAST(24 AS DOUBLE) + k * CAST(0.625 AS DOUBLE)
              + CASE WHEN user_id % 40 = 7 THEN CAST(20 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS motor_temp_c,
    CAST(47 AS DOUBLE) + (user_id % 30) / CAST(8 AS DOUBLE) AS latitude,
    CAST(8 AS DOUBLE) + k / CAST(50 AS DOUBLE) AS longitude,
    CAST(event_id * 7 % 120 + 5 AS DOUBLE) AS speed_kmh,
    (event_type = 'click') AS regen_braking_event
  FROM ev)"""

VEHICLES = """vehicles AS (
  SELECT printf('VF-%03d', c_custkey) AS vehicle_id, c_name AS fleet_label,
    CASE c_custkey % 3 WHEN 1 THEN 'Lumo' ELSE 'Ostrava' END AS make,
    CASE c_custkey % 3 WHEN 0 THEN 'E3' WHEN 1 THEN 'Kastenwagen' ELSE 'E5 lang' END AS model,
    CAST(2015 + c_custkey % 9 AS INTEGER) AS manufacture_year,
    CASE c_custkey % 3 WHEN 0 THEN CAST(58 AS DOUBLE) WHEN 1 THEN CAST(77.5 AS DOUBLE) ELSE CAST(91.25 AS DOUBLE) END
      AS rated_capacity_kwh,
    r_name AS region,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '4.1' WHEN 'BUILDING' THEN '4.2'
      WHEN 'FURNITURE' THEN '5.0' WHEN 'MACHINERY' THEN '5.3' ELSE '6.0' END AS software_version
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _skip(rows: str) -> str:
    nulls = " ".join(f"WHEN {r.name} IS NULL THEN 'null_field:{r.name}'" for r in S.NUMERIC_RULES)
    ranges = " ".join(
        f"WHEN {r.name} < {r.low} OR {r.name} > {r.high} THEN 'out_of_range:{r.name}'" for r in S.NUMERIC_RULES)
    return f"""SELECT b.*, v.rated_capacity_kwh, v.manufacture_year, v.region,
      CASE WHEN v.rated_capacity_kwh IS NULL THEN 'unknown_vehicle' {nulls} {ranges} END AS skip_reason
      FROM {rows} b LEFT JOIN vehicles v ON b.vehicle_id = v.vehicle_id"""


ASSESSED = f"{BRONZE}, {VEHICLES}, assessed AS ({_skip('bronze')})"
MEASURES = ", ".join(S.MEASURES)
SILVER = f"""{ASSESSED}, silver AS (
  SELECT id AS bronze_id, vehicle_id, event_timestamp, {MEASURES},
    COALESCE(CAST(regen_braking_event AS INTEGER), 0) AS regen_braking_event,
    rated_capacity_kwh, manufacture_year, region, received_at AS processed_at
  FROM assessed WHERE skip_reason IS NULL)"""

AVERAGED = ("battery_pct", "voltage_v", "current_a", "motor_temp_c", "speed_kmh")


def _health(battery: str, temp: str, volt: str, rate: str) -> str:
    return f"""greatest({D(0)}, least({D(100)},
      {battery} / {D(100)} * {D(40)}
      + greatest({D(0)}, {D(30)} - greatest({D(0)}, {temp} - {D(40)}) * {D(0.375)})
      + greatest({D(0)}, least({D(20)}, ({volt} - {D(300)}) / {D(80)} * {D(20)}))
      + greatest({D(0)}, {D(10)} - {rate} / {D(1.5)} * {D(10)})))"""


def _gold_select(start: str, end: str, source: str) -> str:
    means = ", ".join(f"{_even('m_' + m, 2)} AS avg_{m}" for m in AVERAGED)
    return f"""SELECT vehicle_id, {start} AS window_start, {end} AS window_end, {means},
      {_even('rate', 4)} AS rolling_5min_discharge_rate,
      {_even(_health('m_battery_pct', 'm_motor_temp_c', 'm_voltage_v', 'rate'), 1)} AS health_score,
      record_count, {end} AS aggregated_at FROM {source}"""


def _rate(old: str, new: str, first: str, last: str) -> str:
    days = f"((epoch_us({last}) - epoch_us({first})) / {D(60_000_000)} / {D(1440)})"
    return f"CASE WHEN {days} > 0 THEN ({old} - {new}) / {days} ELSE {D(0)} END"


def _means(cond: str = "") -> str:
    return ", ".join(f"avg({m}){cond} AS m_{m}" for m in AVERAGED)


SNAPSHOT = f"""{SILVER}, recent AS (
  SELECT * FROM silver WHERE event_timestamp >= {AS_OF} - INTERVAL 5 DAY),
ends AS (
  SELECT vehicle_id, arg_min(battery_pct, event_timestamp) AS oldest, arg_max(battery_pct, event_timestamp) AS newest,
    min(event_timestamp) AS first_at, max(event_timestamp) AS last_at FROM recent GROUP BY vehicle_id),
inside AS (
  SELECT vehicle_id, {_means()}, count(*) AS record_count FROM recent
  WHERE event_timestamp >= {AS_OF} - INTERVAL 1 DAY GROUP BY vehicle_id),
rated AS (
  SELECT i.*, {_rate('oldest', 'newest', 'first_at', 'last_at')} AS rate
  FROM inside i JOIN ends e ON i.vehicle_id = e.vehicle_id),
snapshot AS ({_gold_select(AS_OF + " - INTERVAL 1 DAY", AS_OF, "rated")})"""

GOLD = f"""{SILVER}, days AS (
  SELECT vehicle_id, date_trunc('day', event_timestamp) AS day, {_means()}, count(*) AS record_count
  FROM silver GROUP BY ALL),
spans AS (
  SELECT d.vehicle_id, d.day, arg_min(s.battery_pct, s.event_timestamp) AS oldest,
    arg_max(s.battery_pct, s.event_timestamp) AS newest,
    min(s.event_timestamp) AS first_at, max(s.event_timestamp) AS last_at
  FROM days d JOIN silver s ON s.vehicle_id = d.vehicle_id
    AND s.event_timestamp >= d.day - INTERVAL 4 DAY AND s.event_timestamp < d.day + INTERVAL 1 DAY
  GROUP BY ALL),
slid AS (
  SELECT d.*, {_rate('oldest', 'newest', 'first_at', 'last_at')} AS rate
  FROM days d JOIN spans s ON d.vehicle_id = s.vehicle_id AND d.day = s.day),
gold AS ({_gold_select("CAST(day AS TIMESTAMP)", "CAST(day AS TIMESTAMP) + INTERVAL 1 DAY", "slid")})"""

PREDICTIONS = GOLD + ", predictions AS (" + " UNION ALL ".join(
    f"""SELECT vehicle_id, window_start, {_even(f'(health_score - {D(cut)}) / {D(100)}', 4)} AS anomaly_score,
      {_even(f'(health_score - {D(cut)}) / {D(100)}', 4)} < 0 AS is_anomaly, 'v1.0' AS model_version,
      '{mode}' AS mode, window_end AS predicted_at FROM gold"""
    for mode, cut in (("production", 80), ("shadow", 76))) + ")"

RUNS = PREDICTIONS + """, flagged AS (
  SELECT *, (is_anomaly AND COALESCE(lag(is_anomaly) OVER (PARTITION BY vehicle_id ORDER BY window_start), FALSE)) AS confirmed,
    sum(CASE WHEN is_anomaly THEN 0 ELSE 1 END) OVER (PARTITION BY vehicle_id ORDER BY window_start
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM predictions WHERE mode = 'production'),
runs AS (
  SELECT f.*, CASE WHEN is_anomaly THEN min(CASE WHEN is_anomaly THEN window_start END)
    OVER (PARTITION BY vehicle_id, run) END AS run_started_at FROM flagged f)"""

# the chain of alerts: each candidate in time order against the last alert raised
ALERTS = RUNS + """, cand AS (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY predicted_at) AS rn FROM runs WHERE confirmed),
chain AS (
  SELECT vehicle_id, rn, window_start, predicted_at, anomaly_score, run_started_at, TRUE AS fires,
    predicted_at AS last_at, anomaly_score AS last_score FROM cand WHERE rn = 1
  UNION ALL
  SELECT c.vehicle_id, c.rn, c.window_start, c.predicted_at, c.anomaly_score, c.run_started_at, c.fires,
    CASE WHEN c.fires THEN c.predicted_at ELSE c.last_at END, CASE WHEN c.fires THEN c.anomaly_score ELSE c.last_score END
  FROM (SELECT n.*, p.last_at, p.last_score,
          (p.last_at < n.predicted_at - INTERVAL 96 HOUR
           OR abs(n.anomaly_score) > abs(p.last_score) * CAST(1.2 AS DOUBLE)) AS fires
        FROM chain p JOIN cand n ON n.vehicle_id = p.vehicle_id AND n.rn = p.rn + 1) c),
alerts AS (
  SELECT vehicle_id, window_start AS first_detected_at, run_started_at, anomaly_score, 'open' AS status,
    predicted_at AS created_at FROM chain WHERE fires)"""


# --- raw JSON text and its validation -----------------------------------------

def _case(default: str, cases: dict[int, str]) -> str:
    return "CASE m " + " ".join(f"WHEN {k} THEN {v}" for k, v in cases.items()) + f" ELSE {default} END"


def _iso(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S.%f')"


def _q(expr: str) -> str:
    return f"'\"' || {expr} || '\"'"


def _raw() -> str:
    vid = _case(_q("vehicle_id"), {
        9: "'\"bus 12\"'", 10: "'7'", 19: "'\"  ' || vehicle_id || ' \"'", 26: "'\"\"'",
        27: "'\"\\t' || vehicle_id || '\\n\"'", 28: "'\"' || vehicle_id || '\\u00a0\"'"})
    stamp = _case(_q(_iso("event_timestamp") + " || '+00:00'"), {
        12: _q(_iso("received_at + INTERVAL 90 SECOND") + " || 'Z'"), 13: "'\"yesterday at noon\"'",
        16: _q(_iso("event_timestamp") + " || 'Z'"), 17: _q(_iso("event_timestamp + INTERVAL 3 HOUR") + " || '+03:00'"),
        20: "'86400'", 24: _q("strftime(event_timestamp, '%Y%m%dT%H%M%S')"),
        29: _q(_iso("event_timestamp") + " || '+00:00\\t'")})
    battery = _case("printf('%.4f', battery_pct)", {
        4: "'null'", 5: "'\"61.5\"'", 6: "'\"half\"'", 7: "'100.25'", 15: "'true'", 23: "'-3'", 25: "'NaN'", 30: "'-0.0005'",
        31: "'-0.00002'", 32: "'25000000'", 33: "'3e22'", 34: "'\"4_2\"'", 35: "'\"_42\"'", 36: "'\" Infinity\\t\"'",
        37: "'\"1e400\"'"})
    temp = _case("COALESCE(printf('%.3f', motor_temp_c), 'null')", {8: "'181.5'"})
    regen = _case("CASE WHEN regen_braking_event THEN 'true' ELSE 'false' END", {11: "'0'", 22: "'\"true\"'"})
    parts = [
        ("vehicle_id", vid), ("event_timestamp", stamp), ("battery_pct", battery),
        ("state_of_charge_kwh", f"printf('%.6f', battery_pct * {D(0.5)})"),
        ("voltage_v", "printf('%.6f', voltage_v)"), ("current_a", "printf('%.2f', current_a)"),
        ("motor_temp_c", temp), ("latitude", "printf('%.3f', latitude)"),
        ("longitude", "printf('%.2f', longitude)"), ("speed_kmh", "printf('%.1f', speed_kmh)"),
        ("regen_braking_event", regen),
    ]
    left_out = {"battery_pct": "m = 3", "motor_temp_c": "motor_temp_c IS NULL AND id % 2 = 0 AND m <> 8"}
    members = []
    for name, text in parts:
        member = f"'\"{name}\": ' || {text}"
        members.append(f"CASE WHEN {left_out[name]} THEN NULL ELSE {member} END" if name in left_out else member)
    members.append("CASE m WHEN 14 THEN '\"note\": \"' || repeat('z', 4500) || '\"' WHEN 18 THEN '\"speed_kmh\": 41.0' END")
    body = "'{' || concat_ws(', ', " + ", ".join(members) + ") || '}'"
    raw = _case(body, {0: "''", 1: "'{\"vehicle_id\": '", 2: "'[\"a\", 3]'", 21: "'null'"})
    return f"""{BRONZE}, raw AS (
      SELECT id, received_at, {raw} AS raw_payload, '10.1.0.' || (id % 200) AS client_ip FROM (SELECT *, id % 44 AS m FROM bronze))"""


def _py_type(kind: str) -> str:
    return (f"CASE WHEN {kind} IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'int' WHEN {kind} = 'DOUBLE' THEN 'float' "
            f"WHEN {kind} = 'VARCHAR' THEN 'str' WHEN {kind} = 'BOOLEAN' THEN 'bool' "
            f"WHEN {kind} = 'ARRAY' THEN 'list' ELSE 'dict' END")


_BLANKS = "regexp_replace({}, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g')"


def _inspected() -> str:
    extract = ", ".join(
        f"json_type(doc, '$.{r.name}') AS t_{r.name}, json_extract_string(doc, '$.{r.name}') AS s_{r.name}"
        for r in S.TELEMETRY_RULES)
    # this engine keeps the first of repeated keys where the last one counts
    extract = extract.replace("json_extract_string(doc, '$.speed_kmh')",
                              "regexp_extract_all(doc, '\"speed_kmh\": ([^,}]+)', 1)[-1]")
    typed = []
    for r in S.TELEMETRY_RULES:
        t, s = f"t_{r.name}", f"s_{r.name}"
        if r.kind == "string":
            typed.append(f"CASE WHEN {t} = 'VARCHAR' THEN {_BLANKS.format(s)} END AS v_{r.name}")
        elif r.kind == "boolean":
            typed.append(f"CASE WHEN {t} = 'BOOLEAN' THEN {s} = 'true' END AS v_{r.name}")
        else:
            typed.append(f"CASE WHEN {t} = 'BOOLEAN' THEN CASE WHEN {s} = 'true' THEN {D(1)} ELSE {D(0)} END "
                         f"WHEN {t} IN ('ARRAY', 'OBJECT') THEN NULL "
                         f"WHEN regexp_matches({_BLANKS.format(s)}, '(?i)^[+-]?([0-9]+(_[0-9]+)*([.][0-9]*)?(e[+-]?[0-9]+)?|inf|infinity)$') "
                         f"THEN CASE WHEN regexp_matches({s}, 'e[0-9]{{3}}') THEN CAST('inf' AS DOUBLE) "
                         f"ELSE TRY_CAST(replace({_BLANKS.format(s)}, '_', '') AS DOUBLE) END END AS v_{r.name}")
    checks = []
    for r in S.TELEMETRY_RULES:
        t, v = f"t_{r.name}", f"v_{r.name}"
        checks.append(f"WHEN {t} IS NULL OR {t} = 'NULL' THEN 'missing_field:{r.name}'")
        if r.kind == "double":
            checks.append(f"WHEN {v} IS NULL THEN 'invalid_type:{r.name}:cannot_coerce_to_float'")
            checks.append(f"WHEN {v} < {r.low} THEN 'out_of_range:{r.name}:' || CAST({v} AS VARCHAR) || '<min({r.low})'")
            checks.append(f"WHEN {v} > {r.high} THEN 'out_of_range:{r.name}:' || CAST({v} AS VARCHAR) || '>max({r.high})'")
        else:
            label = {"string": "str", "boolean": "bool"}[r.kind]
            checks.append(f"WHEN {v} IS NULL THEN 'invalid_type:{r.name}:expected_{label}:got_' || {_py_type(t)}")
    return f"""{_raw()}, docs AS (
      SELECT *, octet_length(encode(raw_payload)) AS size, CASE WHEN json_valid(raw_payload) AND NOT regexp_matches(raw_payload, ': NaN[,}}]') THEN raw_payload END AS doc FROM raw),
    fields AS (SELECT *, json_type(doc) AS shape, {extract} FROM docs),
    typed AS (SELECT *, {', '.join(typed)} FROM fields),
    timed AS (SELECT *, CASE WHEN regexp_matches(v_event_timestamp, '^[0-9]{{8}}T[0-9]{{6}}$')
        THEN TRY_CAST(try_strptime(v_event_timestamp, '%Y%m%dT%H%M%S') AS TIMESTAMP)
        WHEN regexp_matches(v_event_timestamp, '^[0-9]{{4}}-') THEN make_timestamp(epoch_us(TRY_CAST(v_event_timestamp AS TIMESTAMPTZ))) END AS moment FROM typed),
    entered AS (SELECT *, CASE WHEN size > 4096 THEN 'payload_too_large' WHEN size = 0 THEN 'empty_body'
        WHEN doc IS NULL THEN 'invalid_json' WHEN shape <> 'OBJECT' THEN 'invalid_format:payload_must_be_json_object'
        WHEN t_vehicle_id IS NULL OR t_vehicle_id <> 'VARCHAR' OR s_vehicle_id = '' THEN 'missing_field:vehicle_id'
        END AS entry_reason FROM timed),
    inspected AS (SELECT *, CASE WHEN entry_reason IS NOT NULL THEN entry_reason {' '.join(checks)}
        WHEN moment IS NULL THEN 'invalid_timestamp:event_timestamp:not_iso8601:' || v_event_timestamp
        WHEN moment > received_at + INTERVAL 60 SECOND THEN 'invalid_timestamp:event_timestamp:more_than_60s_in_future'
        WHEN NOT regexp_full_match(v_vehicle_id, 'VF-[0-9]{{3}}') THEN 'invalid_vehicle_id:' || v_vehicle_id || ':must_match_VF-NNN'
        END AS reason FROM entered)"""


INSPECTED = _inspected()
DLQ = INSPECTED + """, dlq AS (
  SELECT id, received_at, raw_payload, reason AS error_reason, client_ip FROM inspected
  WHERE reason IS NOT NULL AND reason <> 'payload_too_large')"""

INTERVAL = 144_000_000_000  # microseconds per token at a quarter token per ten hours


def _bucket(source: str, key: str) -> str:
    return f"""arrivals AS (
      SELECT {key} AS key, id, epoch_us(received_at) AS t,
        row_number() OVER (PARTITION BY {key} ORDER BY received_at, id) AS rn FROM {source} WHERE {key} IS NOT NULL),
    bucket AS (
      SELECT key, id, rn, t, CAST({2 * INTERVAL} AS BIGINT) AS credit, TRUE AS allowed FROM arrivals WHERE rn = 1
      UNION ALL
      SELECT key, id, rn, t, CAST(CASE WHEN c >= {INTERVAL} THEN c - {INTERVAL} ELSE c END AS BIGINT), c >= {INTERVAL}
      FROM (SELECT a.*, least({3 * INTERVAL}, b.credit + a.t - b.t) AS c
            FROM bucket b JOIN arrivals a ON a.key = b.key AND a.rn = b.rn + 1) q)"""


LIMITED = INSPECTED + ", charged AS (SELECT *, CASE WHEN entry_reason IS NULL THEN s_vehicle_id END AS sent_key FROM inspected), " \
    + _bucket("charged", "sent_key") + """, routed AS (
  SELECT i.*, CASE WHEN entry_reason = 'payload_too_large' THEN 'rejected_too_large'
    WHEN entry_reason IS NOT NULL THEN 'rejected_validation' WHEN NOT COALESCE(b.allowed, TRUE) THEN 'rejected_rate_limit'
    WHEN reason IS NOT NULL THEN 'rejected_validation' ELSE 'accepted' END AS outcome
  FROM inspected i LEFT JOIN bucket b ON i.id = b.id)"""

WITH, REC = "WITH ", "WITH RECURSIVE "

_FAULTY = BRONZE + ", faulty AS (SELECT * REPLACE (CAST(100 AS DOUBLE) - (CAST(100 AS DOUBLE) - battery_pct) " \
    "* CAST(4 AS DOUBLE) AS battery_pct) FROM bronze)"


def _summary(rows: str, by: str) -> str:
    group = f" GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}count(*) AS records_read, count(*) FILTER (skip_reason IS NOT NULL) AS records_failed,
      round(count(*) FILTER (skip_reason IS NOT NULL) / CAST(count(*) AS DOUBLE), 6) AS failure_rate,
      CASE WHEN count(*) FILTER (skip_reason IS NOT NULL) / CAST(count(*) AS DOUBLE) > CAST(0.10 AS DOUBLE) THEN 0
        ELSE count(*) FILTER (skip_reason IS NULL) END AS records_written,
      CAST(count(*) FILTER (skip_reason IS NOT NULL) / CAST(count(*) AS DOUBLE) > CAST(0.10 AS DOUBLE) AS INTEGER) AS circuit_open
      FROM {rows}{group}"""


_NUMBERED = "numbered AS (SELECT *, CAST(floor((id - 1) / CAST(1000 AS DOUBLE)) AS BIGINT) AS batch FROM assessed)"
_TRIPPED = _NUMBERED + """, tripped AS (SELECT batch FROM numbered GROUP BY batch
  HAVING count(*) FILTER (skip_reason IS NOT NULL) / CAST(count(*) AS DOUBLE) > CAST(0.02 AS DOUBLE))"""

_LATEST_GOLD = "(SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY aggregated_at DESC) = 1)"
_LATEST_PRED = ("(SELECT * FROM predictions WHERE mode = 'production' "
                "QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY predicted_at DESC) = 1)")
_NEWEST_ALERT = "(SELECT * FROM alerts QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY created_at DESC) = 1)"

FLEET = f"""heads AS (SELECT * FROM {_LATEST_GOLD} h),
means AS (SELECT {', '.join(f'avg({f}) AS mu_{f}' for f in S.FEATURES)} FROM heads),
devs AS (
  {' UNION ALL '.join(
      f"SELECT vehicle_id, {i} AS pos, '{f}' AS name, CASE WHEN mu_{f} IS NULL OR mu_{f} = 0 THEN {D(0)} "
      f"ELSE abs(({f} - mu_{f}) / mu_{f}) END AS dev FROM heads, means" for i, f in enumerate(S.FEATURES))}),
causes AS (
  SELECT vehicle_id, string_agg(name, ',' ORDER BY rk) AS top_features
  FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY dev DESC, pos) AS rk FROM devs) WHERE rk <= 3
  GROUP BY vehicle_id)"""

_JSON = """'["' || replace(top_features, ',', '","') || '"]' AS top_features"""
NAMED = ", " + FLEET + ", named AS (SELECT a.*, c.top_features FROM alerts a JOIN causes c ON c.vehicle_id = a.vehicle_id)"

REQUESTS = """requests AS (
  SELECT vehicle_id FROM vehicles WHERE software_version = '4.1'
  UNION SELECT vehicle_id FROM bronze WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicles)),
known AS (SELECT vehicle_id FROM requests WHERE vehicle_id IN (SELECT vehicle_id FROM vehicles))"""

_SILVER_OUT = f"""bronze_id, vehicle_id, {_ts('event_timestamp')} AS event_timestamp, {MEASURES}, regen_braking_event,
  rated_capacity_kwh, manufacture_year, region, {_ts('processed_at')} AS processed_at"""
_GOLD_OUT = f"""vehicle_id, {_ts('window_start')} AS window_start, {_ts('window_end')} AS window_end,
  {', '.join('avg_' + m for m in AVERAGED)}, rolling_5min_discharge_rate, health_score, record_count,
  {_ts('aggregated_at')} AS aggregated_at"""


def _typed_out() -> str:
    cols = []
    for r in S.TELEMETRY_RULES:
        value = _ts("moment") if r.name == "event_timestamp" else (
            f"CAST(v_{r.name} AS INTEGER)" if r.kind == "boolean" else f"v_{r.name}")
        cols.append(f"CASE WHEN reason IS NULL THEN {value} END AS {r.name}")
    return ", ".join(cols)


_CLASS = """CASE WHEN reason IS NULL THEN 'ok'
  WHEN split_part(reason, ':', 1) IN ('missing_field', 'invalid_type', 'out_of_range', 'invalid_timestamp')
  THEN split_part(reason, ':', 1) || ':' || split_part(reason, ':', 2) ELSE split_part(reason, ':', 1) END"""


def _stage(name: str, table: str, column: str) -> str:
    age = f"((epoch_us({AS_OF}) - epoch_us(max({column}))) / {D(1_000_000)})"
    return f"""SELECT '{name}' AS stage, CASE WHEN max({column}) IS NULL THEN 'no_data' WHEN {age} < {D(1200)} THEN 'ok'
      ELSE 'stale' END AS status, {_ts(f'max({column})')} AS last_run, CAST(round_even({age}, 0) AS BIGINT) AS lag_seconds FROM {table}"""


_STAGES = " UNION ALL ".join([
    _stage("ingestion", "bronze", "received_at"), _stage("silver", "silver", "processed_at"),
    _stage("gold", "gold", "aggregated_at"), _stage("prediction", "(SELECT * FROM predictions WHERE mode = 'production')", "predicted_at")])


def _without(prefix: str, text: str) -> str:
    """``text`` without the definitions of ``prefix`` it starts with, to put two chains together."""
    if not text.startswith(prefix):
        raise ValueError("definitions do not nest")
    return text[len(prefix):]


_ALL = ALERTS + _without(BRONZE, DLQ)

ORACLES: dict[str, str] = {
    "v_validate_events": WITH + INSPECTED + f" SELECT id, COALESCE(reason, 'ok') AS reason, {_typed_out()} FROM inspected",
    "v_reason_counts": WITH + INSPECTED + f" SELECT {_CLASS} AS reason_class, count(*) AS events FROM inspected GROUP BY 1",
    "p1_route_accepted": WITH + INSPECTED + f""" SELECT id, v_vehicle_id AS vehicle_id, {_ts('moment')} AS event_timestamp,
        v_battery_pct AS battery_pct, raw_payload FROM inspected WHERE reason IS NULL""",
    "p1_route_dlq": WITH + DLQ + f" SELECT id, {_ts('received_at')} AS received_at, raw_payload, error_reason, client_ip FROM dlq",
    "d6_dlq_preview": WITH + DLQ + f""" SELECT id, {_ts('received_at')} AS received_at, error_reason,
        client_ip, substring(raw_payload, 1, 200) AS raw_preview FROM dlq ORDER BY dlq.received_at DESC, id DESC LIMIT 100""",
    "d8_ingest_metrics": REC + LIMITED + """ SELECT count(*) FILTER (outcome = 'accepted') AS events_accepted,
        count(*) FILTER (outcome = 'rejected_rate_limit') AS events_rejected_rate_limit,
        count(*) FILTER (outcome = 'rejected_validation') AS events_rejected_validation,
        count(*) FILTER (outcome = 'rejected_validation') AS dlq_depth,
        count(*) FILTER (outcome = 'accepted') AS bronze_record_count FROM routed""",
    "d8_outcome_counts": REC + LIMITED + " SELECT outcome, count(*) AS events FROM routed GROUP BY outcome",
    "x7_events_per_minute": WITH + BRONZE + f""" SELECT {_ts("date_trunc('minute', received_at)")} AS slot_start,
        count(*) AS events FROM bronze GROUP BY 1""",
    "r1_token_bucket": REC + BRONZE + ", " + _bucket("bronze", "vehicle_id")
        + " SELECT id, CAST(allowed AS INTEGER) AS allowed FROM bucket",
    "s4_incremental_batch": WITH + BRONZE + f""" SELECT id, vehicle_id, {_ts('event_timestamp')} AS event_timestamp, battery_pct
        FROM bronze WHERE id > 500 ORDER BY id LIMIT 1000""",
    "s13_progress": WITH + SILVER + " SELECT COALESCE(max(bronze_id), 0) AS watermark FROM silver",
    "j1_enrich": WITH + ASSESSED + " SELECT id, vehicle_id, rated_capacity_kwh, COALESCE(region, 'none') AS region FROM assessed",
    "p2_silver_clean": WITH + SILVER + f" SELECT {_SILVER_OUT} FROM silver",
    "p4_silver_rejects": WITH + ASSESSED + f""" SELECT id AS bronze_id, vehicle_id, {_ts('event_timestamp')} AS event_timestamp,
        skip_reason, {_ts('received_at')} AS processed_at FROM assessed WHERE skip_reason IS NOT NULL""",
    "p4_reject_counts": WITH + ASSESSED + " SELECT COALESCE(skip_reason, 'ok') AS skip_reason, count(*) AS records FROM assessed GROUP BY 1",
    "r5_circuit_breaker_closed": WITH + ASSESSED + ", " + _NUMBERED + " " + _summary("numbered", "batch"),
    "r5_circuit_breaker_open": WITH + _FAULTY + f", {VEHICLES}, assessed AS ({_skip('faulty')}), " + _NUMBERED + " " + _summary("numbered", "batch"),
    "r5_committed_halt": WITH + ASSESSED + ", " + _TRIPPED + """ SELECT count(*) AS written, COALESCE(max(id), 0) AS watermark
        FROM numbered WHERE skip_reason IS NULL AND batch < COALESCE((SELECT min(batch) FROM tripped), 4611686018427387904)""",
    "r5_committed_quarantine": WITH + ASSESSED + ", " + _TRIPPED + """ SELECT count(*) AS written, COALESCE(max(id), 0) AS watermark
        FROM numbered WHERE skip_reason IS NULL AND batch NOT IN (SELECT batch FROM tripped)""",
    "a11_failure_rate": WITH + ASSESSED + " " + _summary("assessed", ""),
    "s12_seed_missing_keys": WITH + BRONZE + ", " + VEHICLES
        + " SELECT DISTINCT vehicle_id FROM bronze WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicles)",
    "j10_lineage_orphans": WITH + SILVER + _without(BRONZE, INSPECTED)
        + " SELECT bronze_id, vehicle_id FROM silver WHERE bronze_id NOT IN (SELECT id FROM inspected WHERE reason IS NULL)",
    "g_gold_snapshot": WITH + SNAPSHOT + f" SELECT {_GOLD_OUT} FROM snapshot",
    "w2_gold_sliding": WITH + GOLD + f" SELECT {_GOLD_OUT} FROM gold",
    "a1_window_means": WITH + SNAPSHOT + f" SELECT vehicle_id, {', '.join('avg_' + m for m in AVERAGED)}, record_count FROM snapshot",
    "a4_discharge_rate": WITH + SNAPSHOT + " SELECT vehicle_id, rolling_5min_discharge_rate AS discharge_rate FROM snapshot",
    "w3_rolling_rate": WITH + SILVER + f""", w AS (SELECT *,
        first_value(battery_pct) OVER win AS old, first_value(event_timestamp) OVER win AS since FROM silver
        WINDOW win AS (PARTITION BY vehicle_id ORDER BY event_timestamp RANGE BETWEEN INTERVAL 5 DAY PRECEDING AND CURRENT ROW))
        SELECT bronze_id, vehicle_id, {_ts('event_timestamp')} AS event_timestamp, battery_pct,
        round({_rate('old', 'battery_pct', 'since', 'event_timestamp')}, 6) AS discharge_rate FROM w""",
    "f1_health_score": WITH + SILVER + f""" SELECT bronze_id, {_even(_health('battery_pct', 'motor_temp_c', 'voltage_v',
        f'(({D(100)} - battery_pct) / {D(20)})'), 4)} AS health_score FROM silver""",
    "j2_latest_per_key": WITH + SILVER + f""" SELECT vehicle_id, bronze_id, {_ts('event_timestamp')} AS event_timestamp, battery_pct
        FROM silver WHERE (vehicle_id, event_timestamp) IN (SELECT vehicle_id, max(event_timestamp) FROM silver GROUP BY vehicle_id)""",
    "a16_latest_score": WITH + PREDICTIONS + f" SELECT vehicle_id, anomaly_score, CAST(is_anomaly AS INTEGER) AS is_anomaly FROM {_LATEST_PRED} p",
    "u1_predictions_union": WITH + PREDICTIONS + f""" SELECT vehicle_id, {_ts('window_start')} AS window_start, anomaly_score,
        CAST(is_anomaly AS INTEGER) AS is_anomaly, mode, {_ts('predicted_at')} AS predicted_at FROM predictions""",
    "d1_fleet_summary": REC + _ALL + f""" SELECT (SELECT count(*) FROM vehicles) AS total_vehicles,
        (SELECT count(DISTINCT vehicle_id) FROM bronze WHERE received_at >= {AS_OF} - INTERVAL 2 DAY) AS online_vehicles,
        (SELECT count(*) FROM alerts) AS active_alerts,
        COALESCE((SELECT round(avg(avg_battery_pct), 1) FROM {_LATEST_GOLD} g), 0) AS avg_battery_pct,
        (SELECT {_ts('max(received_at)')} FROM bronze) AS latest_event_at, (SELECT count(*) FROM dlq) AS dlq_depth,
        (SELECT count(*) FROM bronze) AS total_events, {_ts(AS_OF)} AS fetched_at""",
    "d2_fleet_vehicles": REC + ALERTS + f""" SELECT v.vehicle_id, fleet_label, make, model, manufacture_year, software_version,
        g.avg_battery_pct, g.avg_motor_temp_c, g.health_score, g.rolling_5min_discharge_rate, {_ts('g.aggregated_at')} AS aggregated_at,
        CASE WHEN a.vehicle_id IS NULL THEN 0 ELSE 1 END AS has_alert, a.anomaly_score, p.anomaly_score AS latest_pred_score,
        CAST(p.is_anomaly AS INTEGER) AS is_anomaly
        FROM vehicles v LEFT JOIN {_LATEST_GOLD} g ON v.vehicle_id = g.vehicle_id
        LEFT JOIN {_NEWEST_ALERT} a ON v.vehicle_id = a.vehicle_id LEFT JOIN {_LATEST_PRED} p ON v.vehicle_id = p.vehicle_id""",
    "d2_fleet_vehicles_all_alerts": REC + ALERTS + """ SELECT v.vehicle_id,
        CASE WHEN a.vehicle_id IS NULL THEN 0 ELSE 1 END AS has_alert, a.anomaly_score
        FROM vehicles v LEFT JOIN alerts a ON v.vehicle_id = a.vehicle_id""",
    "d3_metadata": WITH + VEHICLES + " SELECT * FROM vehicles WHERE vehicle_id = 'VF-001'",
    "d3_telemetry": WITH + SILVER + f""" SELECT {_ts('event_timestamp')} AS event_timestamp, battery_pct, voltage_v, motor_temp_c,
        current_a, speed_kmh, regen_braking_event FROM silver WHERE vehicle_id = 'VF-001' AND silver.event_timestamp >= {AS_OF} - INTERVAL 10 DAY""",
    "d3_gold_topn": WITH + GOLD + f""" SELECT vehicle_id, {_ts('window_start')} AS window_start, avg_battery_pct, avg_motor_temp_c,
        health_score, rolling_5min_discharge_rate FROM gold
        QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY gold.aggregated_at DESC) <= 20""",
    "d3_predictions_topn": WITH + PREDICTIONS + f""" SELECT vehicle_id, {_ts('window_start')} AS window_start, anomaly_score,
        CAST(is_anomaly AS INTEGER) AS is_anomaly, mode, {_ts('predicted_at')} AS predicted_at FROM predictions
        QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY predictions.predicted_at DESC, mode) <= 20""",
    "d3_alerts_topn": REC + ALERTS + NAMED + f""" SELECT vehicle_id, {_ts('first_detected_at')} AS first_detected_at, anomaly_score,
        top_features, status, {_ts('created_at')} AS created_at FROM named
        QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY named.created_at DESC) <= 10""",
    "d4_alerts": REC + ALERTS + NAMED + f""" SELECT vehicle_id, {_ts('first_detected_at')} AS first_detected_at,
        {_ts('run_started_at')} AS run_started_at, anomaly_score, {_JSON}, status, {_ts('created_at')} AS created_at
        FROM named ORDER BY named.created_at DESC, vehicle_id LIMIT 50""",
    "d5_stage_health": WITH + PREDICTIONS + " " + _STAGES,
    "d5_counts": REC + _ALL + """ SELECT 'bronze' AS layer, count(*) AS records FROM bronze
        UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM gold
        UNION ALL SELECT 'dlq', count(*) FROM dlq UNION ALL SELECT 'predictions', count(*) FROM predictions
        UNION ALL SELECT 'alerts', count(*) FROM alerts""",
    "d7_positions": REC + ALERTS + f""" SELECT s.vehicle_id, latitude, longitude, {_ts('s.event_timestamp')} AS event_timestamp,
        battery_pct, motor_temp_c, speed_kmh, software_version, fleet_label,
        CASE WHEN a.vehicle_id IS NULL THEN 0 ELSE 1 END AS has_alert
        FROM silver s JOIN vehicles v ON s.vehicle_id = v.vehicle_id
        LEFT JOIN (SELECT DISTINCT vehicle_id FROM alerts) a ON s.vehicle_id = a.vehicle_id
        WHERE (s.vehicle_id, s.event_timestamp) IN (SELECT vehicle_id, max(event_timestamp) FROM silver GROUP BY vehicle_id)""",
    "d9_layer_counts": WITH + GOLD + _without(BRONZE, DLQ) + """ SELECT (SELECT count(*) FROM bronze) AS bronze,
        (SELECT count(*) FROM silver) AS silver, (SELECT count(*) FROM gold) AS gold, (SELECT count(*) FROM dlq) AS dlq""",
    "d11_alert_list": REC + ALERTS + NAMED
        + f" SELECT vehicle_id, anomaly_score, {_JSON}, status, {_ts('created_at')} AS created_at FROM named",
    "m2_scaler": WITH + GOLD + " SELECT count(*) AS rows_read, count(*) AS rows_complete, " + ", ".join(
        f"round(avg({f}), 6) AS mean_{f}, round(stddev_pop({f}), 6) AS dev_{f}" for f in S.FEATURES) + " FROM gold",
    "a13_threshold": WITH + GOLD + " SELECT round(quantile_cont(health_score, 0.05), 6) AS threshold FROM gold",
    "m3_forest_shape": WITH + GOLD + """, n AS (SELECT least(256, count(*)) AS psi FROM gold) SELECT 100 AS trees,
        psi AS smallest_root, psi AS largest_root, psi AS fewest_in_leaves, psi AS most_in_leaves, 1 AS depth_bounded FROM n""",
    "m5_labels": WITH + GOLD + """ SELECT count(*) AS rows, count(*) AS scored, 0 AS wrong_labels, 1 AS share_holds FROM gold""",
    "m7_rows_per_mode": WITH + GOLD + """ SELECT mode, count(DISTINCT vehicle_id) AS rows, count(DISTINCT vehicle_id) AS vehicles
        FROM gold, (SELECT unnest(['production', 'shadow']) AS mode) m GROUP BY mode""",
    "m8_top_features": WITH + GOLD + ", " + FLEET + " SELECT vehicle_id, top_features FROM causes",
    "w5_consecutive": WITH + RUNS + f""" SELECT vehicle_id, {_ts('window_start')} AS window_start, CAST(is_anomaly AS INTEGER) AS is_anomaly,
        CAST(confirmed AS INTEGER) AS confirmed, {_ts('run_started_at')} AS run_started_at FROM runs""",
    "w6_suppressed_alerts": REC + ALERTS + NAMED + f""" SELECT vehicle_id, {_ts('first_detected_at')} AS first_detected_at,
        {_ts('run_started_at')} AS run_started_at, anomaly_score, status, {_ts('created_at')} AS created_at, top_features FROM named""",
    "m10_cycle_alerts": REC + ALERTS + ", " + FLEET + f""", recent AS (
        SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY window_start DESC) AS back FROM runs),
        due AS (SELECT vehicle_id, max(window_start) AS window_start, arg_max(anomaly_score, window_start) AS anomaly_score,
            arg_max(predicted_at, window_start) AS predicted_at, min(window_start) AS run_started_at
          FROM recent WHERE back <= 2 GROUP BY vehicle_id HAVING count(*) = 2 AND bool_and(is_anomaly)),
        standing AS (SELECT vehicle_id, arg_max(anomaly_score, created_at) AS score, max(created_at) AS since FROM alerts
          WHERE created_at < {AS_OF} GROUP BY vehicle_id)
        SELECT d.vehicle_id, {_ts('d.window_start')} AS first_detected_at, d.anomaly_score, c.top_features,
          {_ts('d.predicted_at')} AS created_at
        FROM due d LEFT JOIN standing s ON d.vehicle_id = s.vehicle_id JOIN causes c ON c.vehicle_id = d.vehicle_id
        WHERE s.since IS NULL OR s.since < d.predicted_at - INTERVAL 96 HOUR
          OR abs(d.anomaly_score) > abs(s.score) * CAST(1.2 AS DOUBLE)""",
    "e1_erase_bronze": WITH + BRONZE + ", " + VEHICLES + ", " + REQUESTS + """ SELECT id,
        CASE WHEN k.vehicle_id IS NULL THEN b.vehicle_id ELSE '[ERASED]' END AS vehicle_id,
        CASE WHEN k.vehicle_id IS NULL THEN latitude END AS latitude, CASE WHEN k.vehicle_id IS NULL THEN longitude END AS longitude,
        CASE WHEN k.vehicle_id IS NULL THEN b.vehicle_id ELSE '[ERASED]' END AS raw_payload, battery_pct
        FROM bronze b LEFT JOIN known k ON b.vehicle_id = k.vehicle_id""",
    "e1_erase_silver": WITH + SILVER + ", " + REQUESTS + """ SELECT bronze_id,
        CASE WHEN k.vehicle_id IS NULL THEN s.vehicle_id ELSE '[ERASED]' END AS vehicle_id,
        CASE WHEN k.vehicle_id IS NULL THEN latitude END AS latitude, CASE WHEN k.vehicle_id IS NULL THEN longitude END AS longitude,
        battery_pct FROM silver s LEFT JOIN known k ON s.vehicle_id = k.vehicle_id""",
    "e2_metadata_after": WITH + BRONZE + ", " + VEHICLES + ", " + REQUESTS
        + " SELECT * FROM vehicles WHERE vehicle_id NOT IN (SELECT vehicle_id FROM known)",
    "e3_erasure_counts": REC + ALERTS + ", " + REQUESTS + """ SELECT vehicle_id,
        (SELECT count(*) FROM bronze x WHERE x.vehicle_id = k.vehicle_id) AS bronze_count,
        (SELECT count(*) FROM silver x WHERE x.vehicle_id = k.vehicle_id) AS silver_count,
        (SELECT count(*) FROM gold x WHERE x.vehicle_id = k.vehicle_id) AS gold_count,
        (SELECT count(*) FROM predictions x WHERE x.vehicle_id = k.vehicle_id) AS prediction_count,
        (SELECT count(*) FROM alerts x WHERE x.vehicle_id = k.vehicle_id) AS alert_count FROM known k""",
    "e4_unknown_keys": WITH + BRONZE + ", " + VEHICLES + ", " + REQUESTS + """ SELECT vehicle_id,
        'Vehicle ' || vehicle_id || ' not found' AS error FROM requests WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicles)""",
    "x1_retention": WITH + BRONZE + f" SELECT id, {_ts('received_at')} AS received_at FROM bronze WHERE bronze.received_at >= {AS_OF} - INTERVAL 10 DAY",
    "x2_pseudonymise": WITH + SILVER + " SELECT bronze_id, sha256('pepper' || vehicle_id) AS vehicle_id FROM silver",
    "x3_k_anonymous_region": WITH + GOLD + """ SELECT v.region, count(DISTINCT g.vehicle_id) AS vehicles,
        round(avg(avg_battery_pct), 1) AS avg_battery_pct, round(avg(health_score), 1) AS avg_health_score, count(*) AS health_rows
        FROM gold g JOIN vehicles v ON g.vehicle_id = v.vehicle_id GROUP BY v.region HAVING count(DISTINCT g.vehicle_id) >= 3""",
    "x4_operational_alarms": WITH + PREDICTIONS + _without(BRONZE, DLQ) + f""" SELECT 'dlq_depth' AS alarm, count(*) AS value FROM dlq HAVING count(*) > 100
        UNION ALL SELECT 'stage_silent:' || stage, lag_seconds FROM ({_STAGES}) st WHERE lag_seconds > 90""",
}

ORACLES |= {
    "stream_route": WITH + INSPECTED + """ SELECT id, COALESCE(reason, 'ok') AS reason, CASE WHEN reason IS NULL THEN 'accepted'
        WHEN reason = 'payload_too_large' THEN 'rejected_too_large' ELSE 'rejected_validation' END AS outcome FROM inspected""",
    "stream_silver": ORACLES["p2_silver_clean"],
    "stream_gold": ORACLES["w2_gold_sliding"] + " WHERE gold.window_end <= (SELECT max(event_timestamp) - INTERVAL 10 MINUTE FROM silver)",
    "stream_token_bucket": ORACLES["r1_token_bucket"],
    "stream_alerts": ORACLES["w6_suppressed_alerts"],
}

_EXACT = f"""vehicle_id, {_ts('window_start')} AS window_start, {_ts('window_end')} AS window_end, avg_current_a,
  avg_motor_temp_c, avg_speed_kmh, record_count"""

# four batches, the watermark ten days behind the newest reading of those before
_MET = """every AS (SELECT *, bronze_id % 4 AS batch FROM {silver}), marks AS (
  SELECT b.batch, max(e.event_timestamp) - INTERVAL 10 DAY AS mark FROM (SELECT DISTINCT batch FROM every) b
  JOIN every e ON e.batch < b.batch GROUP BY b.batch),
met AS (SELECT e.*, COALESCE(date_trunc('day', event_timestamp) + INTERVAL 1 DAY <= m.mark, FALSE) AS late
  FROM every e LEFT JOIN marks m USING (batch))"""

_STORED = f"""bronze_id, vehicle_id, {_ts('event_timestamp')} AS event_timestamp, {MEASURES}, regen_braking_event, region,
  {_ts(AS_OF)} AS processed_at"""

ORACLES |= {
    "stream_gate": ORACLES["r1_token_bucket"],
    "stream_alerts_carried": ORACLES["w6_suppressed_alerts"],
    "s2_bronze_append": REC + LIMITED + f""" SELECT v_vehicle_id AS vehicle_id, {_ts('moment')} AS event_timestamp,
        {_ts('received_at')} AS received_at, v_battery_pct AS battery_pct, raw_payload FROM routed WHERE outcome = 'accepted'""",
    "s3_dlq_append": REC + LIMITED + f""" SELECT {_ts('received_at')} AS received_at, raw_payload, reason AS error_reason,
        client_ip FROM routed WHERE outcome = 'rejected_validation'""",
    "s5_silver_batch": WITH + SILVER + f" SELECT {_STORED} FROM silver",
    "s7_gold_append": WITH + GOLD + f" SELECT {_EXACT} FROM gold WHERE gold.window_end <= {AS_OF}",
    "s7_gold_superseded": WITH + SILVER + """, anchored AS (SELECT DISTINCT vehicle_id, TRUE AS snap FROM silver WHERE bronze_id % 3 = 0
        AND event_timestamp >= TIMESTAMP '2024-01-19 07:00:00' AND event_timestamp < TIMESTAMP '2024-01-20 07:00:00'),
      dayed AS (SELECT s.*, COALESCE(snap, FALSE) AS snap, CAST(date_trunc('day', event_timestamp) AS TIMESTAMP) AS day
        FROM silver s LEFT JOIN anchored USING (vehicle_id)),
      placed AS (SELECT *, CASE WHEN NOT snap THEN day
          WHEN event_timestamp >= TIMESTAMP '2024-01-20 07:00:00' THEN greatest(day, TIMESTAMP '2024-01-20 07:00:00')
          WHEN event_timestamp >= TIMESTAMP '2024-01-19 07:00:00' THEN TIMESTAMP '2024-01-19 07:00:00' ELSE day END AS window_start,
        CASE WHEN NOT snap OR event_timestamp >= TIMESTAMP '2024-01-20 07:00:00' THEN day + INTERVAL 1 DAY
          WHEN event_timestamp >= TIMESTAMP '2024-01-19 07:00:00' THEN TIMESTAMP '2024-01-20 07:00:00'
          ELSE least(day + INTERVAL 1 DAY, TIMESTAMP '2024-01-19 07:00:00') END AS window_end FROM dayed)""" + f"""
      SELECT vehicle_id, {_ts('window_start')} AS window_start, {_ts('window_end')} AS window_end,
        {', '.join(f"{_even(f'avg({m})', 2)} AS avg_{m}" for m in ('current_a', 'motor_temp_c', 'speed_kmh'))}, count(*) AS record_count
      FROM placed GROUP BY vehicle_id, window_start, window_end""",
    "m6_newest_scored": WITH + GOLD + f""" SELECT vehicle_id, {_ts('max(window_start)')} AS window_start, mode, 'v1.0' AS model_version,
        {_ts(AS_OF)} AS predicted_at, 1 AS scored, 1 AS labelled
        FROM gold, (SELECT unnest(['production', 'shadow']) AS mode) m WHERE window_end <= {AS_OF} GROUP BY vehicle_id, mode""",
    "m9_cycle": WITH + GOLD + f""", read AS (SELECT count(*) AS n, count(*) FILTER (skip_reason IS NOT NULL) AS bad, max(id) AS last
        FROM assessed), made AS (SELECT count(*) AS windows, count(DISTINCT vehicle_id) AS vehicles FROM gold WHERE window_end <= {AS_OF})
        SELECT 0 AS errors, 0 AS circuit_open, n AS records_read, n - bad AS records_written, bad AS records_failed, last AS watermark,
          windows AS gold_rows, 2 * vehicles AS predictions_written, 1 AS counts_agree, 0 AS alerts_raised FROM read, made""",
    "s9_alert_append": ORACLES["m10_cycle_alerts"],
    "s15_replay": ORACLES["w2_gold_sliding"],
    "e5_store_erasure": WITH + SILVER + ", " + REQUESTS + """, rows_of AS (
        SELECT 'bronze' AS layer, id AS bronze_id, vehicle_id, latitude, longitude, vehicle_id AS raw_payload FROM bronze
        UNION ALL SELECT 'silver', bronze_id, vehicle_id, latitude, longitude, '-' FROM silver)
        SELECT layer, bronze_id, CASE WHEN k.vehicle_id IS NULL THEN r.vehicle_id ELSE '[ERASED]' END AS vehicle_id,
          CASE WHEN k.vehicle_id IS NULL THEN latitude END AS latitude, CASE WHEN k.vehicle_id IS NULL THEN longitude END AS longitude,
          CASE WHEN layer = 'bronze' AND k.vehicle_id IS NOT NULL THEN '[ERASED]' ELSE raw_payload END AS raw_payload
        FROM rows_of r LEFT JOIN known k ON r.vehicle_id = k.vehicle_id""",
    "e6_audit": WITH + SILVER + ", " + REQUESTS + f""" SELECT vehicle_id,
        (SELECT count(*) FROM bronze x WHERE x.vehicle_id = k.vehicle_id) AS bronze_count,
        (SELECT count(*) FROM silver x WHERE x.vehicle_id = k.vehicle_id) AS silver_count,
        CAST(0 AS BIGINT) AS gold_count, 'officer' AS requested_by, {_ts(AS_OF)} AS erased_at FROM known k""",
    "stream_late_rows": WITH + SILVER + ", " + _MET.format(silver="silver")
        + f" SELECT bronze_id, vehicle_id, {_ts('event_timestamp')} AS event_timestamp FROM met WHERE late",
    "stream_gold_panes": WITH + GOLD.replace("silver AS (", "cleaned AS (", 1).replace(
        ", days AS (", ", " + _MET.format(silver="cleaned") + ", silver AS (SELECT * FROM met WHERE NOT late), days AS (", 1)
        + f""" SELECT {_EXACT}, rolling_5min_discharge_rate FROM gold
        WHERE gold.window_end <= (SELECT max(event_timestamp) - INTERVAL 10 DAY FROM cleaned)""",
    "j2_latest_kept_up": ORACLES["j2_latest_per_key"],
    "stream_online_status": WITH + BRONZE + f""", marked AS (
        SELECT vehicle_id, received_at, CASE WHEN received_at - lag(received_at) OVER w < INTERVAL 2 DAY THEN 0 ELSE 1 END AS fresh
        FROM bronze WINDOW w AS (PARTITION BY vehicle_id ORDER BY received_at, id)),
      numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY vehicle_id ORDER BY received_at ROWS UNBOUNDED PRECEDING) AS spell FROM marked),
      spells AS (SELECT vehicle_id, spell, min(received_at) AS a, max(received_at) + INTERVAL 2 DAY AS b FROM numbered GROUP BY ALL
        HAVING b <= (SELECT max(received_at) - INTERVAL 10 MINUTE FROM bronze))
      SELECT vehicle_id, {_ts('a')} AS at, 'online' AS status FROM spells
      UNION ALL SELECT vehicle_id, {_ts('b')}, 'offline' FROM spells""",
    "a6_approx_distinct": WITH + BRONZE + f""" SELECT {_ts("CAST(date_trunc('week', received_at) AS TIMESTAMP)")} AS week,
        count(DISTINCT vehicle_id) AS exact, 1 AS holds FROM bronze GROUP BY date_trunc('week', received_at)""",
    "a13_sketch_threshold": WITH + GOLD + f""" SELECT CAST(unnest([0.01, 0.05, 0.5, 0.95]) AS DOUBLE) AS share,
        (SELECT count(*) FROM gold) AS rows, 1 AS holds""",
    "x6_score_drift": WITH + GOLD + f""", binned AS (
        SELECT CAST(window_start AS DATE) AS day, greatest(0, least(19, floor(health_score / {D(5)}))) AS bin, count(*) AS n FROM gold GROUP BY ALL),
      ref AS (SELECT bin, sum(n) / CAST(sum(sum(n)) OVER () AS DOUBLE) AS share FROM binned WHERE day < DATE '2024-01-11' GROUP BY bin),
      later AS (SELECT day, sum(n) AS total FROM binned WHERE day >= DATE '2024-01-11' GROUP BY day),
      bins AS (SELECT unnest(range(20)) AS bin),
      far AS (SELECT d.day, any_value(d.total) AS total, sum(abs(COALESCE(b.n, 0) / CAST(d.total AS DOUBLE) - COALESCE(r.share, 0))) / 2 AS distance
        FROM later d CROSS JOIN bins i LEFT JOIN binned b ON b.day = d.day AND b.bin = i.bin LEFT JOIN ref r ON r.bin = i.bin GROUP BY d.day)
      SELECT CAST(day AS VARCHAR) AS day, CAST(total AS BIGINT) AS rows, round(distance + 1e-9, 6) AS distance,
        CAST(distance > 0.1 AS INTEGER) AS due FROM far""",
}
