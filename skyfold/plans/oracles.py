"""DuckDB statements of the catalogue's queries, from common table expressions that build on one another."""

from __future__ import annotations

HOUR = 36_000_000_000
TIMEOUT, QUANTUM, TTL, BLOCK, PAIR = 6 * HOUR, HOUR, 36 * HOUR, 6 * HOUR, 12 * HOUR
SENSORS = ("click", "error", "purchase", "signup", "view")

E = "e AS (SELECT event_id AS seq, epoch_us(ts) * 10 AS t, event_type AS s, CAST(user_id AS INTEGER) AS icao, event_type || '|' || props AS frame, value AS v FROM events)"

_LATEST = ", ".join(f"max(CASE WHEN s = '{s}' THEN t END) OVER (ORDER BY seq) AS l{k}" for k, s in enumerate(SENSORS))
_ALL = ", ".join(f"l{k}" for k in range(len(SENSORS)))
_LIVE = ", ".join(f"CASE WHEN l{k} >= f - {TIMEOUT} THEN l{k} END" for k in range(len(SENSORS)))
MARKS = f"""
latest AS (SELECT *, {_LATEST} FROM e),
front AS (SELECT *, greatest({_ALL}) AS f FROM latest),
cand AS (SELECT *, least({_LIVE}) AS c FROM front),
after AS (SELECT *, max(c) OVER (ORDER BY seq) AS wm_after FROM cand),
marks AS (SELECT seq, t, s, icao, frame, v, wm_after, lag(wm_after) OVER (ORDER BY seq) AS wm_before FROM after)"""

#: The rule event by event: what is counted of each sensor, the watermark, and what came before the watermark.
_KNOWN = ", ".join(f"CASE WHEN n.s = '{s}' AND (f.wm IS NULL OR n.t >= f.wm) THEN greatest(f.l{k}, n.t) ELSE f.l{k} END AS l{k}" for k, s in enumerate(SENSORS))
_FIRST = ", ".join(f"CASE WHEN s = '{s}' THEN t END AS l{k}" for k, s in enumerate(SENSORS))
UNORDERED = f"""
u AS (SELECT seq, t + ((seq * 7919) % 19 - 9) * {HOUR} AS t, s, icao, frame, v, row_number() OVER (ORDER BY seq) AS rn FROM e),
told(rn, seq, t, s, icao, frame, v, {_ALL}, wm_before, wm, late) AS (
  SELECT rn, seq, t, s, icao, frame, v, {_FIRST}, CAST(NULL AS BIGINT), t, false FROM u WHERE rn = 1
  UNION ALL
  SELECT rn, seq, t, s, icao, frame, v, {_ALL}, wm_before, greatest(wm_before, least({_LIVE})) AS wm, late FROM (
    SELECT *, greatest({_ALL}) AS f FROM (
      SELECT n.rn, n.seq, n.t, n.s, n.icao, n.frame, n.v, {_KNOWN}, f.wm AS wm_before, n.t < f.wm AS late FROM told f JOIN u n ON n.rn = f.rn + 1
    )
  )
)"""

CHAIN = f"""
adv AS (SELECT DISTINCT wm_after AS w FROM marks),
chain(x) AS (SELECT min(w) FROM adv UNION ALL SELECT (SELECT min(w) FROM adv WHERE w >= chain.x + {QUANTUM}) FROM chain WHERE EXISTS (SELECT 1 FROM adv WHERE w >= chain.x + {QUANTUM})),
conf1 AS (SELECT marks.*, chain.x AS confirmed_after FROM marks ASOF LEFT JOIN chain ON marks.wm_after >= chain.x),
conf AS (SELECT conf1.*, chain.x AS confirmed_before FROM conf1 ASOF LEFT JOIN chain ON conf1.wm_before >= chain.x)"""


def dedup(source: str, clock: str) -> str:
    return f"""
nth AS (SELECT *, {clock} AS clk, row_number() OVER (PARTITION BY frame ORDER BY seq) AS rn FROM {source}),
fold AS (
  SELECT frame, rn, seq, t + {TTL} AS expiry, true AS accepted FROM nth WHERE rn = 1
  UNION ALL
  SELECT n.frame, n.rn, n.seq, CASE WHEN n.clk >= f.expiry THEN n.t + {TTL} ELSE f.expiry END, coalesce(n.clk >= f.expiry, false)
  FROM fold f JOIN nth n ON n.frame = f.frame AND n.rn = f.rn + 1
)"""


def nstrike(source: str, value: str, out: str, n: int, force: str = "false", seed: str = "NULL") -> str:
    """Tables {out}_: source with a column `out`."""
    return f"""
{out}_a AS (SELECT *, {value} AS val FROM {source}),
{out}_b AS (SELECT *, CASE WHEN val IS NOT NULL AND val IS DISTINCT FROM lag(val) OVER (PARTITION BY icao, val IS NOT NULL ORDER BY seq) THEN 1 ELSE 0 END AS fresh FROM {out}_a),
{out}_c AS (SELECT *, sum(fresh) OVER (PARTITION BY icao, val IS NOT NULL ORDER BY seq) AS run FROM {out}_b),
{out}_d AS (SELECT *, row_number() OVER (PARTITION BY icao, val IS NOT NULL, run ORDER BY seq) AS pos FROM {out}_c),
{out}_e AS (SELECT *, CASE WHEN val IS NOT NULL AND (pos >= {n} OR {force}) THEN val END AS con FROM {out}_d),
{out}_ AS (SELECT * EXCLUDE (val, fresh, run, pos, con), coalesce(last_value(con IGNORE NULLS) OVER (PARTITION BY icao ORDER BY seq ROWS UNBOUNDED PRECEDING), {seed}) AS {out} FROM {out}_e)"""


CALL = "CASE WHEN s IN ('click', 'view', 'signup') THEN s END"
SQUAWK = "CASE WHEN s IN ('error', 'purchase') THEN s END"
ALT = "CASE WHEN s = 'view' THEN CAST(round(v * 100) AS INTEGER) END"
SNAPSHOT = f"""{nstrike("src", CALL, "call_sign", 2)},{nstrike("call_sign_", SQUAWK, "squawk", 2, "s = 'error'")},
alts AS (SELECT *, last_value({ALT} IGNORE NULLS) OVER (PARTITION BY icao ORDER BY seq ROWS UNBOUNDED PRECEDING) AS alt FROM squawk_),
others AS (
  SELECT *, last_value(CASE WHEN seq % 2 = 0 THEN t END IGNORE NULLS) OVER w AS even_t, last_value(CASE WHEN seq % 2 = 1 THEN t END IGNORE NULLS) OVER w AS odd_t
  FROM alts WINDOW w AS (PARTITION BY icao ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
snap AS (SELECT *, CASE WHEN seq % 2 = 0 THEN odd_t ELSE even_t END AS other_t FROM others),
fixes AS (SELECT seq, icao, t, v, alt, call_sign, squawk FROM snap WHERE abs(t - other_t) <= {PAIR})"""

BLOCKS = f"blocks AS (SELECT icao, t - t % {BLOCK} AS block, max(seq) AS seq FROM fixes GROUP BY ALL)"

POINTS = """
p AS (
  SELECT ts AS timestamp, upper(lpad(to_hex(user_id + 4194304), 6, '0')) AS mode_s_code,
         CASE WHEN event_id % 17 <> 0 THEN user_id * 7 % 120 - 60 + value / 100 END AS lat,
         user_id * 13 % 300 - 150 + value / 50 AS lon,
         CASE WHEN event_id % 5 <> 0 THEN CAST(round(value * 100) AS INTEGER) END AS alt,
         CASE WHEN event_type = 'click' THEN 'C' || (user_id % 40) || '-' || (event_id % 3) WHEN event_type = 'view' THEN '  ' END AS call_sign,
         CASE WHEN event_type = 'error' THEN '7700' END AS squawk, event_type = 'signup' AS on_ground, event_id
  FROM events
)"""

# Signals, records and frames as whole numbers of event_id.
BYTES = ", ".join(f"(event_id * {31 + 7 * k} + {13 * k * k + 17}) % 256 AS b{k}" for k in range(20))
FIELDS = """
f AS (
  SELECT event_id AS seq, event_id % 7 AS pick, (event_id * 7919 + 4660) % 16777216 AS icao, (event_id * 13) % 2 AS par,
         (event_id * 1009) % 131072 AS lat_cpr, (event_id * 2003 + 77) % 131072 AS lon_cpr,
         (event_id * 37) % 1900 AS steps, (event_id * 3) % 8 AS a, (event_id * 5) % 8 AS b, (event_id * 7) % 8 AS c, (event_id * 11) % 8 AS d,
         event_id % 10 = 3 AS broken
  FROM events
)"""


def _hex(n: str) -> str:
    return f"lower(lpad(to_hex({n}), 2, '0'))"


def oracle_sql() -> dict[str, str]:
    with_e = f"WITH RECURSIVE {E}, {MARKS}"
    zones = "CASE WHEN abs({x}) < 1e-12 THEN 59 WHEN abs({x}) = 87 THEN 2 WHEN abs({x}) > 87 THEN 1 ELSE CAST(floor(2 * pi() / acos(greatest(-1.0, 1 - (1 - cos(pi() / 30)) / pow(cos(radians(abs({x}))), 2)))) AS INTEGER) END"
    mod = "({a} - {b} * floor({a} / {b}))"
    return {
        "ev_late_and_watermark": f"{with_e} SELECT seq, wm_before, wm_after, coalesce(t < wm_before, false) AS late FROM marks",
        "ev_late_unordered": f"WITH RECURSIVE {E}, {UNORDERED} SELECT seq, wm_before, wm AS wm_after, late FROM told",
        "ev_admitted_unordered": f"""WITH RECURSIVE {E}, {UNORDERED}, marks AS (SELECT seq, t, s, icao, frame, v, wm AS wm_after, wm_before FROM told WHERE NOT late), {CHAIN}, {dedup("conf", "confirmed_before")}
            SELECT seq, confirmed_before, confirmed_after, accepted FROM conf JOIN (SELECT seq, accepted FROM fold) USING (seq)""",
        "ev_confirm_timeline": f"{with_e}, {CHAIN} SELECT seq, confirmed_before, confirmed_after FROM conf",
        "ev_ttl_dedup_anchor": f"WITH RECURSIVE {E}, {dedup('e', 't')} SELECT seq, accepted FROM fold",
        "ev_ttl_dedup_confirmed": f"{with_e}, {CHAIN}, {dedup('conf', 'confirmed_before')} SELECT seq, accepted FROM fold",
        "ev_nstrike": f"WITH {E}, {nstrike('e', 's', 'known', 3)} SELECT seq, known FROM known_",
        "ev_nstrike_emergency": f"WITH {E}, {nstrike('e', 's', 'known', 3, chr(115) + ' = ' + repr('error'))} SELECT seq, known FROM known_",
        "ev_nstrike_seeded": f"WITH {E}, {nstrike('e', 's', 'known', 3, seed='CASE WHEN icao % 2 = 0 THEN ' + repr('seed') + ' END')} SELECT seq, known FROM known_",
        "ev_nstrike_split": f"""WITH {E}, h AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 0 ELSE icao END AS icao) FROM e), {nstrike('h', 's', 'known', 3, chr(115) + ' = ' + repr('error'))} SELECT seq, known FROM known_""",
        "ev_asof_join": f"""WITH {E}, h AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 0 ELSE icao END AS icao) FROM e), o AS (SELECT icao, t, max(seq) AS seq, arg_max(v, seq) AS v FROM h WHERE s IN ('purchase', 'error') GROUP BY icao, t)
            SELECT a.seq, CASE WHEN a.t - o.t <= {PAIR} THEN o.seq END AS other_seq, CASE WHEN a.t - o.t <= {PAIR} THEN o.t END AS other_t, CASE WHEN a.t - o.t <= {PAIR} THEN o.v END AS other_v
            FROM (SELECT * FROM h WHERE s NOT IN ('purchase', 'error')) a ASOF LEFT JOIN o ON a.icao = o.icao AND a.t >= o.t""",
        "ev_alt_lww_asof": f"WITH {E} SELECT seq, last_value({ALT} IGNORE NULLS) OVER (PARTITION BY icao ORDER BY seq ROWS UNBOUNDED PRECEDING) AS alt FROM e",
        "ev_pair_asof": f"""WITH {E} SELECT a.seq, o.t AS other_t, coalesce(abs(a.t - o.t) <= {PAIR}, false) AS paired
            FROM e a ASOF LEFT JOIN e o ON a.icao = o.icao AND a.seq % 2 = 1 - o.seq % 2 AND a.seq > o.seq""",
        "ev_snapshot": f"WITH {E}, src AS (SELECT * FROM e), {SNAPSHOT} SELECT seq, icao, t AS ts_100ns, alt, call_sign, squawk FROM fixes",
        "ev_block_lww": f"WITH {E}, r AS (SELECT icao, t - t % {BLOCK} AS block, seq, v, row_number() OVER (PARTITION BY icao, t - t % {BLOCK} ORDER BY seq DESC) AS n FROM e) SELECT icao, block, seq, v FROM r WHERE n = 1",
        "ev_block_flush": f"""{with_e}, r AS (SELECT icao, t - t % {BLOCK} AS block, max(seq) AS seq FROM e GROUP BY ALL)
            SELECT icao, block, seq FROM r WHERE block + {BLOCK} <= (SELECT max(wm_after) FROM marks)""",
        "ev_restore_distinct_on": f"""WITH {POINTS} SELECT DISTINCT ON (mode_s_code) CAST(user_code AS BIGINT) AS icao, call_sign, squawk FROM (SELECT *, CAST('0x' || mode_s_code AS BIGINT) AS user_code FROM p)
            WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-20' ORDER BY mode_s_code, timestamp DESC""",
        "ev_upsert_merge": f"""WITH {E}, k AS (SELECT seq, icao, t - t % {BLOCK} AS block, v FROM e),
            o AS (SELECT icao, block, max_by(v, seq) AS v FROM k WHERE seq % 3 <> 0 GROUP BY ALL), n AS (SELECT icao, block, max_by(CASE WHEN seq % 2 = 0 THEN v END, seq) FILTER (WHERE true) AS x, max(seq) AS seq FROM k WHERE seq % 3 = 0 GROUP BY ALL),
            l AS (SELECT n.icao, n.block, CASE WHEN n.seq % 2 = 0 THEN k.v END AS v FROM n JOIN k USING (seq))
            SELECT icao, block, v FROM l UNION ALL SELECT icao, block, v FROM o WHERE (icao, block) NOT IN (SELECT (icao, block) FROM l)""",
        "ev_minute_replace": """WITH o AS (SELECT event_id, epoch_us(ts) // 60000000 AS minute FROM events WHERE event_id % 3 <> 0), n AS (SELECT event_id, epoch_us(ts) // 60000000 AS minute FROM events WHERE event_id % 2 = 0),
            b AS (SELECT 28401120 + 1440 * 5 AS lo, 28401120 + 1440 * 9 AS hi)
            SELECT o.* FROM o, b WHERE minute < lo OR minute >= hi UNION ALL SELECT n.* FROM n, b WHERE minute >= lo AND minute < hi""",
        "ev_minute_bucket_counts": "SELECT epoch_us(ts) // 60000000 AS minute, strftime(ts, '%Y%m%d%H%M') AS label, count(*) AS n FROM events GROUP BY ALL",
        "ev_view_filter": f"""WITH {POINTS} SELECT timestamp, mode_s_code, lat, lon, alt, call_sign, squawk, on_ground FROM p
            WHERE lat IS NOT NULL AND lon IS NOT NULL AND timestamp >= TIMESTAMP '2024-01-03' AND timestamp < TIMESTAMP '2024-01-25' AND NOT on_ground ORDER BY mode_s_code, timestamp LIMIT 500""",
        "ev_view_named": f"""WITH {POINTS} SELECT timestamp, mode_s_code, lat, lon, alt, call_sign, squawk, on_ground FROM p WHERE lat IS NOT NULL AND call_sign IN ('C1-0', 'C2-1', 'C3-2', 'C12-0')
            AND mode_s_code IN (SELECT upper(lpad(to_hex(4194304 + k), 6, '0')) FROM range(30) AS r(k)) ORDER BY mode_s_code, timestamp""",
        "ev_view_totals": f"""WITH {POINTS} SELECT count(DISTINCT mode_s_code) AS aircraft, count(*) AS "rows", min(timestamp) AS t_start, max(timestamp) AS t_end, min(alt) AS alt_min, max(alt) AS alt_max,
            coalesce(string_agg(DISTINCT call_sign, ', ' ORDER BY call_sign) FILTER (WHERE trim(call_sign) <> ''), '') AS call_signs FROM p WHERE lat IS NOT NULL""",
        "ev_view_summary": f"""WITH {POINTS} SELECT mode_s_code, count(*) AS "rows", coalesce(string_agg(DISTINCT call_sign, ', ' ORDER BY call_sign) FILTER (WHERE trim(call_sign) <> ''), '-') AS call_signs,
            min(timestamp) AS t_start, max(timestamp) AS t_end, min(alt) AS alt_min, max(alt) AS alt_max FROM p WHERE lat IS NOT NULL GROUP BY mode_s_code""",
        "ev_last_point": f"""WITH {POINTS} SELECT mode_s_code, max(timestamp) AS timestamp, arg_max({{'l': lat}}, timestamp).l AS lat, arg_max({{'a': alt}}, timestamp).a AS alt,
            mode_s_code || coalesce(' / ' || nullif(trim(arg_max({{'c': call_sign}}, timestamp).c), ''), '') || chr(10) || 'alt=' || coalesce(CAST(arg_max({{'a': alt}}, timestamp).a AS VARCHAR), '-') AS label
            FROM p WHERE lat IS NOT NULL GROUP BY mode_s_code""",
        "ev_trajectory": f"WITH {POINTS} SELECT mode_s_code, count(*) AS n_points, string_agg(CAST(epoch_us(timestamp) AS VARCHAR), ' ' ORDER BY timestamp) AS line FROM p WHERE lat IS NOT NULL GROUP BY mode_s_code HAVING count(*) >= 2",
        "ev_trajectory_line": f"""WITH {POINTS} SELECT mode_s_code, count(*) AS n_points, 'LINESTRING (' || string_agg(format('{{:.3f}} {{:.3f}}', radians(lon) * 6378137.0, ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0), ', ' ORDER BY timestamp) || ')' AS wkt
            FROM p WHERE lat IS NOT NULL GROUP BY mode_s_code HAVING count(*) >= 2""",
        "ev_webmercator": f"WITH {POINTS} SELECT event_id, round(radians(lon) * 6378137.0, 3) AS x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0, 3) AS y FROM p WHERE lat IS NOT NULL",
        "ev_reject_counts": f"""{with_e} SELECT count(*) FILTER (t < wm_before) AS dropped_late, count(*) FILTER (s = 'error') AS parse_error, count(*) FILTER (icao % 5 = 0) AS unknown_sensor, count(*) AS positions_emitted FROM marks""",
        "signal_dbm": "SELECT event_id, CAST(-((65535 - event_id * 257 % 65536) // 256) AS SMALLINT) AS dbm FROM events",
        "wire_header": """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'bad_length' WHEN event_id % 7 = 0 THEN 'bad_sensor_id' WHEN event_id % 5 = 0 THEN 'bad_timestamp' END AS header_reject,
            CASE WHEN event_id % 11 <> 0 AND event_id % 7 <> 0 AND event_id % 5 <> 0 THEN epoch_us(date_trunc('minute', ts)) * 10 END AS minute_100ns FROM events""",
        "wire_parse": f"""WITH b AS (SELECT event_id, {BYTES} FROM events) SELECT event_id, CAST(b0 + 256 * b1 + 65536 * b2 + 16777216 * b3 AS BIGINT) AS ts_100ns, CAST(-((65535 - (b18 + 256 * b19)) // 256) AS SMALLINT) AS rssi_dbm,
            CASE WHEN b4 // 8 >= 16 THEN {" || ".join(_hex(f"b{k}") for k in range(4, 18))} WHEN event_id % 2 = 0 THEN {" || ".join(_hex(f"b{k}") for k in range(4, 11))} END AS frame,
            CASE WHEN b4 // 8 < 16 AND event_id % 2 = 1 THEN 'malformed_short_frame' END AS frame_reject FROM b""",
        "modes_crc": f"""WITH RECURSIVE b AS (SELECT event_id, {BYTES} FROM events), w(i, v) AS (SELECT 0, 16774153 UNION ALL SELECT i + 1, xor(v << 1, CASE WHEN v & 8388608 <> 0 THEN 16774153 ELSE 0 END) & 16777215 FROM w WHERE i < 87),
            x AS (SELECT event_id, unnest([{", ".join(f"b{k}" for k in range(11))}]) AS byte, unnest(range(11)) AS k FROM b),
            r AS (SELECT event_id, bit_xor(CASE WHEN (byte >> (7 - (87 - i) % 8)) & 1 = 1 THEN v ELSE 0 END) AS rem FROM x JOIN w ON (87 - i) // 8 = k GROUP BY event_id)
            SELECT event_id, CAST(xor(rem, b11 * 65536 + b12 * 256 + b13) AS BIGINT) AS remainder FROM r JOIN b USING (event_id)""",
        "modes_decode": f"""WITH {FIELDS} SELECT seq,
            CASE WHEN pick = 6 THEN 'unsupported_df' WHEN broken AND pick IN (0, 1, 2) THEN 'crc_invalid' END AS reject_reason,
            CASE WHEN pick = 6 OR (broken AND pick IN (0, 1, 2)) THEN NULL WHEN pick = 0 THEN 'airborne' WHEN pick = 1 THEN 'callsign' WHEN pick = 2 THEN 'surface' WHEN pick IN (3, 5) THEN 'squawk' ELSE 'altitude' END AS kind,
            CASE WHEN pick = 6 OR (broken AND pick IN (0, 1, 2)) THEN NULL ELSE CAST(icao AS INTEGER) END AS icao, false AS ca_ground,
            CASE WHEN pick IN (0, 2) AND NOT broken THEN CAST(par AS INTEGER) END AS parity_bit, CASE WHEN pick IN (0, 2) AND NOT broken THEN CAST(lat_cpr AS INTEGER) END AS lat_cpr, CASE WHEN pick IN (0, 2) AND NOT broken THEN CAST(lon_cpr AS INTEGER) END AS lon_cpr,
            CASE WHEN (pick = 0 AND NOT broken) OR pick = 4 THEN CAST(steps * 25 - 1000 AS INTEGER) END AS alt_ft,
            CASE WHEN pick = 1 AND NOT broken THEN chr(65 + CAST(a AS INTEGER)) || chr(65 + CAST(b AS INTEGER)) || chr(65 + CAST(c AS INTEGER)) || chr(48 + CAST(d AS INTEGER)) END AS call_sign,
            CASE WHEN pick IN (3, 5) THEN a || b || c || d END AS squawk, coalesce(pick IN (3, 5) AND a || b || c || d IN ('7500', '7600', '7700'), false) AS emergency FROM f""",
        "frames_to_positions": f"""WITH {E},
            src AS (SELECT *, seq % 2 AS odd, CASE WHEN s = 'view' OR (s = 'click' AND seq % 3 <> 0) THEN 'airborne' WHEN s = 'click' THEN 'altitude' WHEN s = 'purchase' THEN 'callsign' WHEN s = 'error' THEN 'squawk' ELSE 'surface' END AS kind,
                -60 + icao * 37 % 120 + seq % 100 / 1000.0 AS lat0, -170 + icao * 53 % 340 + seq % 100 / 1000.0 AS lon0, 131072.0 AS m, CAST((seq * 37) % 1900 * 25 - 1000 AS INTEGER) AS feet FROM e),
            {nstrike('src', "CASE WHEN kind = 'callsign' THEN CASE WHEN (seq // 5) % 2 = 0 THEN 'AAA' ELSE 'BBB' END END", 'call_sign', 2)},
            {nstrike('call_sign_', "CASE WHEN kind = 'squawk' THEN CASE WHEN icao % 3 = 0 THEN '7700' ELSE '1234' END END", 'squawk', 2, 'icao % 3 = 0')},
            alts AS (SELECT *, last_value(CASE WHEN kind = 'altitude' THEN feet END IGNORE NULLS) OVER (PARTITION BY icao ORDER BY seq ROWS UNBOUNDED PRECEDING) AS known, {zones.format(x="lat0")} AS nl FROM squawk_),
            coded AS (SELECT *, 360.0 / (60 - odd) AS dl, 360.0 / greatest(nl - odd, 1) AS dn FROM alts),
            cprs AS (SELECT *, CASE WHEN kind = 'surface' THEN (seq * 1009) % 131072 ELSE CAST(floor(m * {mod.format(a="lat0", b="dl")} / dl + 0.5) AS BIGINT) % 131072 END AS y,
                CASE WHEN kind = 'surface' THEN (seq * 2003 + 77) % 131072 ELSE CAST(floor(m * {mod.format(a="lon0", b="dn")} / dn + 0.5) AS BIGINT) % 131072 END AS x FROM coded),
            before AS (SELECT *, last_value(CASE WHEN kind = 'airborne' AND odd = 0 THEN {{'t': t, 'y': y, 'x': x}} END IGNORE NULLS) OVER w AS even_, last_value(CASE WHEN kind = 'airborne' AND odd = 1 THEN {{'t': t, 'y': y, 'x': x}} END IGNORE NULLS) OVER w AS odd_
                FROM cprs WINDOW w AS (PARTITION BY icao ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            other AS (SELECT *, CASE WHEN odd = 0 THEN odd_ ELSE even_ END AS o FROM before),
            pairs AS (SELECT *, CASE WHEN odd = 0 THEN y ELSE o.y END AS elat, CASE WHEN odd = 1 THEN y ELSE o.y END AS olat, CASE WHEN odd = 0 THEN x ELSE o.x END AS elon, CASE WHEN odd = 1 THEN x ELSE o.x END AS olon FROM other WHERE kind = 'airborne' AND abs(t - o.t) <= {PAIR}),
            j AS (SELECT *, floor(59 * elat / m - 60 * olat / m + 0.5) AS j FROM pairs),
            n AS (SELECT *, 360.0 / 60 * ({mod.format(a="j", b="60")} + elat / m) AS ne, 360.0 / 59 * ({mod.format(a="j", b="59")} + olat / m) AS no FROM j),
            s2 AS (SELECT *, CASE WHEN ne >= 270 THEN ne - 360 ELSE ne END AS e, CASE WHEN no >= 270 THEN no - 360 ELSE no END AS o2 FROM n),
            q AS (SELECT *, CASE WHEN odd = 1 THEN o2 ELSE e END AS north, {zones.format(x="e")} = {zones.format(x="o2")} AS fits FROM s2),
            r AS (SELECT *, {zones.format(x="north")} AS k FROM q WHERE fits AND abs(north) <= 90),
            u AS (SELECT *, floor(elon / m * (k - 1) - olon / m * k + 0.5) AS mm, greatest(k - odd, 1) AS ni FROM r),
            air AS (SELECT *, 360.0 / ni * ({mod.format(a="mm", b="ni")} + CASE WHEN odd = 1 THEN olon ELSE elon END / m) AS east FROM u),
            ga AS (SELECT *, 90.0 / (60 - odd) AS gl FROM cprs WHERE kind = 'surface'),
            gb AS (SELECT *, gl * (floor(51.99 / gl) + floor(0.5 + {mod.format(a="51.99", b="gl")} / gl - y / m) + y / m) AS north FROM ga),
            gc AS (SELECT *, 90.0 / greatest({zones.format(x="north")} - odd, 1) AS gn FROM gb)
            SELECT seq, icao, t AS ts_100ns, round(north, 9) AS lat, round(CASE WHEN east >= 180 THEN east - 360 ELSE east END, 9) AS lon, CASE WHEN seq % 4 <> 0 THEN feet ELSE known END AS alt, call_sign, squawk, false AS on_ground FROM air
            UNION ALL
            SELECT seq, icao, t, round(north, 9), round(gn * (floor(4.375 / gn) + floor(0.5 + {mod.format(a="4.375", b="gn")} / gn - x / m) + x / m), 9), NULL, call_sign, squawk, true FROM gc""",
        "cpr_global": f"""WITH x AS (SELECT event_id, event_id % 2 AS odd, 131072.0 AS m, -80 + (event_id * 37) % 160 + value / 1000 AS lat, -180 + (event_id * 53) % 360 + value / 1000 AS lon FROM events),
            z AS (SELECT *, {zones.format(x="lat")} AS nl FROM x),
            c AS (SELECT *, floor(m * {mod.format(a="lat", b="(360.0 / 60)")} / (360.0 / 60) + 0.5) % m AS elat, floor(m * {mod.format(a="lat", b="(360.0 / 59)")} / (360.0 / 59) + 0.5) % m AS olat,
                  floor(m * {mod.format(a="lon", b="(360.0 / greatest(nl, 1))")} / (360.0 / greatest(nl, 1)) + 0.5) % m AS elon, floor(m * {mod.format(a="lon", b="(360.0 / greatest(nl - 1, 1))")} / (360.0 / greatest(nl - 1, 1)) + 0.5) % m AS olon FROM z),
            j AS (SELECT *, floor(59 * elat / m - 60 * olat / m + 0.5) AS j FROM c),
            n AS (SELECT *, 360.0 / 60 * ({mod.format(a="j", b="60")} + elat / m) AS ne, 360.0 / 59 * ({mod.format(a="j", b="59")} + olat / m) AS no FROM j),
            s AS (SELECT *, CASE WHEN ne >= 270 THEN ne - 360 ELSE ne END AS e, CASE WHEN no >= 270 THEN no - 360 ELSE no END AS o FROM n),
            q AS (SELECT *, CASE WHEN odd = 1 THEN o ELSE e END AS y, {zones.format(x="e")} = {zones.format(x="o")} AS fits FROM s),
            r AS (SELECT *, {zones.format(x="y")} AS k FROM q),
            u AS (SELECT *, floor(elon / m * (k - 1) - olon / m * k + 0.5) AS mm, greatest(k - odd, 1) AS ni FROM r),
            v AS (SELECT *, 360.0 / ni * ({mod.format(a="mm", b="ni")} + CASE WHEN odd = 1 THEN olon ELSE elon END / m) AS east FROM u)
            SELECT event_id, CASE WHEN fits AND abs(y) <= 90 THEN round(y, 9) END AS lat, CASE WHEN fits AND abs(y) <= 90 THEN round(CASE WHEN east >= 180 THEN east - 360 ELSE east END, 9) END AS lon FROM v""",
        "cpr_surface": f"""WITH x AS (SELECT event_id, event_id % 2 AS odd, (event_id * 1009) % 131072 / 131072.0 AS y, (event_id * 2003 + 77) % 131072 / 131072.0 AS x FROM events),
            a AS (SELECT *, 90.0 / (60 - odd) AS dl FROM x),
            b AS (SELECT *, dl * (floor(51.99 / dl) + floor(0.5 + {mod.format(a="51.99", b="dl")} / dl - y) + y) AS lat FROM a),
            c AS (SELECT *, 90.0 / greatest({zones.format(x="lat")} - odd, 1) AS dn FROM b)
            SELECT event_id, round(lat, 9) AS lat, round(dn * (floor(4.375 / dn) + floor(0.5 + {mod.format(a="4.375", b="dn")} / dn - x) + x), 9) AS lon FROM c""",
        "pipeline_e2e": f"""{with_e}, {CHAIN}, {dedup("conf", "confirmed_before")},
            src AS (SELECT c.* FROM conf c JOIN fold f USING (seq) WHERE f.accepted), {SNAPSHOT}, {BLOCKS}
            SELECT b.block AS ts_100ns, upper(lpad(to_hex(f.icao + 4194304), 6, '0')) AS mode_s_code, f.v, f.alt, f.call_sign, f.squawk FROM blocks b JOIN fixes f USING (seq)
            WHERE b.block >= 17041536000000000 + 864000000000 AND b.block < 17041536000000000 + 27 * 864000000000""",
    }
