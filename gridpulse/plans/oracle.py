"""DuckDB SQL for every ``queries()`` entry: the same computation written
independently in SQL over the same parquet tables (the correctness oracle)."""

from __future__ import annotations

from gridpulse.plans.standins import EVENT_TYPES, EXCHANGE_BY_TYPE

DAY_LO, DAY_HI = "TIMESTAMP '2024-01-02 00:00:00'", "TIMESTAMP '2024-01-03 00:00:00'"
SLIDER_NEXT = "TIMESTAMP '2024-01-16 00:00:00'"
SLIDER_DAY = f"hour_utc >= TIMESTAMP '2024-01-15 00:00:00' AND hour_utc < {SLIDER_NEXT}"
YEAR_NEXT = "TIMESTAMP '2025-01-01 00:00:00'"

EV = "ev AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

PROD = ("prod AS (SELECT date_trunc('hour', ts) AS hour_utc, user_id AS municipality_number, "
        + ", ".join(f"sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = '{t}') AS {t}"
                    for t in EVENT_TYPES)
        + " FROM events GROUP BY 1, 2)")

CONS = ("cons AS (SELECT date_trunc('hour', ts) AS hour_utc, user_id AS municipality_number, "
        "event_type AS industry_groups, sum(CAST(value AS DECIMAL(18,2))) AS consumption_kwh "
        "FROM events GROUP BY 1, 2, 3)")

_types = ", ".join(f"'{t}'" for t in EXCHANGE_BY_TYPE)
PC = ("pc AS (SELECT date_trunc('hour', ts) AS hour_utc, "
      "CASE WHEN user_id % 2 = 0 THEN 'DK1' ELSE 'DK2' END AS price_area, "
      + ", ".join(f"sum(CAST(value AS DECIMAL(18,2)) - 40) FILTER (WHERE event_type = '{t}') AS {c}"
                  for t, c in EXCHANGE_BY_TYPE.items())
      + f" FROM events WHERE event_type IN ({_types}) GROUP BY 1, 2)")
PCL = ("pcl AS (" + " UNION ALL ".join(
    f"SELECT hour_utc, price_area, '{c}' AS exchange_column, {c} AS mwh FROM pc WHERE {c} IS NOT NULL"
    for c in EXCHANGE_BY_TYPE.values()) + ")")
COUNTRIES = ("countries AS (SELECT exchange_column, country, CAST(lat AS DOUBLE) AS lat, "
             "CAST(lon AS DOUBLE) AS lon, ord FROM (VALUES "
             "('exchangegb_mwh', 'Great Britain', 51.5074, -0.1278, 0), "
             "('exchangenl_mwh', 'Netherlands', 52.3676, 4.9041, 1), "
             "('exchangege_mwh', 'Germany', 52.52, 13.4050, 2), "
             "('exchangeno_mwh', 'Norway', 59.9139, 10.7522, 3)) "
             "t(exchange_column, country, lat, lon, ord))")
ROLES = ("roles AS (SELECT name, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM (VALUES "
         "('DK1', 56.1496, 10.2134), ('DK2', 55.6761, 12.5683), ('Germany', 52.52, 13.405), "
         "('Netherlands', 52.3676, 4.9041), ('Norway', 60.472, 8.4689), "
         "('Great Britain', 51.5074, -0.1278)) t(name, lat, lon))")


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _r(x: str) -> str:
    return f"round({x}, 4)"


def _round4(sql: str) -> str:
    """``round(x, 4)`` -> ``round(x * 1e4) / 1e4 + 0.0`` on DOUBLE, the same
    arithmetic the Spark side uses, so both round ties alike."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("round")
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = sql[j + len("round("):k]
        if inner.endswith(", 4"):
            expr = _round4(inner[:-3])
            out.append(sql[i:j])
            out.append(f"(round(CAST({expr} AS DOUBLE) * CAST(10000.0 AS DOUBLE)) "
                       f"/ CAST(10000.0 AS DOUBLE) + CAST(0.0 AS DOUBLE))")
        else:
            out.append(sql[i:k + 1])
        i = k + 1


def _f2(x: str) -> str:
    return f"printf('%.2f', CAST({x} AS DOUBLE))"


def _split(v: str, imp: str, exp: str, cond: str | None = None) -> str:
    extra = f" AND {cond}" if cond else ""
    return (f"coalesce(sum({v}) FILTER (WHERE {v} < 0{extra}), 0) AS {imp}, "
            f"coalesce(sum({v}) FILTER (WHERE {v} > 0{extra}), 0) AS {exp}")


def _rescale(x: str, lo: str, hi: str, out_lo: float, out_hi: float) -> str:
    return (f"CASE WHEN {x} >= {hi} THEN CAST({out_hi!r} AS DOUBLE) "
            f"WHEN {x} <= {lo} THEN CAST({out_lo!r} AS DOUBLE) "
            f"ELSE CAST({out_lo!r} AS DOUBLE) + ({x} - {lo}) * CAST({float(out_hi) - float(out_lo)!r} AS DOUBLE) "
            f"/ ({hi} - {lo}) END")


ON_DAY = f"hour_utc >= {DAY_LO} AND hour_utc < {DAY_HI}"

CLEAN_LOAD = f"""
WITH {EV},
w AS (SELECT event_id, value, event_type AS municipality,
             CASE WHEN k = 0 THEN NULL WHEN k = 1 THEN 'not-a-time'
                  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS tstext FROM ev),
p AS (SELECT event_id, try_strptime(tstext, '%Y-%m-%d %H:%M:%S') AS ts, municipality, value
      FROM w WHERE tstext IS NOT NULL)
SELECT event_id, ts, municipality, round(value, 4) AS value FROM p
WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts <= TIMESTAMP '2024-01-27 23:59:59'
"""


def _impute_sql() -> str:
    cols = EVENT_TYPES
    win = []
    for m in cols:
        win.append(f"last_value({m} IGNORE NULLS) OVER wu AS pv_{m}, "
                   f"last_value(CASE WHEN {m} IS NOT NULL THEN rn END IGNORE NULLS) OVER wu AS pp_{m}, "
                   f"first_value({m} IGNORE NULLS) OVER wf AS nv_{m}, "
                   f"first_value(CASE WHEN {m} IS NOT NULL THEN rn END IGNORE NULLS) OVER wf AS np_{m}")
    fin = []
    for m in cols:
        interp = (f"CASE WHEN pp_{m} IS NOT NULL AND np_{m} IS NOT NULL THEN "
                  f"(nv_{m} - pv_{m}) / CAST(np_{m} - pp_{m} AS DOUBLE) * "
                  f"(CAST(rn AS DOUBLE) - CAST(pp_{m} AS DOUBLE)) + pv_{m} END")
        fin.append(f"round(coalesce({m}, {interp}, pv_{m}, nv_{m}), 4) AS {m}")
    dbl = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in cols)
    return f"""
WITH {PROD},
d AS (SELECT hour_utc, municipality_number, {dbl} FROM prod),
n AS (SELECT *, row_number() OVER (PARTITION BY municipality_number ORDER BY hour_utc) AS rn FROM d),
f AS (SELECT *, {", ".join(win)} FROM n
      WINDOW wu AS (PARTITION BY municipality_number ORDER BY hour_utc
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             wf AS (PARTITION BY municipality_number ORDER BY hour_utc
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT hour_utc, municipality_number, {", ".join(fin)} FROM f
"""


NULL_PROFILE = f"WITH {PROD}\n" + "\nUNION ALL\n".join(
    f"SELECT '{m}' AS measure, count(*) AS n_rows, count(*) FILTER (WHERE {m} IS NULL) AS n_null, "
    f"count({m}) AS n_non_null, {_r(f'sum(coalesce({m}, 0))')} AS sum_filled FROM prod"
    for m in EVENT_TYPES)

DIM_WITH_DISTANCE = f"""
WITH obs AS (SELECT user_id AS c_custkey, ts, event_id,
                    CASE WHEN event_type <> 'error' THEN value END AS d FROM events),
dist AS (SELECT c_custkey, first(d ORDER BY ts, event_id) AS dd FROM obs
         WHERE d IS NOT NULL GROUP BY c_custkey)
SELECT c.c_custkey, c.c_name, c.c_nationkey, round(c.c_acctbal, 4) AS c_acctbal, c.c_mktsegment,
       round(dist.dd, 4) AS distance_to_station_km,
       concat_ws('<br>', coalesce(c.c_name, ''),
                 'Nation: ' || coalesce(CAST(c.c_nationkey AS VARCHAR), ''),
                 'Segment: ' || coalesce(c.c_mktsegment, ''),
                 'Balance: ' || coalesce(printf('%.2f', c.c_acctbal), ''))
       || '<br>' || CASE WHEN dist.dd IS NOT NULL
                         THEN 'Distance to Station (km): ' || CAST(dist.dd AS VARCHAR) ELSE '' END
       AS hover_text
FROM customer c LEFT JOIN dist ON c.c_custkey = dist.c_custkey
"""

ENTITY_DAY_TOTAL = f"""
WITH {PROD},
t AS (SELECT municipality_number, sum(click) AS total FROM prod WHERE {ON_DAY} GROUP BY 1)
SELECT c.c_custkey, {_r('coalesce(t.total, 0)')} AS total_mwh,
       {_r('coalesce(t.total, 0) * 1000')} AS total_kwh
FROM customer c LEFT JOIN t ON c.c_custkey = t.municipality_number
"""

ENTITY_GROUP_DAY_TOTAL = f"""
WITH {CONS},
t AS (SELECT municipality_number, sum(consumption_kwh) AS total FROM cons
      WHERE {ON_DAY} AND industry_groups = 'purchase' GROUP BY 1)
SELECT c.c_custkey, 'purchase' AS industry_group, {_r('coalesce(t.total, 0)')} AS total_kwh
FROM customer c LEFT JOIN t ON c.c_custkey = t.municipality_number
"""


def _map_sql(cte: str, src: str, value: str, where: str, factor: float, out_lo: float,
             palette: str, kind: str, total_cols: str, text_total: str) -> str:
    return f"""
WITH {cte},
t AS (SELECT municipality_number, sum({value}) AS total FROM {src} WHERE {where} GROUP BY 1),
m AS (SELECT c.c_custkey AS code, c.c_name, coalesce(t.total, 0) AS total FROM customer c
      LEFT JOIN t ON c.c_custkey = t.municipality_number),
s AS (SELECT *, CASE WHEN total >= 0 THEN ln(sqrt({_d('total')}) + CAST(1.0 AS DOUBLE))
                     * CAST({factor!r} AS DOUBLE) END AS size FROM m),
r AS (SELECT *, min(size) OVER w AS lo, max(size) OVER w AS hi FROM s
      WINDOW w AS (ORDER BY code ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT *, {_rescale('size', 'lo', 'hi', out_lo, 1.0)} AS sc FROM r)
SELECT code, {total_cols}, round(size, 4) AS size, round(sc, 4) AS scale,
       CAST(trunc(sc * CAST(8.0 AS DOUBLE)) AS INTEGER) AS color_index, '{palette}' AS palette,
       c_name || '<br>Municipality Number: ' || CAST(code AS VARCHAR) || '{kind}'
       || {_f2(text_total)} || ' kWh<br>Selected Day: 2024-01-02' AS text
FROM q
"""


PRODUCTION_MAP = _map_sql(PROD, "prod", "click", ON_DAY, 7.0, 0.0, "Blues",
                          "<br>Production Type: click<br>Power Production: ",
                          f"{_r('total')} AS total_mwh, {_r('total * 1000')} AS total_kwh",
                          "total * 1000")
CONSUMPTION_MAP = _map_sql(CONS, "cons", "consumption_kwh",
                           f"{ON_DAY} AND industry_groups = 'purchase'", 4.0, 0.3, "Oranges",
                           "<br>Industry Group: purchase<br>Power Consumption: ",
                           f"{_r('total')} AS total_kwh", "total")

PRODUCTION_MAP_WIND = f"""SELECT code, total_mwh, scale, CAST(trunc(scale_raw * CAST(6.0 AS DOUBLE)) AS INTEGER) AS color_index, 'Teal' AS palette FROM (
{_map_sql(PROD, "prod", "view", ON_DAY, 7.0, 0.0, "Teal", "", f"{_r('total')} AS total_mwh, sc AS scale_raw", "total")})
"""

ZONE_ROWS = f"""
zs AS (SELECT price_area, exchange_column, {_split('mwh', 'imp', 'exp')} FROM pcl
       WHERE price_area IN ('DK1', 'DK2') AND {ON_DAY} GROUP BY 1, 2),
grid AS (SELECT a.price_area, c.* FROM (VALUES ('DK1'), ('DK2')) a(price_area) CROSS JOIN countries c),
zr AS (SELECT g.price_area, g.country, g.ord, coalesce(zs.imp, 0) AS import_mwh,
              coalesce(zs.exp, 0) AS export_mwh FROM grid g
       LEFT JOIN zs ON g.price_area = zs.price_area AND g.exchange_column = zs.exchange_column),
zt AS (SELECT *, 'Import from ' || country || ': ' || {_f2('import_mwh')} || ' MWh<br>Export to '
              || country || ': ' || {_f2('export_mwh')} || ' MWh<br>' AS text FROM zr)"""

ZONE_EXCHANGE = f"""
WITH {PC}, {PCL}, {COUNTRIES}, {ZONE_ROWS}
SELECT price_area, country, {_r('import_mwh')} AS import_mwh, {_r('export_mwh')} AS export_mwh, text
FROM zt
"""

NEIGHBOUR_ROWS = f"""
ns AS (SELECT exchange_column,
              {_split('mwh', 'day_import', 'day_export', SLIDER_DAY)},
              coalesce(sum(mwh) FILTER (WHERE {SLIDER_DAY}), 0) AS day_net,
              {_split('mwh', 'cum_import', 'cum_export', f'hour_utc < {SLIDER_NEXT}')},
              {_split('mwh', 'year_import', 'year_export', f'hour_utc < {YEAR_NEXT}')}
       FROM pcl GROUP BY 1),
nj AS (SELECT c.country, c.ord, coalesce(day_import, 0) AS day_import,
              coalesce(day_export, 0) AS day_export, coalesce(day_net, 0) AS day_net,
              coalesce(cum_import, 0) AS cum_import, coalesce(cum_export, 0) AS cum_export,
              coalesce(year_import, 0) AS year_import, coalesce(year_export, 0) AS year_export
       FROM countries c LEFT JOIN ns ON c.exchange_column = ns.exchange_column),
nk AS (SELECT *, abs(cum_import) + abs(cum_export) AS current_use,
              abs(year_import) + abs(year_export) AS yearly_max FROM nj),
nu AS (SELECT *,
         CASE WHEN {_d('current_use')} < CAST(0.8 AS DOUBLE) * {_d('yearly_max')} THEN 'green'
              WHEN {_d('current_use')} < CAST(0.95 AS DOUBLE) * {_d('yearly_max')} THEN 'yellow'
              ELSE 'red' END AS level,
         ln(abs({_d('cum_export + cum_import')}) + CAST(1.0 AS DOUBLE)) * CAST(7.0 AS DOUBLE) AS size,
         country || '<br>Latitude:' || CAST(rl.lat AS VARCHAR) || '<br>Longitude:' || CAST(rl.lon AS VARCHAR)
         || '<br>Cumulative Trade Numbers up until Selected Day: 2024-01-15 00:00:00<br>Total Export to '
         || country || ': ' || {_f2('cum_export')} || ' MWh<br>Total Import from ' || country || ': '
         || {_f2('cum_import')} || ' MWh<br>Current Use: ' || {_f2('current_use')}
         || ' MWh<br>Yearly Max: ' || {_f2('yearly_max')} || ' MWh' AS text
       FROM nk LEFT JOIN roles rl ON rl.name = nk.country)"""

ROLE_COLS = ("role_cols AS (SELECT name, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, "
             "export_column, import_column FROM (VALUES "
             "('Germany', 52.52, 13.405, 'exchangege_mwh', 'exchangenl_mwh'), "
             "('Netherlands', 52.3676, 4.9041, 'exchangenl_mwh', 'exchangege_mwh'), "
             "('Norway', 60.472, 8.4689, 'exchangeno_mwh', 'exchangege_mwh'), "
             "('Great Britain', 51.5074, -0.1278, 'exchangegb_mwh', 'exchangege_mwh')) "
             "t(name, lat, lon, export_column, import_column))")

NEIGHBOUR_TRADE_LITERAL = f"""
WITH {PC}, {PCL}, {ROLE_COLS},
s AS (SELECT exchange_column,
             coalesce(sum(mwh) FILTER (WHERE price_area IN ('DK1', 'DK2') AND {SLIDER_DAY}), 0) AS day_net,
             coalesce(sum(mwh) FILTER (WHERE hour_utc < {SLIDER_NEXT}), 0) AS cum_net,
             coalesce(sum(mwh) FILTER (WHERE hour_utc < {YEAR_NEXT}), 0) AS year_net
      FROM pcl GROUP BY 1),
r AS (SELECT name, lat, lon,
             CASE WHEN name = 'Great Britain' THEN import_column ELSE export_column END AS ec,
             CASE WHEN name = 'Great Britain' THEN export_column ELSE import_column END AS ic
      FROM role_cols),
j AS (SELECT r.name AS country, r.lat, r.lon,
             coalesce(e.day_net, 0) AS day_export, coalesce(e.cum_net, 0) AS cum_export,
             coalesce(e.year_net, 0) AS year_export, coalesce(i.day_net, 0) AS day_import,
             coalesce(i.cum_net, 0) AS cum_import, coalesce(i.year_net, 0) AS year_import
      FROM r LEFT JOIN s e ON e.exchange_column = r.ec LEFT JOIN s i ON i.exchange_column = r.ic),
k AS (SELECT *, abs(cum_import) + abs(cum_export) AS current_use,
             abs(year_import) + abs(year_export) AS yearly_max FROM j)
SELECT country, lat, lon, {", ".join(f"{_r(c)} AS {c}" for c in
    ["day_export", "cum_export", "year_export", "day_import", "cum_import", "year_import",
     "current_use", "yearly_max"])},
       round(ln(abs({_d('cum_export + cum_import')}) + CAST(1.0 AS DOUBLE)) * CAST(7.0 AS DOUBLE), 4) AS size,
       CASE WHEN {_d('current_use')} < CAST(0.8 AS DOUBLE) * {_d('yearly_max')} THEN 'green'
            WHEN {_d('current_use')} < CAST(0.95 AS DOUBLE) * {_d('yearly_max')} THEN 'yellow'
            ELSE 'red' END AS level
FROM k
"""

_NUM = ["day_import", "day_export", "day_net", "cum_import", "cum_export", "year_import",
        "year_export", "current_use", "yearly_max", "size"]

NEIGHBOUR_UTILISATION = f"""
WITH {PC}, {PCL}, {COUNTRIES}, {ROLES}, {NEIGHBOUR_ROWS}
SELECT country, {", ".join(f"{_r(c)} AS {c}" for c in _NUM)}, level, text FROM nu
"""

ZONE_DOTS = f"""
WITH {PC}, {PCL}, {COUNTRIES}, {ROLES}, {ZONE_ROWS}, {NEIGHBOUR_ROWS},
zones AS (SELECT price_area, string_agg(text, '' ORDER BY ord) AS fragments FROM zt GROUP BY 1)
SELECT z.price_area AS name, r.lat, r.lon,
       z.price_area || '<br>Daily values for Selected Day:2024-01-02 00:00:00<br>' || z.fragments AS text,
       CAST(NULL AS DOUBLE) AS size, CAST(NULL AS VARCHAR) AS level
FROM zones z LEFT JOIN roles r ON r.name = z.price_area
UNION ALL
SELECT n.country AS name, r.lat, r.lon, n.text, round(n.size, 4) AS size, n.level
FROM nu n JOIN roles r ON r.name = n.country
"""

CUMULATIVE_BY_DAY = f"""
WITH {PC}, {PCL}, {COUNTRIES},
d AS (SELECT exchange_column, CAST(hour_utc AS DATE) AS day, {_split('mwh', 'day_import', 'day_export')}
      FROM pcl GROUP BY 1, 2)
SELECT c.country, d.day, {_r('day_import')} AS day_import, {_r('day_export')} AS day_export,
       {_r('sum(day_import) OVER w')} AS cum_import, {_r('sum(day_export) OVER w')} AS cum_export
FROM d JOIN countries c ON c.exchange_column = d.exchange_column
WINDOW w AS (PARTITION BY d.exchange_column ORDER BY d.day
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""


def _share(src: str, keys: str, imp: str, exp: str, labels) -> str:
    return f"""
dirs AS (SELECT {keys}, 'import' AS direction, '{labels[0]}' AS label, abs({_d(imp)}) AS mwh FROM {src}
         UNION ALL SELECT {keys}, 'export' AS direction, '{labels[1]}' AS label, abs({_d(exp)}) AS mwh
         FROM {src}),
sh AS (SELECT *, abs(mwh) / nullif(sum(abs(mwh)) OVER (PARTITION BY {keys}), 0) AS share FROM dirs)"""


ZONE_SHARE = f"""
WITH {PC}, {PCL}, {COUNTRIES}, {ZONE_ROWS}, {_share('zt', 'price_area, country', 'import_mwh', 'export_mwh', ('Import', 'Export'))}
SELECT price_area, country, direction, label, round(mwh, 4) AS mwh, round(share, 4) AS share FROM sh
"""

COUNTRY_SHARE = f"""
WITH {PC}, {PCL}, {COUNTRIES}, {ROLES}, {NEIGHBOUR_ROWS}, {_share('nu', 'country', 'cum_import', 'cum_export', ('(MWh) Import from', '(MWh) Export to'))}
SELECT country, direction, label, round(mwh, 4) AS mwh, round(share, 4) AS share FROM sh
"""

NET_LOCATIONS = f"""
WITH {PC}, {PCL}, {COUNTRIES},
t AS (SELECT exchange_column, sum(mwh) AS value FROM pcl
      WHERE price_area IN ('DK1', 'DK2') AND {ON_DAY} GROUP BY 1)
SELECT c.country AS name, c.lat, c.lon, {_r('t.value')} AS value
FROM countries c JOIN t ON c.exchange_column = t.exchange_column
WHERE t.value IS NOT NULL AND t.value <> 0
"""

JSON_PROPERTY_ZSCORE = f"""
WITH {EV},
w AS (SELECT event_id, ts, CASE WHEN event_type = 'view' THEN 'pageview' ELSE event_type END AS municipality,
             CASE WHEN k = 2 THEN substring(props, 1, length(props) - 1)
                  WHEN k = 3 THEN '{{"k": "n/a"}}' ELSE props END AS wd FROM ev),
o AS (SELECT event_id, ts, municipality,
             CASE WHEN json_valid(wd) THEN TRY_CAST(json_extract_string(wd, '$.k') AS DOUBLE) END AS value,
             CAST(ts AS DATE) AS day
      FROM w WHERE municipality IN ('click', 'purchase', 'signup', 'pageview')),
st AS (SELECT municipality, day, coalesce(sum(value), 0) AS day_sum, avg(value) AS mean, stddev_samp(value) AS std
       FROM o GROUP BY 1, 2),
z AS (SELECT o.*, st.day_sum, st.mean, st.std,
             abs(o.value - st.mean) / nullif(st.std, 0) * CAST(15.0 AS DOUBLE) AS z_size
      FROM o JOIN st ON o.municipality = st.municipality AND o.day = st.day),
b AS (SELECT day, min(z_size) AS lo, max(z_size) AS hi FROM z GROUP BY day),
f AS (SELECT z.*, {_rescale('z_size', 'b.lo', 'b.hi', 0.3, 1.0)} AS sc FROM z JOIN b ON z.day = b.day)
SELECT event_id, municipality, ts, day, value, round(day_sum, 4) AS day_sum, round(mean, 4) AS mean,
       round(std, 4) AS std, round(z_size, 4) AS z_size, round(sc, 4) AS scale,
       CASE WHEN sc IS NULL THEN NULL
            ELSE CAST(least(greatest(trunc(sc * CAST(8.0 AS DOUBLE)), 0), 8) AS INTEGER) END AS color_index,
       '<br>Municipality Center for Weather Data Collection: ' || municipality
       || '<br>Weather Property: k<br>Sum of k for the Selected Day: '
       || printf('%.2f', day_sum) || '<br>Selected Day: ' || strftime(day, '%Y-%m-%d') AS text
FROM f
"""

_PI = "pi()"
SMOOTH_SERIES = f"""
WITH s AS (SELECT event_type, date_trunc('hour', ts) AS hour_utc,
                  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY 1, 2),
p AS (SELECT event_type, hour_utc, coalesce(value, CAST(0.0 AS DOUBLE)) AS raw,
             CAST(row_number() OVER (PARTITION BY event_type ORDER BY hour_utc) - 1 AS DOUBLE) AS pos,
             CAST(count(*) OVER (PARTITION BY event_type) AS DOUBLE) AS n FROM s),
m AS (SELECT DISTINCT event_type, n, CAST(floor(n * CAST(0.02 AS DOUBLE)) AS INTEGER) AS keep FROM p),
ks AS (SELECT event_type, n, unnest(range(keep)) AS k FROM m),
coef AS (SELECT p.event_type, ks.k,
                sum(p.raw * cos({_PI} * (CAST(2.0 AS DOUBLE) * p.pos + CAST(1.0 AS DOUBLE)) * ks.k
                                / (CAST(2.0 AS DOUBLE) * p.n)))
                * sqrt(CASE WHEN ks.k = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(2.0 AS DOUBLE) END / ks.n) AS c
         FROM p JOIN ks ON p.event_type = ks.event_type GROUP BY p.event_type, ks.k, ks.n),
rec AS (SELECT p.event_type, p.hour_utc, p.raw,
               sum(c.c * sqrt(CASE WHEN c.k = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(2.0 AS DOUBLE) END / p.n)
                   * cos({_PI} * (CAST(2.0 AS DOUBLE) * p.pos + CAST(1.0 AS DOUBLE)) * c.k
                         / (CAST(2.0 AS DOUBLE) * p.n))) AS sm
        FROM p LEFT JOIN coef c ON p.event_type = c.event_type
        GROUP BY p.event_type, p.hour_utc, p.raw)
SELECT event_type, hour_utc, strftime(hour_utc, '%Y-%m-%dT%H:%M:%S') AS iso, round(raw, 4) AS raw,
       round(coalesce(sm, CAST(0.0 AS DOUBLE)), 4) AS smoothed,
       hour_utc = TIMESTAMP '2024-01-15 00:00:00' AS is_selected
FROM rec
"""

def _smooth_sql(src: str, key: str, order: str, extra_out: str = "") -> str:
    """DCT low-pass per series in SQL: positions, kept coefficients, inverse."""
    two, one = "CAST(2.0 AS DOUBLE)", "CAST(1.0 AS DOUBLE)"
    basis = lambda pos, k, n: f"cos({_PI} * ({two} * {pos} + {one}) * {k} / ({two} * {n}))"
    weight = lambda k, n: f"sqrt(CASE WHEN {k} = 0 THEN {one} ELSE {two} END / {n})"
    return f"""
p AS (SELECT *, CAST(row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS DOUBLE) AS pos,
             CAST(count(*) OVER (PARTITION BY {key}) AS DOUBLE) AS n FROM {src}),
m AS (SELECT DISTINCT {key}, n, CAST(floor(n * CAST(0.02 AS DOUBLE)) AS INTEGER) AS keep FROM p),
ks AS (SELECT {key}, n, unnest(range(keep)) AS k FROM m),
coef AS (SELECT p.{key}, ks.k, sum(p.raw * {basis('p.pos', 'ks.k', 'p.n')}) * {weight('ks.k', 'ks.n')} AS c
         FROM p JOIN ks ON p.{key} = ks.{key} GROUP BY p.{key}, ks.k, ks.n),
rec AS (SELECT p.*, coalesce((SELECT sum(c.c * {weight('c.k', 'p.n')} * {basis('p.pos', 'c.k', 'p.n')})
                              FROM coef c WHERE c.{key} = p.{key}), CAST(0.0 AS DOUBLE)) AS sm FROM p)"""


SMOOTH_LONG_SERIES = f"""
WITH src AS (SELECT event_type, event_id, ts, coalesce(value, CAST(0.0 AS DOUBLE)) AS raw FROM events),
{_smooth_sql('src', 'event_type', 'ts, event_id').replace('0.02', '0.01')}
SELECT event_type, event_id, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n_points, round(sm, 4) AS smoothed FROM rec
"""

PRODUCTION_SERIES = f"""
WITH {PROD},
codes AS (SELECT DISTINCT c.c_custkey FROM customer b JOIN customer c ON c.c_name = b.c_name),
src AS (SELECT municipality_number, hour_utc, coalesce(CAST(click AS DOUBLE), CAST(0.0 AS DOUBLE)) AS raw
        FROM prod WHERE municipality_number IN (SELECT c_custkey FROM codes)),
{_smooth_sql('src', 'municipality_number', 'hour_utc')}
SELECT municipality_number, hour_utc, round(raw, 4) AS raw, round(sm, 4) AS smoothed,
       hour_utc = TIMESTAMP '2024-01-15 00:00:00' AS is_selected
FROM rec
"""

CONSUMPTION_SERIES = f"""
WITH src AS (SELECT event_type, 1 AS municipality_number, date_trunc('hour', ts) AS hour_utc,
                    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS raw
             FROM events WHERE user_id % 2 = 0 GROUP BY 1, 2, 3),
{_smooth_sql('src', 'event_type', 'hour_utc')}
SELECT municipality_number, event_type AS industry_groups, hour_utc, round(raw, 4) AS raw, round(sm, 4) AS smoothed,
       hour_utc = TIMESTAMP '2024-01-15 00:00:00' AS is_selected
FROM rec
"""

_MEASURES = ["offshore_wind_mwh_gte_100", "offshore_wind_mwh_lt_100", "onshore_wind_power_mwh", "solar_power_mwh",
             "thermal_power_production"]
TYPED_LOAD = f"""
WITH e AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id,
  CASE WHEN k = 1 THEN NULL WHEN k % 3 = 0 THEN date_trunc('second', ts) - INTERVAL 2 HOUR ELSE date_trunc('second', ts) END AS hour_utc,
  CASE WHEN k = 5 THEN NULL ELSE CAST(user_id AS INTEGER) END AS municipality_number,
  {', '.join(f"CASE WHEN k % 10 = {i} THEN NULL ELSE round(value, 4) END AS {c}" for i, c in enumerate(_MEASURES))}
FROM e
"""

WEATHER_SERIES = f"""
WITH {EV},
w AS (SELECT event_id, ts, CASE WHEN event_type = 'view' THEN 'pageview' ELSE event_type END AS municipality,
             CASE WHEN k = 2 THEN substring(props, 1, length(props) - 1)
                  WHEN k = 3 THEN '{{"k": "n/a"}}' ELSE props END AS wd FROM ev),
o AS (SELECT municipality, date_trunc('hour', ts) AS hour_utc,
             CASE WHEN json_valid(wd) THEN
                  CASE WHEN json_exists(wd, '$.k') THEN TRY_CAST(json_extract_string(wd, '$.k') AS DOUBLE)
                       ELSE CAST(0.0 AS DOUBLE) END END AS value
      FROM w),
src AS (SELECT municipality, hour_utc, coalesce(avg(value), CAST(0.0 AS DOUBLE)) AS raw FROM o GROUP BY 1, 2),
{_smooth_sql('src', 'municipality', 'hour_utc')}
SELECT municipality, hour_utc, round(raw, 4) AS raw, round(sm, 4) AS smoothed FROM rec
"""

REGION_POINTS = f"""
WITH {EV},
p AS (SELECT event_id AS point_id, value / CAST(25.0 AS DOUBLE) - CAST(5.0 AS DOUBLE) AS lon,
             CAST(45.0 AS DOUBLE) + CAST(k AS DOUBLE) / CAST(5.0 AS DOUBLE) AS lat FROM ev)
SELECT point_id, round(lon, 4) AS lon, round(lat, 4) AS lat,
  CASE WHEN lon > 7 AND lon < 12 AND lat > 54 AND lat < 57 THEN 'DK1'
       WHEN lon > 12 AND lon < 15 AND lat > 54 AND lat < 57 THEN 'DK2'
       WHEN lon < 2 AND lat > 50 THEN 'Great Britain'
       WHEN lon > 11 AND lon < 14 AND lat > 47 AND lat < 55 THEN 'Germany'
       WHEN lon > 3 AND lon < 6 AND lat > 50 AND lat < 53 THEN 'Netherlands'
       WHEN lon > 4 AND lon < 10 AND lat > 58 AND lat < 63 THEN 'Norway' END AS region,
  coalesce((lon >= 8 AND lon <= 10 AND lat >= 54 AND lat <= 56)
        OR (lon >= 13 AND lon <= 15 AND lat >= 54 AND lat <= 56)
        OR (lon >= -2 AND lon <= 1 AND lat >= 50 AND lat <= 59)
        OR (lon >= 11 AND lon <= 14 AND lat >= 47 AND lat <= 55)
        OR (lon >= 3 AND lon <= 6 AND lat >= 50 AND lat <= 54)
        OR (lon >= 8 AND lon <= 10 AND lat >= 58 AND lat <= 62), false) AS is_valid
FROM p
"""

REGION_VALID_JOIN = f"""
WITH {EV},
p AS (SELECT event_id AS point_id, value / CAST(25.0 AS DOUBLE) - CAST(5.0 AS DOUBLE) AS lon,
             CAST(45.0 AS DOUBLE) + CAST(k AS DOUBLE) / CAST(5.0 AS DOUBLE) AS lat FROM ev),
b AS (SELECT * FROM (VALUES (8, 10, 54, 56), (13, 15, 54, 56), (-2, 1, 50, 59), (11, 14, 47, 55),
                            (3, 6, 50, 54), (8, 10, 58, 62)) t(lon_lo, lon_hi, lat_lo, lat_hi))
SELECT point_id, EXISTS (SELECT 1 FROM b WHERE p.lon BETWEEN b.lon_lo AND b.lon_hi
                                          AND p.lat BETWEEN b.lat_lo AND b.lat_hi) AS is_valid
FROM p
"""

_CUSTOMER_BOXES = """
p AS (SELECT event_id AS point_id, value / CAST(25.0 AS DOUBLE) - CAST(5.0 AS DOUBLE) AS lon,
             CAST(45.0 AS DOUBLE) + CAST(k AS DOUBLE) / CAST(5.0 AS DOUBLE) AS lat FROM ev),
c AS (SELECT c_name AS location, c_custkey AS k, CAST(c_custkey * 37 % 1000 AS DOUBLE) / 25.0::DOUBLE - 5.0::DOUBLE AS x,
             CAST(c_custkey * 53 % 997 AS DOUBLE) / 50.0::DOUBLE + 45.0::DOUBLE AS y,
             pow(2.0::DOUBLE, c_custkey % 7) * 0.05::DOUBLE AS w, pow(2.0::DOUBLE, c_custkey % 5) * 0.03::DOUBLE AS h FROM customer),
b AS (SELECT location, CASE WHEN k % 97 <> 0 THEN k * 7919 % 211 END AS priority, CASE WHEN k % 100 <> 0 THEN x - w END AS lon_lo, x + w AS lon_hi,
             y - h AS lat_lo, CASE WHEN k % 150 <> 0 THEN y + h END AS lat_hi FROM c)"""

POINTS_IN_MANY_BOXES = f"""
WITH {EV}, {_CUSTOMER_BOXES}
SELECT location, count(*) AS n_points, min(point_id) AS first_point, round(max(lon), 4) AS max_lon, round(min(lat), 4) AS min_lat
FROM p JOIN b ON lon <= lon_hi AND lat >= lat_lo AND (lon_lo IS NULL OR lon >= lon_lo) AND (lat_hi IS NULL OR lat <= lat_hi)
GROUP BY location
"""

REGION_BY_PRIORITY = f"""
WITH {EV}, {_CUSTOMER_BOXES},
m AS (SELECT point_id, location, priority FROM p JOIN b ON lon < lon_hi AND lat > lat_lo AND (lon_lo IS NULL OR lon > lon_lo)
        AND (lat_hi IS NULL OR lat < lat_hi)),
f AS (SELECT point_id, first(location ORDER BY priority NULLS LAST, location) AS region FROM m GROUP BY point_id)
SELECT p.point_id, region, f.point_id IS NOT NULL AS is_valid FROM p LEFT JOIN f ON f.point_id = p.point_id
"""

WEATHER_DOCUMENTS = f"""
WITH {EV},
w AS (SELECT *, k IN (0, 3, 7, 8) AS bad, k = 4 AS list, round(value, 2) AS v FROM ev)
SELECT event_id, CASE WHEN bad OR list THEN NULL WHEN event_type = 'view' THEN 'pageview' ELSE event_type END AS municipality,
  CASE WHEN bad OR list OR k IN (2, 5) THEN NULL ELSE round(v, 4) END AS value,
  CASE WHEN bad OR list OR k = 5 THEN NULL WHEN k = 2 THEN 0.0::DOUBLE ELSE round(v, 4) END AS value_or_zero,
  NOT (bad OR list OR k = 2) AS has_key
FROM w
"""

CALENDAR_MARKS = """
WITH b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
d AS (SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT CAST(date - lo + 1 AS INTEGER) AS day_number, date,
       CASE WHEN (date - lo) % 30 = 0 THEN strftime(date, '%B %d') END AS label
FROM d
"""

NAME_LOOKUP = """
WITH named AS (SELECT CASE WHEN n.n_name = 'NATION_1' THEN 'NATION_ONE' ELSE n.n_name END AS name
               FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
g AS (SELECT name, count(*) AS n_customers FROM named GROUP BY name)
SELECT g.name, n.n_nationkey AS code, g.n_customers FROM g LEFT JOIN nation n ON g.name = n.n_name
"""

DOCUMENT_LOAD = """
WITH c AS (SELECT c_custkey AS k, c_custkey % 10 AS kind, c_name, c_mktsegment FROM customer),
t AS (SELECT *, '{"LAU-1 code 1": "' || CASE WHEN kind = 3 THEN 'x' ELSE '' END || k || '", "Municipality": "' || c_name
             || CASE WHEN kind = 2 THEN '' ELSE '", "Region": "' || c_mktsegment END || '", "Total Area (km²)": ' || k
             || ', "Latitude": ' || CASE WHEN kind = 1 THEN '"north"' ELSE '55.5' END || ', "not asked for": [1, 2], "PowerRegion": "DK1"}' AS line FROM c)
SELECT CASE WHEN kind NOT IN (0, 1, 3) THEN CAST(k AS INTEGER) END AS lau_1_code_1, CASE WHEN kind > 1 THEN c_name END AS municipality,
  CASE WHEN kind > 2 THEN c_mktsegment END AS region, CASE WHEN kind > 1 THEN CAST(k AS DOUBLE) END AS total_area_km2,
  CASE WHEN kind > 1 THEN 55.5::DOUBLE END AS latitude, CASE WHEN kind > 1 THEN 'DK1' END AS powerregion,
  CASE WHEN kind = 0 THEN substr(line, 1, length(line) - 9) WHEN kind = 1 THEN line END AS text
FROM t
"""

TYPED_LOADS = """
WITH e AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, date_trunc('second', ts) AS t FROM events),
h AS (SELECT *, CASE WHEN k = 1 THEN NULL WHEN k % 3 = 0 THEN t - INTERVAL 2 HOUR ELSE t END AS hour,
  CASE WHEN k = 1 THEN 'not-a-time' ELSE strftime(t, '%Y-%m-%d %H:%M:%S') || CASE k % 3 WHEN 0 THEN '+02:00' WHEN 1 THEN 'Z' ELSE '' END END AS txt FROM e)
SELECT 'consumption' AS kind, hour AS at, CAST(NULL AS VARCHAR) AS text_at, event_type AS name,
  CASE WHEN k = 5 THEN NULL ELSE CAST(user_id AS INTEGER) END AS code, CASE WHEN k % 10 = 0 THEN NULL ELSE round(value, 4) END AS value FROM h
UNION ALL SELECT 'prodcon', hour, NULL, CASE WHEN user_id % 2 = 0 THEN 'DK1' ELSE 'DK2' END, NULL,
  CASE WHEN k % 10 IN (0, 3) THEN NULL ELSE round(value + value, 4) END FROM h
UNION ALL SELECT 'weather', NULL, txt, event_type, NULL, CASE WHEN k % 10 = 3 THEN NULL ELSE round(value, 4) END FROM h
"""

CATALOG_TOTALS = f"""
WITH {PROD},
t AS (SELECT municipality_number, sum(click) AS total, count(click) AS n FROM prod
      WHERE hour_utc >= TIMESTAMP '2024-01-01' AND hour_utc < TIMESTAMP '2024-04-01' GROUP BY 1)
SELECT CAST(c_custkey AS INTEGER) AS municipality_number, c_name, {_r('coalesce(total, 0)')} AS total_mwh, coalesce(n, 0) AS n_hours
FROM customer LEFT JOIN t ON c_custkey = municipality_number
"""

SERIES_AT_HOUR = f"""
WITH {PROD}
SELECT hour_utc, municipality_number, {_r('click')} AS click, {_r('view')} AS view FROM prod
WHERE municipality_number IN (SELECT municipality_number FROM prod WHERE hour_utc = TIMESTAMP '2024-01-15 00:00:00')
  AND municipality_number IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
"""

SLIDER_VIEWS = f"""
WITH {PC},
b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
m AS (SELECT unnest(range(1, CAST(hi - lo AS BIGINT) + 2)) AS n FROM b),
d AS (SELECT CAST(hour_utc AS DATE) AS day, sum(CASE WHEN exchangeno_mwh < 0 THEN exchangeno_mwh ELSE 0 END) AS imp,
             count(exchangeno_mwh) AS n_some FROM pc GROUP BY 1),
c AS (SELECT day, imp, sum(imp) OVER (ORDER BY day) AS cum FROM d WHERE n_some > 0),
o AS (SELECT CAST(n AS INTEGER) AS day_number, CAST(DATE '2024-01-01' + CAST(n - 1 AS INTEGER) AS DATE) AS day,
             CAST(DATE '2024-01-01' + CAST(n AS INTEGER) AS DATE) AS map_day, n FROM m),
y AS (SELECT sum(least(exchangeno_mwh, 0)) AS year_import FROM pc WHERE CAST(hour_utc AS DATE) <= DATE '2024-01-20'),
j AS (SELECT o.*, CASE WHEN n % 2 = 0 THEN 0 ELSE cum END AS cum_import, CAST(abs(imp) AS DOUBLE) AS size FROM o LEFT JOIN c USING (day)),
g AS (SELECT min(size) AS lo, max(size) AS hi FROM j)
SELECT day_number, day, map_day, CASE n % 3 WHEN 0 THEN 'production' WHEN 1 THEN 'consumption' ELSE 'import_export' END AS active_mode,
  {_r('cum_import')} AS cum_import, {_r('year_import')} AS year_import, {_r(_rescale('size', 'g.lo', 'g.hi', 0.3, 1.0))} AS scale
FROM j, g, y
"""

FIRST_ROWS = """
SELECT o_orderkey, o_custkey, o_orderdate, round(o_totalprice, 4) AS o_totalprice
FROM orders ORDER BY o_orderkey LIMIT 98
"""

FIRST_ORDER = """
SELECT o_custkey, first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS o_orderkey
FROM orders GROUP BY o_custkey
"""

_RAW = {
    "clean_load": CLEAN_LOAD,
    "impute_series": _impute_sql(),
    "null_profile": NULL_PROFILE,
    "dim_with_distance": DIM_WITH_DISTANCE,
    "entity_day_total": ENTITY_DAY_TOTAL,
    "entity_group_day_total": ENTITY_GROUP_DAY_TOTAL,
    "production_map": PRODUCTION_MAP,
    "consumption_map": CONSUMPTION_MAP,
    "zone_exchange": ZONE_EXCHANGE,
    "zone_dots": ZONE_DOTS,
    "neighbour_trade_literal": NEIGHBOUR_TRADE_LITERAL,
    "neighbour_utilisation": NEIGHBOUR_UTILISATION,
    "cumulative_by_day": CUMULATIVE_BY_DAY,
    "zone_share": ZONE_SHARE,
    "country_share": COUNTRY_SHARE,
    "net_locations": NET_LOCATIONS,
    "json_property_zscore": JSON_PROPERTY_ZSCORE,
    "smooth_series": SMOOTH_SERIES,
    "smooth_long_series": SMOOTH_LONG_SERIES,
    "production_series": PRODUCTION_SERIES,
    "consumption_series": CONSUMPTION_SERIES,
    "typed_load": TYPED_LOAD,
    "production_map_wind": PRODUCTION_MAP_WIND,
    "weather_series": WEATHER_SERIES,
    "region_points": REGION_POINTS,
    "region_valid_join": REGION_VALID_JOIN,
    "points_in_many_boxes": POINTS_IN_MANY_BOXES,
    "region_by_priority": REGION_BY_PRIORITY,
    "weather_documents": WEATHER_DOCUMENTS,
    "calendar_marks": CALENDAR_MARKS,
    "name_lookup": NAME_LOOKUP,
    "document_load": DOCUMENT_LOAD,
    "typed_loads": TYPED_LOADS,
    "catalog_totals": CATALOG_TOTALS,
    "series_at_hour": SERIES_AT_HOUR,
    "slider_views": SLIDER_VIEWS,
    "first_rows": FIRST_ROWS,
    "first_order": FIRST_ORDER,
}

ORACLE_SQL = {name: _round4(sql) for name, sql in _RAW.items()}
