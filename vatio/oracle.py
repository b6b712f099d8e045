"""DuckDB SQL for each registered query: an independent, literal statement of
the model definitions (windows with QUALIFY, COUNT(DISTINCT ...), one CTE per
step), run on the same driver tables. Spark results are compared against it.

Each named CTE is a SQL fragment with its dependencies; ``sql(final, deps)``
emits a WITH clause holding every needed CTE in dependency order.
"""

from __future__ import annotations

import math

from .sources import testdata

RUN_TS = "2026-06-01 00:00:00"
# Stated here by value, so that a wrong constant of the implementation shows as a difference.
LOCAL_TZ = "America/Santiago"
TECHNOLOGIES = ("Solar", "Eolica", "Térmica", "Hidráulica de Embalse", "Solar", "Mini Hidráulica de Pasada",
                "Biomasa", None)
RENEWABLE = ("Solar", "Eolica", "Mini Hidráulica de Pasada", "Hidráulica de Pasada", "Geotérmica", "Biomasa", "Biogás")
FALSE_EASTING, FALSE_NORTHING = 500000.0, 10000000.0
SCALED_RADIUS = 6364902.166165086  # 0.9996 times the rectifying radius of WGS84
BETA = (0.0008377321640600574, 5.905869567933988e-08, 1.6734888803548483e-10, 2.1677377630220365e-13)
DELTA = (0.003356551448628875, 6.571913193172696e-06, 1.7677459962075596e-08)
EARTH_RADIUS = 6371010.0


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str, digits: int) -> str:
    """Scaled rounding, same as functions.numeric.round_half_away (a zero
    result is +0.0, as Spark's decimal rounding returns)."""
    if digits == 0:
        r = f"round(CAST({expr} AS DOUBLE))"
    else:
        s = dbl(10.0 ** digits)
        r = f"(round(CAST({expr} AS DOUBLE) * {s}) / {s})"
    return f"(CASE WHEN {r} = 0 THEN CAST(0 AS DOUBLE) ELSE {r} END)"


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def tech(code: str) -> str:
    whens = " ".join(f"WHEN {code} = {i} THEN {q(t)}" for i, t in enumerate(TECHNOLOGIES))
    return f"CAST(CASE {whens} END AS VARCHAR)"


def classify(col: str) -> str:
    lst = ", ".join(q(t) for t in RENEWABLE)
    return f"CASE WHEN {col} IN ({lst}) THEN 'Renovable' ELSE 'Convencional' END"


def decimal_comma(col: str) -> str:
    return f"TRY_CAST(replace(CAST({col} AS VARCHAR), ',', '.') AS DOUBLE)"


#: White space of any script, as ``\\s`` of a pattern leaves out the no-break space and its kin.
WHITE = r"[\s\p{Z}]"


def trimmed(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '^{WHITE}+', ''), '{WHITE}+$', '')"


def sdiv(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def ts(s: str) -> str:
    return f"TIMESTAMP '{s}'"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


# ---- raw contracts from the driver tables ----------------------------------
cte("raw_centrales", [], f"""
SELECT s.s_suppkey AS id_central,
  CASE WHEN s.s_suppkey % 11 = 5 THEN chr(9) || chr(160) ELSE '' END || s.s_name
    || CASE WHEN s.s_suppkey % 11 = 6 THEN chr(160) || ' ' ELSE '' END || CASE WHEN s.s_suppkey % 10 = 3 THEN ' [EN_REVISION]'
                   WHEN s.s_suppkey % 10 = 7 THEN ' [NO_MOSTRAR]'
                   WHEN v.v = 2 AND s.s_suppkey % 10 = 5 THEN ' [EN_REVISION]'
                   ELSE '' END AS central,
  r.r_name AS region, n.n_name AS provincia, n.n_name AS comuna,
  {tech('s.s_suppkey % 8')} AS tipo_tecnologia,
  CASE WHEN v.v = 2 AND s.s_suppkey % 10 = 0 THEN NULL
       WHEN s.s_suppkey % 17 = 16 THEN 'Sin información'
       WHEN s.s_suppkey % 23 = 22 THEN CAST(250000 + (s.s_suppkey * 7919) % 450000 AS VARCHAR) || ',5d'
       ELSE CAST(250000 + (s.s_suppkey * 7919) % 450000 AS VARCHAR) || ',5' END AS coordenada_este,
  CAST(5000000 + (s.s_suppkey * 104729) % 2900000 AS VARCHAR) || ',25' AS coordenada_norte,
  CASE WHEN s.s_suppkey % 19 = 18 THEN 'sin huso' WHEN s.s_suppkey % 3 = 0 THEN '18H' ELSE '19G' END AS zona_huso,
  CASE WHEN v.v = 2 THEN {ts(testdata.REGISTRY_V2_STAMP)} ELSE {ts(testdata.REGISTRY_STAMP)} END AS _extracted_at
FROM supplier s
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN (VALUES (1), (2)) AS v(v) ON v.v = 1 OR s.s_suppkey % 5 = 0""")

(_b1, _n1), (_b2, _) = testdata.GENERATION_DAY_BLOCKS
cte("raw_generacion", [], f"""
SELECT l_orderkey * 10 + l_linenumber AS id_opreal,
  l_suppkey AS id_central,
  CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DOUBLE) ELSE CAST(l_quantity AS DOUBLE) END AS gen_real_mw,
  CAST(CASE WHEN l_partkey % 25 < {_n1} THEN DATE '{_b1}' + CAST(l_partkey % 25 AS INTEGER)
            ELSE DATE '{_b2}' + CAST(l_partkey % 25 - {_n1} AS INTEGER) END AS TIMESTAMP)
    + to_hours(CAST(l_orderkey % 24 AS BIGINT)) AS fecha_hora,
  l_orderkey % 24 + 1 AS hora,
  CASE WHEN l_partkey % 97 = 0 THEN '' WHEN l_partkey % 89 = 0 THEN '0' WHEN l_partkey % 83 = 0 THEN '50f'
       ELSE CAST(50 + l_suppkey % 7 AS VARCHAR) || ',5' END AS potencia_maxima,
  {tech('CASE WHEN l_partkey % 31 = 0 THEN (l_suppkey + 3) % 8 ELSE l_suppkey % 8 END')} AS tipo_tecnologia,
  {ts(testdata.GENERATION_STAMP_BASE)} + to_seconds(CAST(l_orderkey AS BIGINT)) AS _extracted_at
FROM lineitem""")

_hour_union = " UNION ALL ".join(f"SELECT unnest(range({a}, {b + 1})) AS h" for a, b in testdata.era5_hour_ranges())
cte("era5_grid", ["int_compatibilidad_era5"], f"""
SELECT c.latitude, c.longitude, t.h, CAST(c.latitude * 4 AS BIGINT) * 7 + CAST(c.longitude * 4 AS BIGINT) AS cell,
  TIMESTAMP '1970-01-01 00:00:00' + to_hours(t.h) AS valid_time
FROM (SELECT DISTINCT lat_era5 AS latitude, lon_era5 AS longitude FROM int_compatibilidad_era5) c,
     ({_hour_union}) t""")

cte("raw_era5_solar", ["era5_grid"], f"""
SELECT valid_time, latitude, longitude,
  {dbl(273.15)} + CAST(h % 24 + abs(cell) % 8 AS DOUBLE) + {dbl(0.25)} AS t2m,
  CAST(CASE WHEN h % 24 BETWEEN 11 AND 22 THEN ((h + abs(cell)) * 37 % 1000 + 1) * 3600 ELSE 0 END AS DOUBLE) AS ssrd,
  CAST((h + abs(cell)) % 11 AS DOUBLE) / {dbl(10.0)} AS tcc,
  CAST(CASE WHEN h % 24 BETWEEN 11 AND 22 THEN ((h + abs(cell)) * 37 % 1000 + 1) * 3600 ELSE 0 END AS DOUBLE)
    * CAST(h % 10 AS DOUBLE) / {dbl(10.0)} AS fdir,
  {ts(testdata.ERA5_STAMP)} AS _extracted_at
FROM era5_grid""")

cte("raw_era5_wind", ["era5_grid"], f"""
SELECT valid_time, latitude, longitude,
  CAST(h % 13 AS DOUBLE) - {dbl(6.0)} AS u100, CAST(h % 11 AS DOUBLE) - {dbl(5.0)} AS v100,
  CAST(h % 9 AS DOUBLE) - {dbl(4.0)} AS u10, CAST(h % 7 AS DOUBLE) - {dbl(3.0)} AS v10,
  {dbl(95000.0)} + CAST(h % 50 AS DOUBLE) * {dbl(10.0)} AS sp,
  {dbl(273.15)} + CAST(h % 24 AS DOUBLE) AS t2m,
  CAST(h % 17 AS DOUBLE) AS i10fg,
  {ts(testdata.ERA5_STAMP)} AS _extracted_at
FROM era5_grid""")

# ---- staging -----------------------------------------------------------------
_local_mid = f"timezone('UTC', timezone('{LOCAL_TZ}', CAST(CAST(fecha_hora AS DATE) AS TIMESTAMP)))"
cte("stg_generacion_real", ["raw_generacion"], f"""
SELECT id_central, tipo_tecnologia, generacion_real_mw, potencia_maxima_mw, timestamp_local,
       timestamp_utc, _extracted_at, {ts(RUN_TS)} AS _loaded_at
FROM (
  SELECT TRY_CAST(id_central AS BIGINT) AS id_central,
    CAST(tipo_tecnologia AS VARCHAR) AS tipo_tecnologia,
    {decimal_comma('gen_real_mw')} AS generacion_real_mw,
    {decimal_comma('potencia_maxima')} AS potencia_maxima_mw,
    fecha_hora AS timestamp_local,
    CAST({_local_mid} AS TIMESTAMP) + to_hours(TRY_CAST(hora AS BIGINT) - 1) AS timestamp_utc,
    _extracted_at, id_opreal
  FROM raw_generacion
  WHERE fecha_hora < {ts(RUN_TS)}
) t
QUALIFY row_number() OVER (PARTITION BY id_central, timestamp_utc
                           ORDER BY _extracted_at DESC NULLS LAST, id_opreal DESC NULLS LAST,
                                    tipo_tecnologia DESC NULLS LAST, generacion_real_mw DESC NULLS LAST,
                                    potencia_maxima_mw DESC NULLS LAST, timestamp_local DESC NULLS LAST) = 1""")

cte("stg_centrales_info", ["raw_centrales"], f"""
SELECT TRY_CAST(id_central AS BIGINT) AS id_central,
  {trimmed("regexp_replace(central, '\\[[^\\]]+\\]', '', 'g')")} AS nombre_central,
  coalesce(lower(nullif(regexp_extract(central, '\\[([^\\]]+)\\]', 1), '')), 'normal') AS state_central,
  region, comuna, provincia, tipo_tecnologia,
  {decimal_comma('coordenada_este')} AS coordenada_este_utm,
  {decimal_comma('coordenada_norte')} AS coordenada_norte_utm,
  TRY_CAST(regexp_extract(zona_huso, '^(\\d+)', 1) AS BIGINT) AS zona_huso,
  _extracted_at, {ts(RUN_TS)} AS _loaded_at
FROM raw_centrales""")

cte("stg_solar_passed", ["raw_era5_solar"], f"""
SELECT valid_time, latitude, longitude, t2m, ssrd, tcc, fdir, _extracted_at, {ts(RUN_TS)} AS _loaded_at
FROM raw_era5_solar""")

# ---- intermediate ------------------------------------------------------------
_xi_p = "__xi" + "".join(
    f" - {dbl(b)} * sin({dbl(2.0 * j)} * __xi) * cosh({dbl(2.0 * j)} * __eta)" for j, b in enumerate(BETA, 1))
_eta_p = "__eta" + "".join(
    f" - {dbl(b)} * cos({dbl(2.0 * j)} * __xi) * sinh({dbl(2.0 * j)} * __eta)" for j, b in enumerate(BETA, 1))
_phi = "__chi" + "".join(f" + {dbl(d)} * sin({dbl(2.0 * j)} * __chi)" for j, d in enumerate(DELTA, 1))
_PI = dbl(math.pi)
cte("utm_steps", ["stg_centrales_info"], f"""
SELECT *,
  ({_phi}) * {dbl(180.0)} / {_PI} AS __lat,
  ((CAST(zona_huso AS DOUBLE) * {dbl(6.0)} - {dbl(183.0)}) * {_PI} / {dbl(180.0)}
     + atan2(sinh(__eta_p), cos(__xi_p))) * {dbl(180.0)} / {_PI} AS __lon
FROM (SELECT *, asin(sin(__xi_p) / cosh(__eta_p)) AS __chi
      FROM (SELECT *, {_xi_p} AS __xi_p, {_eta_p} AS __eta_p
            FROM (SELECT *, (coordenada_norte_utm - {dbl(FALSE_NORTHING)}) / {dbl(SCALED_RADIUS)} AS __xi,
                            (coordenada_este_utm - {dbl(FALSE_EASTING)}) / {dbl(SCALED_RADIUS)} AS __eta
                  FROM stg_centrales_info
                  WHERE coordenada_este_utm IS NOT NULL AND coordenada_norte_utm IS NOT NULL
                    AND zona_huso IS NOT NULL) a) b) c""")

_lat = rnd("__lat", 9)
_lon = rnd("__lon", 9)
cte("int_centrales_geo", ["utm_steps"], f"""
SELECT id_central, nombre_central, state_central, region, comuna, provincia, tipo_tecnologia,
  coordenada_este_utm, coordenada_norte_utm, zona_huso,
  {_lat} AS latitude, {_lon} AS longitude,
  'POINT(' || CAST({_lon} AS VARCHAR) || ' ' || CAST({_lat} AS VARCHAR) || ')' AS geo_point,
  _extracted_at, _loaded_at
FROM utm_steps
QUALIFY row_number() OVER (PARTITION BY id_central ORDER BY _extracted_at DESC NULLS LAST) = 1""")

_rad = f"({_PI} / {dbl(180.0)})"
_sdp = f"sin(((lat_era5 - latitude) * {_rad}) / {dbl(2.0)})"
_sdl = f"sin(((lon_era5 - longitude) * {_rad}) / {dbl(2.0)})"
_hav = (f"{dbl(2.0 * EARTH_RADIUS)} * asin(sqrt({_sdp} * {_sdp} + "
        f"cos(latitude * {_rad}) * cos(lat_era5 * {_rad}) * {_sdl} * {_sdl}))")
_cat = ("CASE WHEN __d < 1000 THEN 'Perfecta' WHEN __d < 5000 THEN 'Excelente' WHEN __d < 10000 THEN 'Buena' "
        "WHEN __d < 15000 THEN 'Regular' ELSE 'Mala' END")
cte("int_compatibilidad_era5", ["int_centrales_geo"], f"""
SELECT id_central, nombre_central, tipo_tecnologia, clasificacion_fuente, region,
  latitude AS lat_real, longitude AS lon_real, lat_era5, lon_era5,
  {rnd('abs(latitude - lat_era5)', 4)} AS diferencia_lat_grados,
  {rnd('abs(longitude - lon_era5)', 4)} AS diferencia_lon_grados,
  {rnd('__d', 2)} AS distancia_era5_metros,
  {_cat} AS categoria_precision
FROM (SELECT *, {_hav} AS __d
      FROM (SELECT id_central, nombre_central, tipo_tecnologia,
                   {classify('tipo_tecnologia')} AS clasificacion_fuente, region, latitude, longitude,
                   round(latitude * {dbl(4.0)}) / {dbl(4.0)} AS lat_era5,
                   round(longitude * {dbl(4.0)}) / {dbl(4.0)} AS lon_era5
            FROM int_centrales_geo
            WHERE state_central = 'normal' AND latitude IS NOT NULL AND longitude IS NOT NULL) s) d""")


def _cyc(fn: str, part: str, period: float) -> str:
    return rnd(f"{fn}({dbl(2.0 * math.pi)} * CAST({part}(valid_time) AS DOUBLE) / {dbl(period)})", 6)


cte("int_era5_solar_features", ["stg_solar_passed"], f"""
SELECT valid_time AS timestamp_utc, latitude AS lat_era5, longitude AS lon_era5,
  {rnd(f't2m - {dbl(273.15)}', 2)} AS temperatura_celsius,
  {rnd(f'ssrd / {dbl(3600.0)}', 2)} AS ghi_wm2,
  {rnd(f'fdir / {dbl(3600.0)}', 2)} AS dni_wm2,
  {rnd(f'tcc * {dbl(100.0)}', 1)} AS nubosidad_pct,
  {rnd(sdiv('fdir', 'NULLIF(ssrd, 0)'), 4)} AS fraccion_directa,
  {_cyc('cos', 'hour', 24.0)} AS hora_cos, {_cyc('sin', 'hour', 24.0)} AS hora_sin,
  {_cyc('cos', 'month', 12.0)} AS mes_cos, {_cyc('sin', 'month', 12.0)} AS mes_sin,
  CAST(hour(valid_time) AS BIGINT) AS hora_utc, CAST(month(valid_time) AS BIGINT) AS mes
FROM stg_solar_passed""")

_hourly = ["id_central", "nombre_central", "g.tipo_tecnologia",
           f"{classify('p.tipo_tecnologia')} AS clasificacion_fuente", "state_central", "region", "comuna",
           "provincia", "latitude", "longitude", "geo_point", "generacion_real_mw", "potencia_maxima_mw",
           rnd(sdiv("generacion_real_mw", "potencia_maxima_mw"), 6) + " AS factor_planta", "timestamp_local",
           "timestamp_utc", "CAST(timestamp_local AS DATE) AS fecha"]
_hourly += [f"CAST(date_part('{part}', timestamp_local) AS BIGINT){more} AS {name}" for name, part, more in (
    ("hora", "hour", ""), ("dia_semana", "dow", " + 1"), ("mes", "month", ""), ("anio", "year", ""))]
cte("int_generacion_enriched", ["stg_generacion_real", "int_centrales_geo"],
    f"SELECT {', '.join(_hourly)}, g._extracted_at, g._loaded_at "
    "FROM int_centrales_geo p JOIN stg_generacion_real g USING (id_central)")

cte("int_solar_target", ["int_generacion_enriched", "int_compatibilidad_era5"], """
SELECT id_central, timestamp_utc, fecha, lat_era5, lon_era5, generacion_real_mw, potencia_maxima_mw, factor_planta
FROM int_compatibilidad_era5 JOIN (FROM int_generacion_enriched SELECT id_central, timestamp_utc, fecha,
  generacion_real_mw, potencia_maxima_mw, factor_planta WHERE tipo_tecnologia = 'Solar') USING (id_central)""")

cte("src_normal", ["int_generacion_enriched"],
    "SELECT * FROM int_generacion_enriched WHERE state_central = 'normal'")

# ---- marts -------------------------------------------------------------------
cte("fct_generacion_hora", ["src_normal"], """
SELECT id_central, nombre_central, tipo_tecnologia, region, comuna, provincia, geo_point,
       generacion_real_mw, potencia_maxima_mw, factor_planta, timestamp_local, timestamp_utc,
       fecha, hora, mes, anio
FROM src_normal""")

# One row per plant, day, technology and class: every daily figure is a roll-up of these.
cte("plant_day", ["src_normal"], """
SELECT fecha, tipo_tecnologia, clasificacion_fuente, id_central, sum(generacion_real_mw) AS mwh,
  count(generacion_real_mw) AS readings, max(generacion_real_mw) AS top_mw, min(generacion_real_mw) AS low_mw,
  max(potencia_maxima_mw) AS rated_mw, count(*) FILTER (generacion_real_mw > 0) AS running, count(*) AS hours
FROM src_normal GROUP BY ALL""")

cte("mart_generacion_diaria", ["plant_day"], f"""
WITH rated AS (
  SELECT DISTINCT fecha, tipo_tecnologia, sum(biggest) OVER (PARTITION BY fecha, tipo_tecnologia) AS rating
  FROM (SELECT fecha, tipo_tecnologia, id_central, max(rated_mw) AS biggest FROM plant_day
        WHERE tipo_tecnologia IS NOT NULL GROUP BY ALL)),
rolled AS (
  SELECT fecha, tipo_tecnologia, clasificacion_fuente, sum(mwh) AS mwh, sum(readings) AS readings,
    max(top_mw) AS top_mw, sum(running) AS running, count(DISTINCT id_central) FILTER (running > 0) AS active
  FROM plant_day GROUP BY ALL)
SELECT fecha, tipo_tecnologia, clasificacion_fuente, mwh AS generacion_total_mwh,
  {rnd('mwh / readings', 2)} AS generacion_promedio_mw, top_mw AS generacion_maxima_mw,
  CAST(running AS BIGINT) AS horas_con_generacion, active AS num_centrales_activas,
  rating AS capacidad_instalada_mw, {rnd(sdiv('mwh', f'rating * {dbl(24.0)}'), 4)} AS factor_planta
FROM rolled JOIN rated USING (fecha, tipo_tecnologia)""")

cte("mart_generacion_por_central", ["src_normal"], f"""
SELECT DISTINCT fecha, id_central, min(nombre_central) OVER w AS nombre_central,
  min(tipo_tecnologia) OVER w AS tipo_tecnologia, min(clasificacion_fuente) OVER w AS clasificacion_fuente,
  min(region) OVER w AS region, min(comuna) OVER w AS comuna, min(latitude) OVER w AS latitude,
  min(longitude) OVER w AS longitude, sum(generacion_real_mw) OVER w AS generacion_total_mwh,
  {rnd('sum(generacion_real_mw) OVER w / count(generacion_real_mw) OVER w', 2)} AS generacion_promedio_mw,
  max(generacion_real_mw) OVER w AS generacion_maxima_mw, min(generacion_real_mw) OVER w AS generacion_minima_mw,
  max(potencia_maxima_mw) OVER w AS potencia_maxima_mw,
  {rnd(sdiv('sum(generacion_real_mw) OVER w', f'max(potencia_maxima_mw) OVER w * {dbl(24.0)}'), 4)} AS factor_planta,
  CAST(sum(CAST(coalesce(generacion_real_mw, 0) > 0 AS INTEGER)) OVER w AS BIGINT) AS horas_operacion,
  count(*) OVER w AS horas_con_datos
FROM src_normal WINDOW w AS (PARTITION BY fecha, id_central)""")

cte("mart_eficiencia_central", ["plant_day", "int_centrales_geo"], f"""
WITH days AS (
  SELECT id_central, fecha, sum(mwh) AS mwh, max(rated_mw) AS rated, sum(running) AS running, sum(hours) AS hours
  FROM plant_day GROUP BY ALL),
lives AS (
  SELECT id_central, list(struct_pack(mwh := mwh, use := {sdiv('mwh', f'rated * {dbl(24.0)}')})) AS d,
    count(*) AS days, max(rated) AS rated, sum(running) AS running, sum(hours) AS hours
  FROM days GROUP BY id_central)
SELECT p.id_central, nombre_central, tipo_tecnologia, {classify('tipo_tecnologia')} AS clasificacion_fuente,
  region, comuna, latitude, longitude, geo_point, days AS dias_con_datos,
  list_sum(list_transform(d, lambda x: x.mwh)) AS generacion_total_mwh,
  {rnd('list_avg(list_transform(d, lambda x: x.mwh))', 2)} AS generacion_promedio_diaria_mwh,
  rated AS potencia_maxima_mw, {rnd('list_avg(list_transform(d, lambda x: x.use))', 4)} AS factor_planta_promedio,
  {rnd('list_max(list_transform(d, lambda x: x.use))', 4)} AS factor_planta_mejor_dia,
  CAST(running AS BIGINT) AS horas_operacion_totales, CAST(hours AS BIGINT) AS horas_con_datos_totales,
  {rnd(sdiv('running', 'hours'), 4)} AS tasa_disponibilidad
FROM int_centrales_geo p JOIN lives USING (id_central) WHERE state_central = 'normal'""")

cte("day_technology", ["plant_day"],
    "SELECT fecha, tipo_tecnologia, sum(mwh) AS mwh FROM plant_day GROUP BY ALL")

cte("day_leader", ["day_technology"], """
SELECT fecha, list(tipo_tecnologia ORDER BY mwh DESC NULLS LAST, tipo_tecnologia NULLS FIRST)[1] AS leader,
  list(mwh ORDER BY mwh DESC NULLS LAST, tipo_tecnologia NULLS FIRST)[1] AS leader_mwh
FROM day_technology GROUP BY fecha""")

cte("day_extremes", ["src_normal"], """
SELECT DISTINCT fecha, first_value(mw) OVER (PARTITION BY fecha ORDER BY mw DESC) AS demanda_maxima_mw,
       first_value(mw) OVER (PARTITION BY fecha ORDER BY mw) AS demanda_minima_mw
FROM (SELECT fecha, hora, sum(generacion_real_mw) AS mw FROM src_normal GROUP BY ALL HAVING mw IS NOT NULL)""")

cte("day_plants", ["plant_day"], """
SELECT fecha, id_central, max(rated_mw) AS rated, bool_or(running > 0) AS runs,
       bool_or(running > 0 AND clasificacion_fuente = 'Renovable') AS runs_green
FROM plant_day GROUP BY ALL""")

cte("day_shares", ["plant_day"], f"""
SELECT fecha, sum(mwh) AS total, coalesce(sum(mwh) FILTER (clasificacion_fuente = 'Renovable'), 0.0) AS green,
       coalesce(sum(mwh) FILTER (clasificacion_fuente = 'Convencional'), 0.0) AS other
FROM plant_day GROUP BY fecha""")

cte("mart_resumen_sistema", ["day_shares", "day_plants", "day_extremes", "day_leader"], f"""
SELECT fecha, total AS generacion_total_mwh, green AS generacion_renovable_mwh, other AS generacion_convencional_mwh,
  {rnd(sdiv('green', 'total') + f' * {dbl(100.0)}', 2)} AS pct_renovable,
  {rnd(sdiv('other', 'total') + f' * {dbl(100.0)}', 2)} AS pct_convencional,
  demanda_maxima_mw, demanda_minima_mw, count(*) FILTER (runs) AS num_centrales_activas,
  count(*) FILTER (runs_green) AS num_centrales_renovables_activas, sum(rated) AS capacidad_instalada_total_mw,
  {rnd(sdiv('total', f'sum(rated) * {dbl(24.0)}'), 4)} AS factor_planta_sistema, leader AS top_tecnologia
FROM day_plants JOIN day_shares USING (fecha) JOIN day_extremes USING (fecha) JOIN day_leader USING (fecha)
GROUP BY fecha, total, green, other, demanda_maxima_mw, demanda_minima_mw, leader""")

cte("mart_training_solar", ["int_solar_target", "int_era5_solar_features"], """
SELECT id_central, timestamp_utc, fecha, lat_era5, lon_era5, factor_planta, temperatura_celsius, ghi_wm2,
  dni_wm2, nubosidad_pct, fraccion_directa, hora_cos, hora_sin, mes_cos, mes_sin
FROM int_era5_solar_features JOIN int_solar_target USING (lat_era5, lon_era5, timestamp_utc)""")

cte("time_spine_daily", [], """
SELECT CAST(d AS DATE) AS date_day
FROM (SELECT unnest(generate_series(DATE '2019-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d) s""")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)
    for n in names:
        visit(n)
    return seen


def sql(final: str, deps: list[str]) -> str:
    """WITH <all needed CTEs> <final>."""
    names = _order(deps)
    if not names:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in names)
    return f"WITH {body}\n{final}"


def model(name: str) -> str:
    return sql(f"SELECT * FROM {name}", [name])
