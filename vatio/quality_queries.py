"""Data-quality (dq_*) and metric (metric_*) queries with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle as O
from .operators.metrics import AVERAGE_DIGITS, METRICS, on_spine, query_metrics
from .operators.quality import run_checks
from .plans.pipeline import Models
from .plans.tests_declared import CHECKS, KIND_GROUPS
from .registry import MODEL_QUERIES, register
from .session import path_exists, scratch_path, session_key
from .sources import testdata

CTE_OF = {name: cte for name, (_, cte) in MODEL_QUERIES.items()}

SHARED_LAYER = ["stg_generation", "stg_plants", "plants_geo", "era5_cells", "era5_features",
                "generation_enriched", "solar_target"]


def _tables(m: Models, names) -> dict:
    return {n: getattr(m, n) for n in names}


def _lit(v) -> str:
    return O.q(v) if isinstance(v, str) else repr(v)


def _check_sql(c) -> str:
    t = CTE_OF[c.model]
    head = f"SELECT CAST({c.id} AS BIGINT) AS test_id, CAST("
    if c.kind == "not_null":
        f = f"(SELECT count(*) FROM {t} WHERE {c.column} IS NULL)"
    elif c.kind == "unique":
        f = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL "
             f"GROUP BY {c.column} HAVING count(*) > 1) x)")
    elif c.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in c.args["values"])
        f = (f"(SELECT count(*) FROM (SELECT {c.column} AS v FROM {t} GROUP BY {c.column}) x "
             f"WHERE v NOT IN ({vals}))")
    elif c.kind == "relationships":
        p = CTE_OF[c.args["to"]]
        f = (f"(SELECT count(*) FROM {t} ch WHERE ch.{c.column} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {p} pa WHERE pa.{c.args['field']} = ch.{c.column}))")
    elif c.kind == "unique_combination":
        cols = ", ".join(c.args["columns"])
        f = f"(SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1) x)"
    elif c.kind == "accepted_range":
        f = (f"(SELECT count(*) FROM {t} WHERE NOT ({c.column} >= {c.args['min']} "
             f"AND {c.column} <= {c.args['max']}))")
    elif c.kind == "bbox":
        a = c.args
        f = (f"(SELECT count(*) FROM {t} WHERE {a['lat']} IS NOT NULL AND {a['lon']} IS NOT NULL AND "
             f"({a['lat']} > {a['lat_max']} OR {a['lat']} < {a['lat_min']} OR "
             f"{a['lon']} > {a['lon_max']} OR {a['lon']} < {a['lon_min']}))")
    else:
        raise ValueError(c.kind)
    err = "FALSE"
    if c.error_if:
        err = f"failures {c.error_if[0:2] if c.error_if[1] == '=' else c.error_if[0]} {c.error_if.lstrip('<>=!')}"
    status = (f"CASE WHEN failures = 0 THEN 'pass' WHEN {err} THEN 'fail' "
              f"WHEN {O.q(c.severity)} = 'warn' THEN 'warn' ELSE 'fail' END")
    col = "NULL" if c.column is None else O.q(c.column)
    return (f"SELECT test_id, model, test, column_name, failures, {status} AS status FROM ("
            f"{head}{f} AS BIGINT) AS failures, {O.q(c.model)} AS model, {O.q(c.kind)} AS test, "
            f"CAST({col} AS VARCHAR) AS column_name) r")


def dq_sql(checks) -> str:
    deps = sorted({CTE_OF[c.model] for c in checks} |
                  {CTE_OF[c.args["to"]] for c in checks if c.kind == "relationships"})
    return O.sql("\nUNION ALL\n".join(_check_sql(c) for c in checks), deps)


_RUNS: dict[tuple, tuple[str, tuple, Models]] = {}
#: Driver tables that the models are made of.
INPUTS = ("nation", "region", "supplier", "lineitem")


def input_identity(spark, sf: str) -> tuple:
    """Path, size and time of every input file: another file, another run."""
    files = []
    for table in INPUTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{table}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.listFiles(path, True)
        while found.hasNext():
            f = found.next()
            files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(files))


def shared_run(spark, sf) -> Models:
    """The intermediate models of a folder, written once per application and
    shared by all checks; written again if an input file changed or the tables
    are gone."""
    key = (session_key(spark), sf.rstrip("/"))
    identity = input_identity(spark, sf)
    root, known, m = _RUNS.get(key, ("", None, None))
    if key[0] is None or known != identity or not path_exists(spark, f"{root}/{SHARED_LAYER[-1]}"):
        testdata.forget(spark, sf)
        root = scratch_path(spark, "models")
        m = Models.from_testdata(spark, sf).materialize(root, SHARED_LAYER)
        _RUNS[key] = (root, identity, m)
    return m


def _dq_builder(checks):
    models = sorted({c.model for c in checks} | {c.args["to"] for c in checks if c.kind == "relationships"})

    def build(spark, sf):
        # Checks run over written intermediate tables (shared by several models),
        # so no check branch recomputes staging, deduplication or the joins.
        m = shared_run(spark, sf)
        return run_checks(_tables(m, models), checks)
    return build


for _qname, _kinds in KIND_GROUPS.items():
    _cs = [c for c in CHECKS if c.kind in _kinds]
    register(_qname, dq_sql(_cs))(_dq_builder(_cs))
register("dq_summary", dq_sql(CHECKS))(_dq_builder(CHECKS))


# ---- metrics -------------------------------------------------------------------
def _metric_agg_sql(m) -> str:
    x = m.expr
    return {"sum": f"sum({x})", "max": f"max({x})", "min": f"min({x})", "count": f"count({x})",
            "average": O.rnd(f"avg({x})", AVERAGE_DIGITS)}[m.agg]


def _time_sql(col: str, grain: str) -> str:
    if grain == "hour":
        return f"date_trunc('hour', {col})"
    if grain == "day":
        return f"CAST({col} AS DATE)"
    return f"CAST(date_trunc('{grain}', {col}) AS DATE)"


def _metric_builder(names, group_by=(), grain=None):
    def build(spark, sf):
        m = Models.from_testdata(spark, sf)
        models = {METRICS[n].model for n in names}
        return query_metrics(_tables(m, models), names, group_by, grain)
    return build


def _metric_sql(names, group_by=(), grain=None) -> str:
    ms = [METRICS[n] for n in names]
    assert len({m.model for m in ms}) == 1
    t = CTE_OF[ms[0].model]
    keys = ([f"{_time_sql(ms[0].time_dimension, grain)} AS metric_time"] if grain else []) + list(group_by)
    gkeys = (["metric_time"] if grain else []) + list(group_by)
    aggs = ", ".join(f"{_metric_agg_sql(m)} AS {m.name}" for m in ms)
    sel = ", ".join(keys + [aggs])
    gb = f" GROUP BY {', '.join(gkeys)}" if gkeys else ""
    return O.sql(f"SELECT {sel} FROM {t}{gb}", [t])


for _n in METRICS:
    register(f"metric_{_n}", _metric_sql([_n], grain="day"))(_metric_builder([_n], grain="day"))

_DIM = ["generacion"]
register("metric_by_dimension", _metric_sql(_DIM, ["tipo_tecnologia", "region"]))(
    _metric_builder(_DIM, ["tipo_tecnologia", "region"]))

@register("metric_by_entity", O.sql("""
SELECT p.tipo_tecnologia AS central__tipo_tecnologia, p.region AS central__region,
       sum(f.generacion_real_mw) AS generacion
FROM fct_generacion_hora f LEFT JOIN int_centrales_geo p ON f.id_central = p.id_central
GROUP BY 1, 2""", ["fct_generacion_hora", "int_centrales_geo"]))
def metric_by_entity(spark, sf):
    """Hourly generation grouped by attributes of the plant entity (the
    registry's technology, not the generation row's)."""
    m = Models.from_testdata(spark, sf)
    return query_metrics({"fact_hourly": m.fact_hourly, "plants_geo": m.plants_geo}, ["generacion"],
                         ["central__tipo_tecnologia", "central__region"])


_MONTHLY = ["generacion_sistema_total", "generacion_renovable_total", "generacion_convencional_total",
            "pct_renovable_promedio"]
register("metric_by_month", _metric_sql(_MONTHLY, grain="month"))(_metric_builder(_MONTHLY, grain="month"))


# Every other grain: hours of the hourly fact, weeks, quarters and years of the daily models.
register("metric_by_hour", _metric_sql(_DIM, grain="hour"))(_metric_builder(_DIM, grain="hour"))
register("metric_by_week", _metric_sql(_MONTHLY, grain="week"))(_metric_builder(_MONTHLY, grain="week"))
register("metric_by_quarter", _metric_sql(["generacion_diaria_total", "maxima_generacion_diaria_mw"],
                                          ["tipo_tecnologia"], "quarter"))(
    _metric_builder(["generacion_diaria_total", "maxima_generacion_diaria_mw"], ["tipo_tecnologia"], "quarter"))
register("metric_by_year", _metric_sql(_MONTHLY, grain="year"))(_metric_builder(_MONTHLY, grain="year"))


@register("metric_on_spine", O.sql("""
SELECT s.metric_time, m.generacion_sistema_total
FROM (SELECT CAST(unnest(generate_series(min(fecha), max(fecha), INTERVAL 1 DAY)) AS DATE) AS metric_time
      FROM mart_resumen_sistema) s
LEFT JOIN (SELECT CAST(fecha AS DATE) AS metric_time, sum(generacion_total_mwh) AS generacion_sistema_total
           FROM mart_resumen_sistema GROUP BY 1) m ON s.metric_time = m.metric_time""", ["mart_resumen_sistema"]))
def metric_on_spine(spark, sf):
    """Daily system energy on the calendar between the first and last day with
    data; days without data show NULL."""
    m = Models.from_testdata(spark, sf)
    daily = query_metrics({"system_summary": m.system_summary}, ["generacion_sistema_total"], grain="day")
    bounds = m.system_summary.agg(F.min("fecha").alias("a"), F.max("fecha").alias("b"))
    spine = bounds.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    return on_spine(daily, spine)
