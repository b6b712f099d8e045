"""The model graph wired together (dependency order of the reference DAG).

``Models`` builds each model lazily, once, from the four raw tables, at the
current instant unless a run clock is given. The registered queries run at
``RUN_TS`` so that re-runs agree.

``materialize`` writes models once per run and continues from the written
tables (six marts read the hourly enriched table), which also cuts lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.testdata import RawTables, raw_tables
from . import intermediate, marts, staging

RUN_TS = "2026-06-01 00:00:00"


class Models:
    def __init__(self, spark: SparkSession, raw: RawTables, as_of=None, loaded_at=None):
        self.spark, self.raw, self.as_of, self.loaded_at = spark, raw, as_of, loaded_at

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, as_of=RUN_TS, loaded_at=RUN_TS) -> Models:
        return cls(spark, raw_tables(spark, sf_dir), as_of, loaded_at)

    # staging
    @cached_property
    def stg_generation(self) -> DataFrame:
        return staging.stg_generation(self.raw.generacion_real, self.as_of, self.loaded_at)

    @cached_property
    def stg_plants(self) -> DataFrame:
        return staging.stg_plants(self.raw.centrales_info, self.loaded_at)

    @cached_property
    def stg_era5_solar(self) -> DataFrame:
        return staging.stg_era5_solar(self.raw.era5_solar, self.loaded_at)

    # intermediate
    @cached_property
    def plants_geo(self) -> DataFrame:
        return intermediate.plants_geo(self.stg_plants)

    @cached_property
    def plants_small(self) -> bool:
        """Size check of the plant dimension, done once: every plant-derived
        dimension (cells, plant info) has at most one row per plant, so the
        same bound covers them."""
        from ..operators.joins import fits_broadcast  # noqa: PLC0415
        return fits_broadcast(self.plants_geo)

    @cached_property
    def era5_cells(self) -> DataFrame:
        return intermediate.era5_cells(self.plants_geo)

    @cached_property
    def era5_features(self) -> DataFrame:
        return intermediate.era5_features(self.stg_era5_solar)

    @cached_property
    def generation_enriched(self) -> DataFrame:
        return intermediate.generation_enriched(self.stg_generation, self.plants_geo, self.plants_small)

    @cached_property
    def solar_target(self) -> DataFrame:
        return intermediate.solar_target(self.generation_enriched, self.era5_cells,
                                         cells_small=self.plants_small)

    # marts
    @cached_property
    def fact_hourly(self) -> DataFrame:
        return marts.fact_hourly(self.generation_enriched)

    @cached_property
    def daily_by_technology(self) -> DataFrame:
        return marts.daily_by_technology(self.generation_enriched)

    @cached_property
    def plant_days(self) -> DataFrame:
        return marts.plant_days(self.generation_enriched)

    @cached_property
    def daily_by_plant(self) -> DataFrame:
        return marts.daily_by_plant(self.plant_days, self.plants_geo, self.plants_small)

    @cached_property
    def plant_efficiency(self) -> DataFrame:
        return marts.plant_efficiency(self.plant_days, self.plants_geo, self.plants_small)

    @cached_property
    def system_summary(self) -> DataFrame:
        return marts.system_summary(self.generation_enriched)

    @cached_property
    def training_solar(self) -> DataFrame:
        return marts.training_solar(self.solar_target, self.era5_features)

    @cached_property
    def time_spine(self) -> DataFrame:
        return marts.time_spine(self.spark)

    def materialize(self, root: str, names=None, threads: int = 4, checks=()) -> Models:
        """Write models as Parquet tables under ``root`` and continue from the
        written tables: each model is computed once, later models and checks
        read it back, and the lineage is cut at each table. Models whose
        inputs are ready are written concurrently (``threads`` jobs at a time;
        Spark interleaves their tasks). Hourly and daily models are partitioned
        by day; the sides of the training join are also bucketed by its key.

        Without a window every table is replaced whole. With ``raw.window`` the
        days of the run replace theirs and the others stay; models over the
        whole history (LIFETIME) are computed from the stored daily partials,
        so all tables of the folder speak of the same days.

        Row-level ``checks`` of a model are counted by the tasks that write it;
        ``observed`` holds their failures by test id. A table of which a window
        replaces some days is not counted (the test speaks of the whole table).
        """
        from concurrent.futures import ThreadPoolExecutor  # noqa: PLC0415

        from ..operators.quality import RowChecks  # noqa: PLC0415
        from ..sources.catalog import bucketed_table, write_bucketed, write_table  # noqa: PLC0415
        window = getattr(self.raw, "window", None)
        wanted = [n for n in MODEL_ORDER if names is None or n in names]
        for n in wanted:
            self.__dict__.pop(n, None)
        self.__dict__.pop("plants_small", None)
        base = root.rstrip("/")
        self.observed: dict[int, int] = {}
        self.tables: dict[str, str] = {}

        def build(n: str) -> DataFrame:
            path, df = f"{base}/{n}", getattr(self, n)
            part, cluster = layout_of(n)
            rows = RowChecks([c for c in checks if c.model == n] if not (window and part) else [])
            if n in DAY_OF:
                df = df.withColumn(DAY, F.to_date(F.col(DAY_OF[n])))
            if n in BUCKETED:
                write_bucketed(marts.with_cell_keys(df), path, BUCKETED[n], part[0], replace_days_only=bool(window),
                               watch=rows.watch)
                out = bucketed_table(self.spark, path)
            else:
                write_table(df, path, partition_by=part, cluster_by=cluster, replace_days_only=bool(window),
                            watch=rows.watch, dealt=n in dealt)
                out = self.spark.read.parquet(path)
            self.observed |= rows.failures()
            self.tables[n] = path
            return out

        full: dict[str, DataFrame] = {}
        keyed: dict[str, DataFrame] = {}
        dealt: set[str] = set()

        def deal(n: str) -> None:
            """A model that takes its rows one by one from another of the same days is written
            where they lie: read from its day folders, or dealt out by day before the plant's
            attributes are joined on. The rows are sorted by day while they are narrow, so that
            the write needs no sort of the joined ones, which outgrows a task's memory."""
            source = SAME_DAY.get(n)
            if source in self.tables or (source == "stg_generation" and self.plants_small):
                if n == "generation_enriched" and not self.plants_small:
                    return      # a shuffled join
                if "stg_generation" in self.tables and self.plants_small:
                    enriched = intermediate.generation_enriched(_sorted_by_day(self.stg_generation), self.plants_geo, True)
                    self.__dict__[n] = enriched if n == "generation_enriched" else marts.fact_hourly(enriched)
                elif source not in self.tables:
                    rows = self.stg_generation.withColumn(DAY, F.to_date(F.col(DAY_OF[source]))).hint("rebalance", DAY)
                    self.__dict__[n] = intermediate.generation_enriched(_sorted_by_day(rows), self.plants_geo, True)
                dealt.add(n)

        def of_run(n: str, t: DataFrame) -> DataFrame:
            """What later models of the run read: its own days."""
            full[n] = t.drop(DAY, *marts.CELL_KEYS)
            if n in BUCKETED:
                keyed[n] = t.drop(DAY)
            part, _ = layout_of(n)
            if window is None or not part:
                return t.drop(DAY)
            first, end = (F.lit(x).cast("timestamp_ntz").cast("date") for x in window)
            pad = 1 if n in ERA5_MODELS else 0
            return t.filter((F.col(part[0]) >= F.date_sub(first, pad)) & (F.col(part[0]) < F.date_add(end, pad))).drop(DAY)

        pending = list(wanted)
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            while pending:
                wave = [n for n in pending if not (MODEL_DEPS[n] & set(pending))]
                for n in wave:      # build plans in this thread; only the writes run in the pool
                    if n in LIFETIME and window is not None and "plant_days" in full:
                        self.__dict__[n] = marts.plant_efficiency(full["plant_days"], self.plants_geo, self.plants_small)
                    deal(n)
                    getattr(self, n)
                tables = list(pool.map(build, wave))
                for n, t in zip(wave, tables):
                    self.__dict__[n] = of_run(n, t)
                pending = [n for n in pending if n not in wave]
                self.__dict__.pop("plants_small", None)
        if "training_solar" not in wanted and set(BUCKETED) <= set(keyed):
            # Joined bucket by bucket after the run as well, where it is asked for.
            self.__dict__["training_solar"] = marts.training_solar(keyed["solar_target"], keyed["era5_features"])
        self.__dict__.update(full)
        return self


def _sorted_by_day(rows: DataFrame) -> DataFrame:
    """Rows of stg_generation, sorted by day within their tasks. The optimizer drops a sort
    below the one of the write, but not across observed rows; it then finds the write's to be
    done already, as a broadcast join keeps the order."""
    by_day = rows.sortWithinPartitions(F.to_date(F.col(DAY_OF["stg_generation"])))
    return by_day.observe("rows_by_day", F.count(F.lit(1)).alias("n"))


#: Partition column of the hourly tables, and the column that it is the day of.
DAY = "fecha_part"
DAY_OF = {"stg_generation": "timestamp_local", "stg_era5_solar": "valid_time", "era5_features": "timestamp_utc",
          "generation_enriched": "fecha", "solar_target": "fecha", "fact_hourly": "fecha", "training_solar": "fecha"}
#: Hourly models whose rows are rows of another hourly model, of the same day.
SAME_DAY = {"generation_enriched": "stg_generation", "fact_hourly": "generation_enriched"}
ERA5_MODELS = ("stg_era5_solar", "era5_features")
LIFETIME = ("plant_efficiency",)
MODEL_ORDER = ["stg_generation", "stg_plants", "stg_era5_solar", "plants_geo", "era5_cells",
               "era5_features", "generation_enriched", "plant_days", "solar_target", "fact_hourly",
               "daily_by_technology", "daily_by_plant", "plant_efficiency", "system_summary",
               "training_solar"]

_UP = {"stg_generation": [], "stg_plants": [], "stg_era5_solar": [], "plants_geo": ["stg_plants"],
       "era5_cells": ["plants_geo"], "era5_features": ["stg_era5_solar"],
       "generation_enriched": ["stg_generation", "plants_geo"],
       "solar_target": ["generation_enriched", "era5_cells"], "fact_hourly": ["generation_enriched"],
       "plant_days": ["generation_enriched"], "daily_by_technology": ["generation_enriched"],
       "daily_by_plant": ["plant_days", "plants_geo"], "plant_efficiency": ["plant_days", "plants_geo"],
       "system_summary": ["generation_enriched"],
       "training_solar": ["solar_target", "era5_features"]}


def _closure(n: str) -> set[str]:
    out: set[str] = set()
    for u in _UP[n]:
        out |= {u} | _closure(u)
    return out


# Model -> every model it reads, directly or not.
MODEL_DEPS = {n: _closure(n) for n in _UP}

# Partitioned + clustered marts (day partitions; the files of a day hold ranges of the clustering columns).
MART_LAYOUT = {
    "plant_days": (["fecha"], ["id_central"]),
    "daily_by_technology": (["fecha"], ["tipo_tecnologia", "clasificacion_fuente"]),
    "daily_by_plant": (["fecha"], ["id_central", "region"]),
    "system_summary": (["fecha"], []),
}

#: Both sides of the training join: number of buckets. At 100 TB some thousands; a
#: bucket of a day should hold a few files' worth of rows at most.
BUCKETS = 16
BUCKETED = {n: (BUCKETS, marts.TRAINING_KEYS) for n in ("era5_features", "solar_target")}


def layout_of(n: str) -> tuple[list[str], list[str]]:
    """(partition columns, clustering columns) of a model's table."""
    return MART_LAYOUT.get(n, ([DAY] if n in DAY_OF else [], []))


def run_pipeline(spark: SparkSession, raw: RawTables, root: str, run_ts=None, schema: str | None = None) -> DataFrame:
    """A full run: every model written once under ``root`` in dependency
    order (see ``materialize``), then the declared data tests, saved as
    ``root/dq_results``. Row-level tests are counted while a model is written,
    the others over the written tables. With ``schema`` the written files are
    registered as tables of that schema. Returns the test results."""
    from ..operators.quality import run_checks  # noqa: PLC0415
    from .tests_declared import CHECKS  # noqa: PLC0415
    m = Models(spark, raw, as_of=run_ts, loaded_at=run_ts).materialize(root, checks=CHECKS)
    results = run_checks({n: getattr(m, n) for n in MODEL_ORDER}, CHECKS, counted=m.observed)
    path = f"{root.rstrip('/')}/dq_results"
    results.write.mode("overwrite").parquet(path)
    if schema:
        from ..sources.catalog import register_tables  # noqa: PLC0415
        register_tables(spark, {n: (m.tables[n], layout_of(n)[0]) for n in MODEL_ORDER}, schema)
    return spark.read.parquet(path)
