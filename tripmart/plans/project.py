"""Build every model of the trip warehouse from the written service lakes.

Materializations follow the model kinds: staging and the union stay views
(lazy temp views), dimensions and marts are overwritten tables, the fact is
incremental (high-water mark + keyed upsert). Marts read the written fact,
so each run scans the fact once per mart rather than recomputing it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.quality import run_suite
from tripmart.plans import marts
from tripmart.plans.fact import fact_columns, refresh_fact
from tripmart.plans.load import run_load
from tripmart.plans.publish import current_path, publish
from tripmart.plans.staging import stage, union_trips
from tripmart.plans.suite import SUITE
from tripmart.schemas import SERVICES, UNIONED
from tripmart.sources.catalog import Catalog
from tripmart.sources.load import load_raw
from tripmart.sources.seeds import builtin_seed, read_seed
from tripmart.sources.sinks import materialize_view, write_table

DIM_SEEDS = {"dim_taxi_zones": "taxi_zone_lookup", "dim_rate_codes": "rate_codes", "dim_vendors": "vendors",
             "dim_payment_types": "payment_types", "dim_hvfhv_bases": "hvfhv_bases"}


def build_catalog(spark: SparkSession, lakes: dict[str, str], seeds: dict[str, str | DataFrame] | None = None,
                  skip_bad_files: bool = True, raw_tables: dict[str, str] | None = None,
                  services: tuple[str, ...] = UNIONED) -> Catalog:
    """Sources: one typed raw table per service (a written table when
    ``raw_tables`` names one, else loaded from the lake on the fly), seeds by
    name. Models: staging views, the union view."""
    cat = Catalog(spark)
    for service, path in lakes.items():
        if raw_tables and service in raw_tables:
            cat.add_source(f"raw_{service}", raw_tables[service])
        else:
            cat.add_source(f"raw_{service}", loader=lambda s=service, p=path: load_raw(
                spark, p, SERVICES[s], skip_bad_files=skip_bad_files))
    for seed in DIM_SEEDS.values():
        given = (seeds or {}).get(seed)
        if isinstance(given, DataFrame):
            cat.add_source(seed, loader=lambda g=given: g)
        elif isinstance(given, str):
            cat.add_source(seed, loader=lambda p=given, n=seed: read_seed(spark, p, n))
        elif seed != "taxi_zone_lookup":
            cat.add_source(seed, loader=lambda n=seed: builtin_seed(spark, n))
    for service in lakes:
        cat.add_model(f"stg_{service}_trips",
                      lambda c, s=service: stage(c.source(f"raw_{s}"), SERVICES[s]))
    cat.add_model("int_all_trips_unioned", lambda c: union_trips(
        {s: c.ref(f"stg_{s}_trips") for s in services if s in lakes}, services))
    return cat


def run_project(spark: SparkSession, lakes: dict[str, str], warehouse: str,
                seeds: dict[str, str | DataFrame] | None = None, scope: str = "global",
                materialize_raw: bool = False, services: tuple[str, ...] = UNIONED,
                without: tuple[str, ...] = (), audit: bool = False) -> dict[str, str]:
    """Materialize dims, the fact and the marts below ``warehouse`` (and, with
    ``materialize_raw``, the typed raw tables first); returns model name -> path.
    Everything is built or an error says what is missing: ``services`` names the
    services to union, ``without`` the models to leave out. With ``audit``, the marts
    are versions that are published only if their declared tests pass (``plans.publish``:
    the paths are then those of the latest published versions), and so is the fact's batch."""
    missing = [s for s in services if s not in lakes]
    if missing:
        raise ValueError(f"no lake for {', '.join(missing)}")
    needs_zones = {"dim_taxi_zones", "mart_zone_performance"}
    if "taxi_zone_lookup" not in (seeds or {}) and not needs_zones <= {*without}:
        raise ValueError("the seed taxi_zone_lookup is missing: give it, or leave out dim_taxi_zones and mart_zone_performance")
    paths = {}
    raw_tables = None
    if materialize_raw:
        raw_tables = {s: os.path.join(warehouse, f"raw_{s}") for s in lakes}
        for s, lake in lakes.items():
            run_load(spark, lake, s, raw_tables[s])
            paths[f"raw_{s}"] = raw_tables[s]
    cat = build_catalog(spark, lakes, seeds, raw_tables=raw_tables, services=services)
    for name in [f"stg_{s}_trips" for s in lakes] + ["int_all_trips_unioned"]:
        materialize_view(cat.ref(name), name)
    for dim, seed in DIM_SEEDS.items():
        if dim not in without:
            paths[dim] = os.path.join(warehouse, dim)
            write_table(cat.source(seed), paths[dim])
    paths["fct_trips"] = os.path.join(warehouse, "fct_trips")
    specs = {t.model: t for t in SUITE} if audit else {}
    refresh_fact(spark, cat.ref("int_all_trips_unioned"), paths["fct_trips"], scope, tests=specs.get("fct_trips"))
    fact = fact_columns(spark.read.parquet(paths["fct_trips"]))
    built = {"mart_daily_summary": marts.daily_summary(fact),
             "mart_revenue_breakdown": marts.revenue_breakdown(fact)}
    if "mart_zone_performance" not in without:
        built["mart_zone_performance"] = marts.zone_performance(fact, spark.read.parquet(paths["dim_taxi_zones"]))
    for name, df in built.items():
        if name in without:
            continue
        if audit:
            publish(spark, warehouse, name, df, specs.get(name))
            paths[name] = current_path(spark, warehouse, name)
        else:
            paths[name] = os.path.join(warehouse, name)
            write_table(df, paths[name])
    return paths


def test_project(spark: SparkSession, lakes: dict[str, str], paths: dict[str, str],
                 services: tuple[str, ...] = UNIONED) -> DataFrame:
    """The declared tests over the built models (views rebuilt); models that
    ``run_project`` was told to leave out have no tests to run."""
    cat = build_catalog(spark, lakes, services=services)
    models = {name: spark.read.parquet(p) for name, p in paths.items()}
    models["fct_trips"] = fact_columns(models["fct_trips"])
    for name in [f"stg_{s}_trips" for s in lakes] + ["int_all_trips_unioned"]:
        models[name] = cat.ref(name)
    models = {k: v for k, v in models.items() if not k.startswith("raw_")}
    return run_suite(models, [s for s in SUITE if s.model in models])
