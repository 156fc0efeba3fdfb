"""Named models and how they are kept: as a view or as a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from touchline.operators import shaping, staging, star
from touchline.sinks.lake import write_partitioned
from touchline.sinks.tables import replace_partitions, replace_table
from touchline.sources.lake import scan_lake

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """A derived table: how to build it from named tables, and how it is kept.

    A ``view`` is built when it is read, a ``table`` is built anew by each run, and an ``incremental`` table replaces
    partitions by ``partition``: those a run has rows for or, with a ``window``, all of the last so many days, of which
    it takes the rows.
    """

    build: Callable[[Tables], DataFrame]
    materialized: str = "view"
    partition: str | None = None
    window: int | None = None


MODELS: dict[str, Model] = {
    "match_results": Model(lambda t: staging.drop_copies(t["game_results"])),
    "stadiums": Model(lambda t: shaping.stadium_dimension(t["timeline_all_uefa"])),
    "game_results": Model(lambda t: t["match_results"], "incremental", "game_date", 30),
    "goals": Model(lambda t: star.goal_rows(t["timeline_fifa"], t["link_match_to_fifa"]), "table"),
    "tmp_date_update": Model(
        lambda t: star.corrected_local_dates(t["matches"], t["link_match_to_uefa"], t["uefa_matches"]), "table"
    ),
    "link_stadium_to_uefa": Model(lambda t: star.link_stadiums(t["uefa_stadiums"], t["places"]), "table"),
    "goals_info": Model(lambda t: shaping.scorers(t["timeline"]), "table"),
}


def materialize(
    spark: SparkSession,
    name: str,
    tables: Tables,
    as_: str | None = None,
    models: Mapping[str, Model] = MODELS,
    as_of: date | str | None = None,
) -> DataFrame:
    """Build a model and register it under its name as a temporary view or a catalog table; runs may be repeated.

    An incremental model with a window is a lake below the warehouse, with a view over what is in force; the window
    ends on ``as_of``, today if not given.
    """
    model = models[name]
    rows = model.build(tables)
    kept = as_ or model.materialized
    if kept == "view":
        rows.createOrReplaceTempView(name)
    elif kept == "table":
        replace_table(rows, name)
    elif kept == "incremental" and model.window is not None:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"
        recent = staging.recent_rows(rows, model.partition, model.window, as_of)
        covers = staging.recent_days(spark, model.partition, model.window, as_of)
        write_partitioned(recent, path, [model.partition], covers=covers)
        scan_lake(spark, path, rows.schema).createOrReplaceTempView(name)
    elif kept == "incremental":
        replace_partitions(rows, name, model.partition)
    else:
        raise ValueError(f"unknown materialization {kept!r}")
    return spark.table(name)
