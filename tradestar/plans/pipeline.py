"""End-to-end job: test tables -> bronze (Parquet) -> star -> stored warehouse.

``bronze_tables`` extracts bronze tables, each once per (application, input folder): a
query of one table neither extracts the others nor builds the star.

``warehouse_for`` builds the star once per (application, input folder) and
keeps it for the session: the written warehouse (Parquet, under the
checkpoint folder) serves the marts and checks, the built star (over its
materialised tables) serves the staging views (FX join, keys, audit).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from tradestar.plans.star import Star, build_star, read_star, write_star
from tradestar.session import scratch_path
from tradestar.sources.bronze import Bronze
from tradestar.sources.fixture import extract_tables


@dataclass
class Built:
    bronze: Bronze
    star: Star
    warehouse: Star
    path: str


_MEMO: dict[tuple, Built] = {}
_BRONZE: dict[tuple, dict[str, DataFrame]] = {}
# Builds that keep their dimensions cached; frames of an older one stay valid, and recompute what they need.
KEPT = 2


def bronze_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named bronze tables, stored; those that are not there yet are extracted together."""
    found = _BRONZE.setdefault((spark.sparkContext.applicationId, sf_dir.rstrip("/")), {})
    missing = [n for n in names if n not in found]
    if missing:
        found.update(extract_tables(spark, sf_dir, scratch_path(spark, "bronze"), missing))
    return {n: found[n] for n in names}


def bronze_for(spark: SparkSession, sf_dir: str) -> Bronze:
    """All nine bronze tables, stored."""
    return Bronze(**bronze_tables(spark, sf_dir, *[f.name for f in fields(Bronze)]))


def warehouse_for(spark: SparkSession, sf_dir: str, unknown_member: bool = False) -> Built:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), *([unknown_member] if unknown_member else []))
    built = _MEMO.get(key)
    if built is None:
        while len(_MEMO) >= KEPT:
            _MEMO.pop(next(iter(_MEMO))).star.release()
        bronze = bronze_for(spark, sf_dir)
        star = build_star(spark, bronze, unknown_member=unknown_member)
        path = scratch_path(spark, "warehouse")
        write_star(star, path)
        built = Built(bronze, star, read_star(spark, path), path)
        _MEMO[key] = built
    return built
