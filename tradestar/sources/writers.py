"""Concurrent writes of independent tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from tradestar.session import WIDE_TABLE_CODEC


def write_all(frames: dict[str, DataFrame], write_one: Callable[[str, DataFrame], None]) -> None:
    """Run ``write_one(name, df)`` for every frame as concurrent Spark jobs
    (one thread each).

    The jobs share the cluster; small tables no longer wait for each other's
    scheduling.  The first failure is raised after all writes have finished.
    """
    if not frames:
        return
    with ThreadPoolExecutor(max_workers=min(len(frames), 16)) as pool:
        for f in [pool.submit(write_one, name, df) for name, df in frames.items()]:
            f.result()


def parquet_writer(path_of: Callable[[str], str], mode: str = "overwrite") -> Callable[[str, DataFrame], None]:
    return lambda name, df: df.write.mode(mode).parquet(path_of(name), compression=WIDE_TABLE_CODEC)
