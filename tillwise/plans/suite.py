"""Run the whole set of analyses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillwise.catalog import ANALYSES, Analysis
from tillwise.model import RetailTables
from tillwise.sources.staging import stage


def run_suite(t: RetailTables, analyses: Mapping[str, Analysis] = ANALYSES) -> DataFrame:
    """(name, row_count) per analysis; stops at the first failure, naming it.

    Results go to the noop sink, which computes every column; a count alone would let Spark
    prune one that fails. Totals that several analyses start from are written once, by the first
    that asks for them; if they fail, that one is named.
    """
    t, done = t.sharing(stage), []
    for name, op in analyses.items():
        try:
            seen = Observation()
            observed = op(t).observe(seen, F.count(F.lit(1)).alias("n"))
            observed.write.format("noop").mode("overwrite").save()
            done.append((name, seen.get["n"]))
        except Exception as error:
            raise RuntimeError(f"analysis {name} failed") from error
    return t.sales.sparkSession.createDataFrame(done, "name string, row_count long")
