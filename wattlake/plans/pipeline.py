"""The medallion run: catalogs, bronze, silver, marts, contracts."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.plans import medallion
from wattlake.plans.contracts import Contract, campus_contracts, run_contracts
from wattlake.schema import MartContract


@dataclass
class PipelineReport:
    """Outcome per stage; stages after a failure are absent."""

    stages: dict[str, bool] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    failed_contracts: list[str] = field(default_factory=list)
    error: str = ""

    @property
    def success(self) -> bool:
        return bool(self.stages) and all(self.stages.values())


def run_pipeline(raw: DataFrame, buildings: DataFrame, meters: DataFrame, out: str,
                 contract: MartContract = MartContract(),
                 contracts: Sequence[Contract] | None = None) -> PipelineReport:
    """K-06: writes catalogs, silver and the marts below ``out`` and checks the contracts.

    Bronze stays a view.  Silver and the facility totals are written once and
    read back, so no mart recomputes them and a lost executor costs one stage.
    Stops at the first stage that fails; the contract report (K-05) is written to
    ``out/contracts``.
    """
    spark = raw.sparkSession
    report = PipelineReport()
    tables: dict[str, DataFrame] = {}

    def store(name: str, layer: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{out}/{layer}/{name}")
        return spark.read.parquet(f"{out}/{layer}/{name}")

    def seed() -> bool:
        tables["buildings"] = store("buildings", "silver", buildings)
        tables["meters"] = store("meters", "silver", meters)
        return True

    def run() -> bool:
        tables["bronze"] = medallion.bronze(raw)
        tables["silver"] = store("telemetry", "silver",
                                 medallion.silver(tables["bronze"], tables["buildings"], tables["meters"]))
        totals = store("facility_totals", "silver", medallion.facility_totals(tables["silver"]))
        tables["hourly"] = store("hourly", "gold", medallion.hourly_facility_demand(tables["silver"]))
        tables["daily"] = store("daily", "gold", medallion.daily_dispatch(tables["silver"], contract))
        tables["efficiency"] = store("efficiency", "gold",
                                     medallion.rank_in_category(medallion.peak_share(totals)))
        return True

    def test() -> bool:
        wanted = campus_contracts() if contracts is None else contracts
        run_contracts(tables, wanted).coalesce(1).write.mode("overwrite").parquet(f"{out}/contracts")
        found = spark.read.parquet(f"{out}/contracts")
        broken = found.where(~F.col("passed")).collect()  # at most a row per contract
        report.failed_contracts = [f"{row['model']}.{row['column']} {row['test']}" for row in broken]
        return not broken

    for name, stage in (("seed", seed), ("run", run), ("test", test)):
        started = time.monotonic()
        try:
            report.stages[name] = stage()
        except Exception as error:  # the report names the stage that failed
            report.stages[name], report.error = False, str(error)
        report.seconds[name] = round(time.monotonic() - started, 2)
        if not report.stages[name]:
            break
    return report
