"""Run log of a warehouse build.

Row counts come from ``DataFrame.observe`` metrics collected by the write
action itself, so logging adds no extra job.  Failures are logged too (the
step re-raises after its row is recorded).
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("step string, description string, status string, input_rows long, output_rows long, "
              "started string, seconds double, error_msg string")


class RunLog:
    def __init__(self):
        self.entries: list[tuple] = []

    def observed(self, df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
        obs = Observation(name)
        return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs

    def run_step(self, step: str, action: Callable[[], DataFrame | None], description: str = "",
                 input_rows: int | None = None, sink: Callable[[DataFrame], None] | None = None):
        """Run ``action`` (which returns a lazy frame); ``sink`` writes it.

        The output count is read from the observation of that write.
        """
        start = time.time()
        stamp = _dt.datetime.now().isoformat(timespec="seconds")
        try:
            df = action()
            out_rows = None
            if df is not None and sink is not None:
                df, obs = self.observed(df, step)
                sink(df)
                out_rows = obs.get.get("rows")
            self.entries.append((step, description, "success", input_rows, out_rows, stamp, time.time() - start, None))
            return df
        except Exception as e:  # noqa: BLE001 - logged, then re-raised
            self.entries.append((step, description, "error", input_rows, None, stamp, time.time() - start, str(e)))
            raise

    def summary(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries, LOG_SCHEMA)
