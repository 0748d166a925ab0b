"""Row counts that ride along with the job that produces the rows."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class StageCounts:
    """Named row counts, filled in by the first action over each watched frame; no job of their own."""

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        self._watched[name] = Observation(name)
        return df.observe(self._watched[name], F.count(F.lit(1)).alias("rows"))

    def rows(self, name: str) -> int | None:
        """Waits for the action over the frame; call it only after that action was started."""
        return self._watched[name].get.get("rows")

    def all(self) -> dict[str, int | None]:
        return {name: self.rows(name) for name in self._watched}
