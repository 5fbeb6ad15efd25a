"""All layers as lazy DataFrames, from raw frames or from stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import HOURS_HIGH, HOURS_LOW, clean_eod, clean_lms, explode_mentors
from ..schemas import COLUMNS, GOLD_TABLES, SILVER_TABLES
from ..sources.bronze import EOD_TABLE, LMS_TABLE
from . import gold, silver

#: Stored beside the Silver tables: facts reduced per day and per person and course.
REDUCED = ["eod_days", "lms_people"]


class Warehouse(Mapping):
    """Table name to DataFrame; a table's plan is built when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[["Warehouse"], DataFrame]]):
        self._builders = dict(builders)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name](self)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __contains__(self, name: object) -> bool:
        return name in self._builders

    def replaced(self, **frames: DataFrame) -> "Warehouse":
        """The same tables, some of them replaced by other frames; what is derived from them follows."""
        return Warehouse({**self._builders, **{n: lambda w, f=f: f for n, f in frames.items()}})

    def replaced_by(self, builders: Mapping[str, Callable[["Warehouse"], DataFrame]]) -> "Warehouse":
        return Warehouse({**self._builders, **builders})

    @staticmethod
    def from_raw(
        frames: Mapping[str, DataFrame],
        low: float = HOURS_LOW,
        high: float = HOURS_HIGH,
        dense_ids: bool = False,
    ) -> "Warehouse":
        """Without ``dense_ids`` everything stays lazy and the facts lack their row id."""
        return Warehouse(
            {
                **_cleaned(frames, low, high),
                **(silver.DENSE_BUILDERS if dense_ids else silver.BUILDERS),
                **gold.BUILDERS,
            }
        )

    @staticmethod
    def from_catalog(
        spark: SparkSession, silver_db: str = "silver", gold_db: str = "gold"
    ) -> "Warehouse":
        """The stored tables, with their columns in the order of the schema."""
        def stored(database: str, name: str) -> Callable[["Warehouse"], DataFrame]:
            if name in COLUMNS:
                return lambda w: spark.table(f"{database}.{name}").select(*COLUMNS[name])
            return lambda w: spark.table(f"{database}.{name}")

        found = {t: stored(silver_db, t) for t in (*SILVER_TABLES, *REDUCED)}
        return Warehouse(found | {t: stored(gold_db, t) for t in GOLD_TABLES})

    def with_raw(self, frames: Mapping[str, DataFrame], low: float = HOURS_LOW, high: float = HOURS_HIGH) -> "Warehouse":
        """Stored tables with the raw and cleaned rows they came from; ``frames`` are looked up when asked for."""
        return Warehouse({**_cleaned(frames, low, high), **self._builders})


def _cleaned(frames: Mapping[str, DataFrame], low: float, high: float) -> dict[str, Callable[[Warehouse], DataFrame]]:
    return {
        EOD_TABLE: lambda w: frames[EOD_TABLE],
        LMS_TABLE: lambda w: frames[LMS_TABLE],
        "eod_clean": lambda w: clean_eod(w[EOD_TABLE], low, high),
        "lms_clean": lambda w: clean_lms(w[LMS_TABLE]),
        "mentors": lambda w: explode_mentors(w["lms_clean"]),
    }
