"""The live measures by name: what each publishes, and where it goes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions.telemetry import encode, from_topic
from paceline.plans import live
from paceline.sources.jdbc import Database
from paceline.streaming.sinks import FileTarget, JdbcTarget, KafkaTarget, Target


@dataclass(frozen=True)
class Measure:
    """One live measure. ``rows`` makes it from telemetry, or ``chained`` from the messages of the topic
    ``source`` of the measure before it; windows carry two times, see ``live``."""

    rows: Callable[[DataFrame], DataFrame]
    value: str
    topic: str | None = None
    table: str | None = None
    unit: str = ""
    windowed: bool = False
    source: str | None = None
    chained: Callable[[DataFrame], DataFrame] | None = None

    def from_source(self, messages: DataFrame) -> DataFrame:
        """What is published, from the messages of the source topic in place of telemetry."""
        if self.chained is None:
            raise ValueError("this measure starts from telemetry")
        return self._published(self.chained(from_topic(messages, self.source_value)))

    @property
    def source_value(self) -> str:
        return "altitude_gain" if self.source == "altitude_gains" else "speed"

    def published(self, telemetry: DataFrame) -> DataFrame:
        """Rows with the columns of the table, and key and message of the topic."""
        return self._published(self.rows(telemetry))

    def _published(self, rows: DataFrame) -> DataFrame:
        on_topic = live.topic_time() if self.windowed else F.col("time")
        in_table = live.table_time() if self.windowed else F.col("time")
        return rows.select(
            "runner_id",
            in_table.alias("time"),
            self.value,
            F.col("runner_id").cast("string").alias("key"),
            encode(on_topic, F.col(self.value), self.unit).alias("value_text"),
        )

    def targets(
        self, servers: str | None = None, database: Database | None = None, files: str | None = None
    ) -> list[Target]:
        """All targets there are an address for: topic, table, and files: messages, or the table without them."""
        message = F.col("value_text").alias("value")
        found: list[Target] = []
        if servers and self.topic:
            found.append(KafkaTarget(servers, self.topic, ["key", message]))
        if database and self.table:
            found.append(JdbcTarget(database, self.table, ["runner_id", "time", self.value]))
        if files and self.topic:
            found.append(FileTarget(f"{files}/{self.topic}", [message], format="csv"))
        elif files and self.table:
            found.append(FileTarget(f"{files}/{self.table}", ["runner_id", "time", self.value]))
        if not found:
            raise ValueError("no target for this measure")
        return found


def measures(history: DataFrame | None = None, length_km: int = 21, salts: int = 8) -> dict[str, Measure]:
    """All measures; the finish estimate only if there is a history of the runners."""
    known = {
        "speed": Measure(live.speeds, "speed", topic="speed"),
        "pace": Measure(lambda t: live.paces(live.speeds(t)), "pace", "pace", "pace",
                        source="speed", chained=live.paces),
        "avg_speed": Measure(
            lambda t: live.average_speeds(live.speeds(t)),
            "avg_speed", "avg_speed", "avg_speed", windowed=True,
            source="speed", chained=live.average_speeds,
        ),
        "comparison": Measure(
            lambda t: live.comparisons(live.speeds(t)),
            "comparison", "current_speed_comp", "comparison",
            source="speed", chained=live.comparisons,
        ),
        "altitude_gain": Measure(live.altitude_gains_live, "altitude_gain", "altitude_gains"),
        "elevation": Measure(
            live.elevation_windows_live, "value", table="altitude_gain", windowed=True,
            source="altitude_gains", chained=live.elevation_of_gains,
        ),
    }
    if history is not None:
        known["finish"] = Measure(
            lambda t: live.finish_estimates(t, history, length_km, salts),
            "estimated_min", "finish_estimation", "finish_estimation", unit=" min",
        )
    return known
