"""Tables in a database."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """A JDBC database; ``properties`` hold user, password and driver."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self, table: str, **more: object) -> dict[str, str]:
        given = {"url": self.url, "dbtable": table, **self.properties, **more}
        return {name: str(value) for name, value in given.items()}

    def read(
        self, spark: SparkSession, table: str, column: str, lower: int, upper: int, partitions: int
    ) -> DataFrame:
        """A table read in parallel, in ranges of a numeric column. Filters run in the database."""
        ranges = self.options(
            table,
            partitionColumn=column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
        )
        return spark.read.format("jdbc").options(**ranges).load()

    def execute(self, spark: SparkSession, statement: str) -> None:
        """Run a statement that returns nothing, on the driver."""
        java = spark.sparkContext._jvm.java
        given = java.util.Properties()
        for name, value in self.properties.items():
            given.setProperty(name, value)
        connection = java.sql.DriverManager.getConnection(self.url, given)
        try:
            connection.createStatement().executeUpdate(statement)
        finally:
            connection.close()

    def overwrite(self, df: DataFrame, table: str, connections: int = 32) -> None:
        """Replace the rows of a table and keep its definition; an empty frame empties it."""
        self._write(df, table, "overwrite", connections, truncate="true")

    def append(self, df: DataFrame, table: str, connections: int = 32) -> None:
        self._write(df, table, "append", connections)

    def _write(self, df: DataFrame, table: str, mode: str, connections: int, **more: str) -> None:
        # Dealt out by a shuffle: numPartitions alone would make the tasks before it as few.
        given = self.options(table, numPartitions=connections, batchsize=10_000, **more)
        df.repartition(connections).write.format("jdbc").options(**given).mode(mode).save()
