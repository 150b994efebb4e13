"""Replace-then-append loads into a relational target.

The target is either a JDBC table or, with the same two steps, a catalog table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import JDBC_BATCH_ROWS, Contract, Service
from tripmart.session import setting
from tripmart.sources import files, versions


DELIVERY = "_delivery"


class Target(Protocol):
    def save(self, df: DataFrame, mode: str, delivery: str | None = None) -> None: ...


@dataclass(frozen=True)
class TableTarget:
    """A versioned catalog table whose appends are told apart by the delivery they bring.

    A delivery has a partition of its own, which the name does not show. Appending a delivery again overwrites that
    partition alone, so a retried append changes nothing and a failed one is mended by running it again.
    """

    name: str

    def save(self, df: DataFrame, mode: str, delivery: str | None = None) -> None:
        """Without a delivery every append is one of its own."""
        if DELIVERY in df.columns:
            raise ValueError(f"{DELIVERY} is the name of the column that tells deliveries apart")
        spark, key = df.sparkSession, delivery or uuid.uuid4().hex
        if mode == "overwrite":
            versions.publish(df.withColumn(DELIVERY, F.lit(key)), self.name, [DELIVERY], hidden=[DELIVERY])
            return
        columns = ", ".join(f"`{c}`" for c in spark.table(self.name).columns)
        literal = key.replace("\\", "\\\\").replace("'", "\\'")
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
            spark.sql(
                f"INSERT OVERWRITE TABLE {versions.stored(spark, self.name)} PARTITION ({DELIVERY} = '{literal}') "
                f"SELECT {columns} FROM {{rows}}",
                rows=df,
            )


@dataclass(frozen=True)
class JdbcTarget:
    """A table behind a JDBC URL.

    ``connections`` bounds how many tasks insert at a time, if given; the rows are then dealt
    to that many tasks by a shuffle, and the work before it keeps its own width.

    A task inserts its partition in one transaction, so a task lost before its commit
    leaves nothing behind. One lost between commit and report is run again and inserts
    twice; reload from :func:`create_empty` when an executor was lost in the last step. For the same reason a
    delivery cannot be told apart here, and naming one raises.
    """

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    batch_rows: int = JDBC_BATCH_ROWS
    connections: int | None = None

    def options(self) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": self.table,
            "batchsize": str(self.batch_rows),
        }

    def writer(self, df: DataFrame, mode: str) -> DataFrameWriter:
        dealt = df.repartition(self.connections) if self.connections else df
        return dealt.write.mode(mode).format("jdbc").options(**self.options())

    def save(self, df: DataFrame, mode: str, delivery: str | None = None) -> None:
        if delivery is not None:
            raise ValueError("a JDBC table does not tell deliveries apart")
        self.writer(df, mode).save()


def create_empty(df: DataFrame, target: Target) -> None:
    """Drop the target and create it with the columns of ``df`` and no rows."""
    target.save(df.limit(0), "overwrite")


def append(df: DataFrame, target: Target, delivery: str | None = None) -> None:
    """Add rows. A named delivery is there once, however often it is appended; the last one counts."""
    if delivery is None:
        target.save(df, "append")
    else:
        target.save(df, "append", delivery)


def replace_then_append(df: DataFrame, target: Target) -> None:
    """A load that leaves the target holding exactly ``df``, however often it is run."""
    create_empty(df, target)
    append(df, target)


def replace(df: DataFrame, target: Target) -> None:
    """The same in a single overwrite."""
    target.save(df, "overwrite")


def month_table(service: Service, month: str) -> str:
    """Name of a relational table that holds one month of a service."""
    return f"{service.folder}_{month.replace('-', '_')}"


def load_month(spark: SparkSession, landing: str, service: Service, month: str, target: Target) -> None:
    """A landed month, as delivered, into its own table."""
    replace_then_append(files.read_file(spark, files.landing_path(landing, service, month)), target)


def load_csv(spark: SparkSession, path: str, contract: Contract, target: Target) -> None:
    """A CSV of any size into a table; timestamps are parsed by the contract. The text is
    read in splits, so nothing bounds the rows but the target."""
    replace_then_append(files.read_csv(spark, path, contract), target)
