"""Continuous queries under a name: stored streams and tables that further queries read on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tweetflow.fixed import SQL_COMPACTION
from tweetflow.operators.totals import latest_by_key
from tweetflow.schemas import with_batch
from tweetflow.session import state_settings


class Statements:
    """Named streams and tables below a folder.

    A statement is a streaming query that keeps its name, its rows and its checkpoint. Given again under a name that exists,
    it goes on where it stopped; ``drop`` ends it and frees the name, so that another may take it. Names are tables of
    the session's catalog, and so last as long as that does.

    ``session`` is a session of its own, where options of stateful streams are set apart from the caller's; what
    statements read has to be made with it.
    """

    def __init__(self, spark: SparkSession, path: str, state_partitions: int | None = None):
        self.path, self.session = path.rstrip("/"), spark.newSession()
        self.session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
        for option, value in state_settings(state_partitions).items():
            self.session.conf.set(option, value)

    def _place(self, name: str) -> str:
        """The folder of a name, a new one if the name is free."""
        if not self.session.catalog.tableExists(name):
            return f"{self.path}/{name}-{uuid.uuid4().hex}"
        described = self.session.sql(f"DESCRIBE TABLE EXTENDED {name}")
        (location,) = described.where("col_name = 'Location'").select("data_type").first()
        return location.rsplit("/", 1)[0]

    def create_stream_as(self, name: str, rows: DataFrame, trigger: dict = SQL_COMPACTION) -> StreamingQuery:
        """Store a stream's rows under a name as they come, each exactly once."""
        place = self._place(name)
        return (
            rows.writeStream.queryName(name).outputMode("append").format("parquet").option("path", f"{place}/rows")
            .option("compression", "zstd").option("checkpointLocation", f"{place}/checkpoint").trigger(**trigger).toTable(name)
        )

    def create_table_as(self, name: str, rows: DataFrame, trigger: dict = SQL_COMPACTION) -> StreamingQuery:
        """Store a running table's updates (a stream in update mode, one row per changed key and micro-batch) under a name.

        What the name holds is the table's changelog, with the micro-batch of each row. A micro-batch that runs again
        replaces its own folder.
        """
        place = self._place(name)
        if not self.session.catalog.tableExists(name):
            self.session.catalog.createTable(name, f"{place}/rows", "parquet", with_batch(rows.schema), recursiveFileLookup="true")

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{place}/rows/{batch_id:09}")

        return (
            rows.writeStream.queryName(name).outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{place}/checkpoint").trigger(**trigger).start()
        )

    def stream(self, name: str) -> DataFrame:
        """The rows of a named stream, or the updates of a named table, as a stream."""
        return self.session.readStream.table(name)

    def rows(self, name: str) -> DataFrame:
        """What a name holds by now: a stream's rows, or a table's updates."""
        self.session.catalog.refreshTable(name)
        return self.session.table(name)

    def table(self, name: str, key: str) -> DataFrame:
        """A named table as it stands: the last update per key."""
        return latest_by_key(self.rows(name), [key], ["batch_id"]).drop("batch_id")

    def checkpoint(self, name: str) -> str:
        return f"{self._place(name)}/checkpoint"

    def drop(self, name: str) -> None:
        """End the query of a name, if it runs, and free the name; nothing happens if there is none. Files stay."""
        for query in self.session.streams.active:
            if query.name == name:
                query.stop()
        self.session.sql(f"DROP TABLE IF EXISTS {name}")
