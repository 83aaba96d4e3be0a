"""Paced replay: a source that says which file is due, and a stream that sends its lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from tweetflow.fixed import PACED

Send = Callable[[DataFrame, int], None]


class _Turns(SimpleDataSourceStreamReader):
    """One (pass, file) per micro-batch, file by file and pass by pass. The offset is the next one to be sent."""

    def __init__(self, files: int, passes: int):
        self.files, self.passes = files, passes

    def initialOffset(self) -> dict:
        return {"pass": 0, "file": 0}

    def _after(self, at: dict) -> dict | None:
        """The offset behind one turn; None if no turn is left."""
        if not self.files or 0 < self.passes <= at["pass"]:
            return None
        last = at["file"] + 1 == self.files
        return {"pass": at["pass"] + last, "file": 0 if last else at["file"] + 1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        after = self._after(start)
        return (iter([(start["pass"], start["file"])]), after) if after else (iter([]), start)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for turn in range(start["pass"] * self.files + start["file"], end["pass"] * self.files + end["file"]):
            yield divmod(turn, self.files)


class ReplayTurns(DataSource):
    """Options: files, how many there are; passes over them, 0 without an end."""

    @classmethod
    def name(cls) -> str:
        return "replay_turns"

    def schema(self) -> str:
        return "pass long, file long"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Turns(int(self.options["files"]), int(self.options.get("passes", "0")))


def _files(spark: SparkSession, path: str, kept: str) -> list[str]:
    """The files of a folder by name, as they were at the first start."""
    try:
        names = [row["value"] for row in spark.read.schema("value string").text(kept).collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        names = spark.read.text(path).inputFiles()
        spark.createDataFrame([(name,) for name in names], "value string").coalesce(1).write.text(kept)
    return sorted(names)


def start_replay(
    spark: SparkSession, path: str, send: Send, checkpoint: str, passes: int = 0, trigger: dict = PACED
) -> StreamingQuery:
    """Send a folder's text files in the order of their names, one per trigger: each second one, over and over.

    ``send`` gets the lines (value) of a file and the number of the micro-batch, and replaces what it wrote under that
    number before. ``passes`` ends the replay after so many passes, 0 never. A start from the same checkpoint goes on with
    the next file; files that came since the first start are not sent. Turns are rows of a source, the lines are read by
    Spark, so files may lie wherever it reads, and one file is read per trigger. A folder without files sends nothing.
    """
    return _start_turns(spark, _files(spark, path, f"{checkpoint}/files"), send, f"{checkpoint}/turns", passes, trigger)


def start_replays(
    spark: SparkSession, path: str, sender: Callable[[int], Send], checkpoint: str, producers: int, passes: int = 0, trigger: dict = PACED
) -> list[StreamingQuery]:
    """The replay of a folder shared by producers, one for each partition of a topic: files are dealt to them by their names.

    Each is a replay of its own, one file per trigger and pass by pass, that sends by what ``sender`` makes of its number. A file
    is read and written by one task, so a replay alone keeps one core busy, however large the folder. Files of different
    producers have no order among them, as records of different partitions have none. Starts from the same checkpoint need
    the same number of producers; those without files are not started.
    """
    names = _files(spark, path, f"{checkpoint}/files")
    started = []
    try:
        for i in range(min(producers, len(names))):
            started.append(_start_turns(spark, names[i::producers], sender(i), f"{checkpoint}/turns-{i}-of-{producers}", passes, trigger))
    except BaseException:
        for query in started:
            query.stop()
        raise
    return started


def _start_turns(
    spark: SparkSession, names: list[str], send: Send, checkpoint: str, passes: int, trigger: dict
) -> StreamingQuery:
    """Send given files in their order, one per trigger."""
    spark.dataSource.register(ReplayTurns)
    turns = spark.readStream.format("replay_turns").option("files", len(names)).option("passes", passes).load()

    def due(batch: DataFrame, batch_id: int) -> None:
        files = [batch.sparkSession.read.text(names[row["file"]]) for row in batch.collect()]
        if files:
            send(reduce(DataFrame.unionAll, files), batch_id)

    return turns.writeStream.foreachBatch(due).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def topic_sender(path: str, compression: str = "none") -> Send:
    """Adds lines to a topic folder, in a folder per micro-batch that a second run replaces; read it as ``path/*``."""

    def send(lines: DataFrame, batch_id: int) -> None:
        lines.write.mode("overwrite").option("compression", compression).text(f"{path}/batch_id={batch_id}")

    return send
