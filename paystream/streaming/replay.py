"""Run a streaming query over tables that arrive one after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from paystream.session import stream_session, work_dir

STEP = "step"


def arriving(rows: DataFrame, when: Mapping[int, Column]) -> DataFrame:
    """``rows`` with the number of the step at which they arrive, once for each whose condition holds."""
    steps = F.array(*(F.when(holds, F.lit(number)) for number, holds in when.items()))
    return rows.withColumn(STEP, F.explode(F.array_compact(steps)))


@dataclass
class Replay:
    """Feeds a query step by step, as a stream in production would be fed.

    Each step becomes a folder below the one the query reads, all its files at once by a rename,
    and the next one waits until nothing is left to do. So each step is one micro-batch, and the
    watermark moves on between steps. With ``restarts`` the query is stopped after every step
    and goes on from its checkpoint.
    """

    spark: SparkSession
    name: str
    partitions: int | None = None
    restarts: bool = False
    progress: list[list[dict]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.session = stream_session(self.spark, self.partitions)
        self.base = work_dir(self.spark, self.name)

    @property
    def output(self) -> str:
        return f"{self.base}/output"

    @property
    def input(self) -> str:
        return f"{self.base}/input/*"

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/checkpoint"

    def _arrive(self, staged: str, number: int) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(staged), hadoop.Path(f"{self.base}/input/step-{number}")
        files = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"{target} could not be put in place")

    def run(
        self,
        steps: Iterable[DataFrame],
        start: Callable[[DataFrame, str, str], DataStreamWriter],
    ) -> None:
        """``start(stream, output path, checkpoint path)`` gives the writer to run."""
        def staged() -> Iterator[tuple[str, StructType]]:
            for number, rows in enumerate(steps):
                path = f"{self.base}/staged-{number}"
                rows.write.parquet(path)
                yield path, rows.schema

        self._feed(staged(), start)

    def run_numbered(
        self, rows: DataFrame, steps: int, start: Callable[[DataFrame, str, str], DataStreamWriter]
    ) -> None:
        """The same with all steps in one table, which is worked out and written once.

        Column ``step`` numbers them from 0, see :func:`arriving`. A step without rows arrives empty.
        """
        base, schema = f"{self.base}/staged", rows.drop(STEP).schema
        rows.write.partitionBy(STEP).parquet(base)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.Path(base).getFileSystem(self.spark._jsc.hadoopConfiguration())

        def staged() -> Iterator[tuple[str, StructType]]:
            for number in range(steps):
                path = f"{base}/{STEP}={number}"
                if not files.exists(hadoop.Path(path)):
                    self.spark.createDataFrame([], schema).write.parquet(path)
                yield path, schema

        self._feed(staged(), start)

    def _feed(
        self,
        staged: Iterable[tuple[str, StructType]],
        start: Callable[[DataFrame, str, str], DataStreamWriter],
    ) -> None:
        query: StreamingQuery | None = None
        seen = -1
        try:
            for number, (path, schema) in enumerate(staged):
                self._arrive(path, number)
                if query is None:
                    stream = self.session.readStream.schema(schema).parquet(self.input)
                    query = start(stream, self.output, self.checkpoint).start()
                query.processAllAvailable()
                self.progress.append([p for p in query.recentProgress if p["batchId"] > seen])
                seen = max([seen, *(p["batchId"] for p in self.progress[-1])])
                if self.restarts:
                    query.stop()
                    query = None
        finally:
            if query is not None:
                query.stop()

    def dropped_by_watermark(self, step: int) -> int:
        """Rows the stateful operators refused as too late in one step."""
        return sum(
            int(operator["numRowsDroppedByWatermark"])
            for batch in self.progress[step]
            for operator in batch["stateOperators"]
        )
