"""Landed batches of updates as a stream, with a cursor for each platform.

A platform's updates land in numbered lots, ``<path>/piattaforma=<name>/lotto=<number>/*.parquet``, each moved into place
when it is whole. The stream's offset is the last lot read of every platform; Spark keeps it in the checkpoint and moves it
only after a batch has been merged, so a crash between the merge and the commit repeats the batch and loses none of it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

PLATFORM, LOT = "piattaforma", "lotto"


def file_system(uri: str):
    """The file system of a URI or path, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


@dataclass
class LotFile(InputPartition):
    platform: str
    lot: int
    file: str


class LotReader(DataSourceStreamReader):
    """One partition a file; lots of a platform that are not newer than the cursor are not opened."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def _lots(self) -> dict[str, dict[int, str]]:
        """Folders of lots by platform and number; what is named otherwise is no lot."""
        from pyarrow.fs import FileSelector

        system, top = file_system(self.path)
        out: dict[str, dict[int, str]] = {}
        for info in system.get_file_info(FileSelector(top, allow_not_found=True)):
            if info.base_name.startswith(f"{PLATFORM}="):
                for lot in system.get_file_info(FileSelector(info.path)):
                    number = lot.base_name.removeprefix(f"{LOT}=")
                    if lot.base_name.startswith(f"{LOT}=") and number.isdigit():
                        out.setdefault(info.base_name.removeprefix(f"{PLATFORM}="), {})[int(number)] = lot.path
        return out

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {platform: max(lots) for platform, lots in self._lots().items() if lots}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        from pyarrow.fs import FileSelector

        system, _ = file_system(self.path)
        out = []
        for platform, lots in sorted(self._lots().items()):
            for number in sorted(n for n in lots if start.get(platform, -1) < n <= end.get(platform, -1)):
                out += [LotFile(platform, number, f.path) for f in sorted(system.get_file_info(FileSelector(lots[number])), key=lambda f: f.path) if f.base_name.endswith(".parquet")]
        return out

    def read(self, partition: LotFile) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = file_system(self.path)
        wanted = to_arrow_schema(self.schema)
        with system.open_input_file(partition.file) as source:
            file = pq.ParquetFile(source)
            held = [n for n in wanted.names if n in file.schema_arrow.names]
            for batch in file.iter_batches(columns=held):
                given = {PLATFORM: pa.array([partition.platform] * batch.num_rows), LOT: pa.array([partition.lot] * batch.num_rows)}
                columns = [batch.column(f.name) if f.name in held else given.get(f.name, pa.nulls(batch.num_rows)) for f in wanted]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, wanted)], schema=wanted)

    def commit(self, end: dict) -> None:
        """Nothing to do: lots stay where they are, for replays."""


class LandedUpdates(DataSource):
    """``readStream.format("landed_updates").schema(...).load(path)``; columns that a lot has not are null, and ``piattaforma``
    and ``lotto`` may be asked for."""

    @classmethod
    def name(cls) -> str:
        return "landed_updates"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LotReader(self.options["path"], schema)


def read_updates(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stream of landed lots; ``schema`` as DDL."""
    spark.dataSource.register(LandedUpdates)
    return spark.readStream.format("landed_updates").schema(schema).load(path)


def land(rows: DataFrame, path: str) -> None:
    """Rows with ``piattaforma`` and ``lotto`` put where ``read_updates`` finds them, all lots of a call at once."""
    rows.write.mode("append").partitionBy(PLATFORM, LOT).parquet(path)
