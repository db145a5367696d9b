"""A stream of posts whose offset is the newest id that was read."""

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NUMBER = "id_number"
NAME = "posts_since_id"


def save_numbered(raw: DataFrame, path: str, mode: str = "append", id_column: str = "id") -> None:
    """Posts as Parquet with their ids as numbers, in ranges of ids: the footer of a file says which ids
    it holds. Ids that are no numbers, or none of 64 bits, are left out; ``filters.without_number``
    lists the former."""
    numbered = raw.withColumn(NUMBER, F.col(id_column).try_cast("decimal(38,0)").try_cast("bigint"))
    rows = numbered.where(F.col(NUMBER).isNotNull()).repartitionByRange(NUMBER).sortWithinPartitions(NUMBER)
    rows.write.mode(mode).parquet(path)


@dataclass
class IdRange(InputPartition):
    """The posts of one file with an id above ``low``, up to ``high``."""

    path: str
    low: int
    high: int


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    scheme, mark, rest = path.partition(":")
    if not mark:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(f"file:///{rest.lstrip('/')}" if scheme == "file" else path)


class SinceReader(DataSourceStreamReader):
    """Batches of posts by id. The driver reads footers of new files only; tasks read the files whose
    ids reach into the batch, and of these the row groups that do."""

    def __init__(self, schema: StructType, options: dict):
        self.names = schema.fieldNames()
        self.path, self.since = options["path"], int(options.get("since", -1))
        self.ranges: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {"id": self.since}

    def _look(self) -> None:
        system, folder = _folder(self.path)
        for info in system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True)):
            if info.base_name.startswith(("_", ".")) or not info.path.endswith(".parquet") or info.path in self.ranges:
                continue
            with system.open_input_file(info.path) as file:
                footer = pq.read_metadata(file)
            column = footer.schema.to_arrow_schema().get_field_index(NUMBER)
            stats = [footer.row_group(k).column(column).statistics for k in range(footer.num_row_groups)]
            if stats:
                self.ranges[info.path] = min(s.min for s in stats), max(s.max for s in stats)

    def latestOffset(self) -> dict:
        self._look()
        return {"id": max([self.since, *(high for _, high in self.ranges.values())])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._look()
        low, high = start["id"], end["id"]
        return [IdRange(p, low, high) for p, (a, b) in sorted(self.ranges.items()) if b > low and a <= high]

    def read(self, partition: IdRange) -> Iterator[pa.RecordBatch]:
        system, _ = _folder(self.path)
        with system.open_input_file(partition.path) as source:
            file = pq.ParquetFile(source)
            column = file.schema_arrow.get_field_index(NUMBER)
            for k in range(file.num_row_groups):
                stats = file.metadata.row_group(k).column(column).statistics
                if stats.max <= partition.low or stats.min > partition.high:
                    continue
                for batch in file.iter_batches(1 << 14, [k]):
                    number = batch.column(NUMBER)
                    chosen = pc.and_(pc.greater(number, partition.low), pc.less_equal(number, partition.high))
                    yield batch.filter(chosen).select(self.names)

    def commit(self, end: dict) -> None:
        pass


class PostsSince(DataSource):
    """``spark.readStream.format("posts_since_id")`` on a folder of ``save_numbered``. Options: ``path``;
    ``since``, the id after which a first run begins (all, unless given)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return f"id string, {NUMBER} bigint"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return SinceReader(schema, self.options)


def stream_since(
    spark: SparkSession, path: str, schema: StructType | str, since: int | None = None
) -> DataFrame:
    """Posts with an id above the newest one read before, which the checkpoint remembers; a batch takes
    all there are. A post that comes later with a smaller id is not read, as with any since-id poll."""
    spark.dataSource.register(PostsSince)
    reader = spark.readStream.format(NAME).schema(schema).option("path", path)
    return (reader if since is None else reader.option("since", str(since))).load()
