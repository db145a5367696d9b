"""Large JSON array files, read by many tasks."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 24
BLANKS = b" \t\r\n"
QUOTE, ESCAPE, COMMA = b'"\\,'
OPEN, CLOSE = (b"["[0], b"{"[0]), (b"]"[0], b"}"[0])


def _opened(path: str):
    """A file by its address, whichever way its scheme is written."""
    scheme, _, rest = path.partition(":")
    address = f"{scheme}:///{rest.lstrip('/')}" if scheme == "file" else path
    system, name = fs.FileSystem.from_uri(address)
    return system.open_input_file(name)


class Lexed:
    """What a part of a JSON text holds besides the contents of its strings.

    ``escaped`` says whether the byte before the part escapes its first byte, ``inside`` whether the
    part starts within a string.
    """

    def __init__(self, part: bytes, escaped: bool, inside: bool = False):
        b = np.frombuffer(part, np.uint8)
        at = np.arange(len(b))
        slash = b == ESCAPE
        # A byte is escaped by an odd run of backslashes before it.
        last_other = np.maximum.accumulate(np.where(slash, -1 - int(escaped), at)) if len(b) else at
        before = np.concatenate(([-1 - int(escaped)], last_other[:-1])) if len(b) else at
        free = (at - 1 - before) % 2 == 0
        quotes = (b == QUOTE) & free
        self.turns = int(quotes.sum())
        self.outside = (np.cumsum(quotes) % 2 == int(inside)) & ~quotes
        self.step = np.zeros(len(b), np.int64)
        self.step[np.isin(b, OPEN)] = 1
        self.step[np.isin(b, CLOSE)] = -1
        self.bytes = b

    def delta(self, inside: bool) -> int:
        """How much deeper the part ends if it starts within a string or not."""
        return int(self.step[self.outside != inside].sum())

    def borders(self, depth: int) -> np.ndarray:
        """Places of the array's own bracket that opens, its commas, and its bracket that closes."""
        step = np.where(self.outside, self.step, 0)
        level = depth + np.cumsum(step)
        opens, closes = (step == 1) & (level == 1), (step == -1) & (level == 0)
        return np.flatnonzero(opens | closes | (self.outside & (self.bytes == COMMA) & (level == 1)))


def _escaped(file, at: int) -> bool:
    """Whether the byte at a place is escaped by those before it."""
    run = 0
    while at - run > 0:
        size = min(at - run, 1 << 10)
        part = file.read_at(size, at - run - size)
        kept = part.rstrip(b"\\")
        run += len(part) - len(kept)
        if kept:
            break
    return run % 2 == 1


def array_elements(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``value``: the JSON text of each element of array files, or of a file that holds one value.

    A file is cut into byte ranges. Each range is looked at once by a task, which says what it does to
    the nesting if it starts within a string and if it does not; going through these few numbers of a
    file tells how each range starts. Then each range gives the elements that begin in it, reading on
    past its end for the last one. So no task holds a file, and an element that is no valid JSON costs
    itself only, as long as its brackets and quotes are in pairs. Empty arrays and blank files give no
    rows. Paths are opened by pyarrow's file systems on the workers.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(chunk_bytes).cast("long"))
    ranges = files.select("path", "length", F.explode(starts).alias("first"))
    parts = max(1, min(ranges.count(), 4 * spark.sparkContext.defaultParallelism))
    ranges = ranges.repartition(parts, "path", "first")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                with _opened(row["path"]) as file:
                    part = file.read_at(chunk_bytes, row["first"])
                    lexed = Lexed(part, _escaped(file, row["first"]))
                lead = part.lstrip(BLANKS)[:1]
                out.append(row | {"turns": lexed.turns, "plain": lexed.delta(False), "quoted": lexed.delta(True),
                                  "lead": lead.decode("latin-1") or None})
            yield pa.RecordBatch.from_pylist(out, batch_schema)

    names = [("path", pa.string()), ("length", pa.int64()), ("first", pa.int64()), ("turns", pa.int64()),
             ("plain", pa.int64()), ("quoted", pa.int64()), ("lead", pa.string())]
    batch_schema = pa.schema(names)
    seen = ranges.mapInArrow(
        look, "path string, length long, first long, turns long, plain long, quoted long, lead string"
    )

    def started(chunks: pd.DataFrame) -> pd.DataFrame:
        """How each range of one file starts: within a string, and how deep."""
        chunks = chunks.sort_values("first")
        leads = [x for x in chunks["lead"] if x is not None]
        array = bool(leads) and leads[0] == "["
        inside, depth, out = False, 0, []
        for turns, plain, quoted in zip(chunks["turns"], chunks["plain"], chunks["quoted"]):
            out.append((inside, depth))
            depth += quoted if inside else plain
            inside ^= bool(turns % 2)
        chunks["inside"], chunks["depth"] = zip(*out)
        chunks["array"] = array
        return chunks[["path", "length", "first", "inside", "depth", "array"]] if leads else chunks.iloc[:0][
            ["path", "length", "first", "inside", "depth", "array"]
        ]

    known = seen.groupBy("path").applyInPandas(
        started, "path string, length long, first long, inside boolean, depth long, array boolean"
    )

    def elements(row: dict) -> Iterator[bytes]:
        with _opened(row["path"]) as file:
            if not row["array"]:
                if row["first"] == 0:
                    yield file.read_at(row["length"], 0)
                return
            first, size = row["first"], chunk_bytes
            escaped = _escaped(file, first)
            part = file.read_at(size, first)
            places = Lexed(part, escaped, row["inside"]).borders(row["depth"])
            own = places[places < chunk_bytes]
            # The last element that begins here ends at the first border further on.
            while len(own) and len(places) == len(own) and first + len(part) < row["length"]:
                size *= 2
                part = file.read_at(size, first)
                places = Lexed(part, escaped, row["inside"]).borders(row["depth"])
            for k in range(len(own)):
                if part[places[k]] in CLOSE:
                    continue
                end = places[k + 1] if k + 1 < len(places) else len(part)
                value = part[places[k] + 1 : end].strip(BLANKS)
                opens_empty = part[places[k]] in OPEN and (end == len(part) or part[end] in CLOSE)
                if value or not opens_empty:
                    yield value or b"null"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found: list[str] = []
                for value in elements(row):
                    found.append(value.decode("utf-8", "replace"))
                    if len(found) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["value"])
                        found = []
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["value"])

    return known.repartition(parts, "path", "first").mapInArrow(read, "value string")
