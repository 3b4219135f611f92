"""What the operators share: word splitting, hashes, folds, Arrow batches, written tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from stockcast.session import materialize, run_folder, shared_folder

__all__ = [
    "Interned", "appended", "arrow_batches", "bucketed", "fold", "materialize", "on_batches", "owners", "quoted", "read_documents",
    "shared_folder", "words",
]

#: rows of an Arrow batch: texts can be long, so a batch stays a few MB in the usual case
BATCH_ROWS = 1000
#: words whose hash or score a task remembers
REMEMBERED_WORDS = 1 << 17


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(column: str, parts: int) -> Column:
    """crc32 of the value as text, modulo `parts`; a null value counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def words(text: str | None, lower: bool = True) -> list[bytes]:
    """Runs of bytes other than space and \\x09-\\x0D, with A-Z lower-cased if asked; bytes.split and
    bytes.lower act on ASCII alone, which is this definition."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class Interned(dict):
    """64-bit hash of each word, kept while the table is small: a word takes about 150 bytes, so a task's table stays at 20 MB."""

    LIMIT = REMEMBERED_WORDS

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def on_batches(frame: DataFrame, work, schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """`work` gets the Arrow batches of a partition one by one, of at most `rows` rows (the setting holds when the plan runs, so
    tables of large rows are written right away or last), and yields dicts of columns."""
    session = frame.sparkSession
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    names = [part.strip().split(" ")[0] for part in _split(schema)]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for made in work(parts):
            if target is None:
                target = arrow_schema(schema)
            yield pa.RecordBatch.from_arrays(
                [_array(made[name], target.field(name).type) for name in names], schema=target
            )

    return frame.mapInArrow(_giving_back(run), schema)


def appended(frame: DataFrame, column: str, name: str, kind: str, start) -> DataFrame:
    """`frame` with one more column, made from `column`; all others pass through untouched. start() is called once per task and
    returns what maps a list of values to a list of results."""
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    at, target = frame.columns.index(column), KINDS[kind]
    schema = StructType([*frame.schema.fields, StructField(name, _parse_datatype_string(kind))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = start()
        for batch in parts:
            new = pa.array(made(batch.column(at).to_pylist()), target)
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, name])

    return frame.mapInArrow(_giving_back(run), schema)


def arrow_batches(frame: DataFrame, work, schema: StructType, rows: int) -> DataFrame:
    """`work` maps the Arrow batches of a partition, of at most `rows` rows, to batches of `schema`."""
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return frame.mapInArrow(_giving_back(work), schema)


def _giving_back(work):
    """`work`; after its last batch the task gives Arrow's unused memory back, which a reused worker would hold on to."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(parts)
        pa.default_memory_pool().release_unused()

    return run


def bucketed(frame: DataFrame, key: str, buckets: int) -> DataFrame:
    """Write `frame` to the shared folder in buckets by `key`, without an exchange, and go on from there: a join by `key` then needs
    none of these rows to move. The catalog's entry goes at once; the files stay with the run's other tables."""
    session, name = frame.sparkSession, f"stockcast_{uuid.uuid4().hex}"
    frame.write.bucketBy(buckets, key).option("path", f"{run_folder(session)}/{name}").saveAsTable(name, format="parquet")
    table = session.table(name)
    session.sql(f"DROP TABLE {name}")
    return table


def quoted(name: str) -> str:
    """The name of a column, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def _array(values: Any, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _split(schema: str) -> list[str]:
    depth, parts, now = 0, [], ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(now)
            now = ""
        else:
            now += c
    return [*parts, now]


KINDS = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
    "boolean": pa.bool_(),
}


def arrow_schema(schema: str) -> pa.Schema:
    fields = []
    for part in _split(schema):
        name, kind = part.strip().split(" ")
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append((name, pa.list_(KINDS[inner]) if kind.startswith("array<") else KINDS[kind]))
    return pa.schema(fields)


def packed(values: np.ndarray) -> bytes:
    """The array's bytes, compressed: large arrays travel as one value of a row."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, kind: Any) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def owners(session: SparkSession) -> int:
    """How many hash owners a packed exchange uses: the session's shuffle partitions."""
    return int(session.conf.get("spark.sql.shuffle.partitions"))


def chunks(values: list, size: int) -> Iterable[list]:
    return (values[i : i + size] for i in range(0, len(values), size))
