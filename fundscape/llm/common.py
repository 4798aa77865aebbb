"""Shared folders, stored tables and files that every executor reaches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# White space and words as the query contracts define them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

PIECE = 4 << 20  # bytes split into words at a time

# Lower-cases A-Z and turns every byte outside words into a space.
TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``. A local session without that
    setting gets one temporary folder per process; a cluster must have it set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if "dir" not in _own:
            _own["dir"] = tempfile.mkdtemp(prefix="fundscape-llm-")
        base = _own["dir"]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it again: cuts lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores after it while ``df`` has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def write_file(uri: str, chunks: Iterable[bytes]) -> int:
    """Write chunks to a new file, return its size."""
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    size = 0
    with store.open_output_stream(path, compression=None) as out:
        for c in chunks:
            out.write(c)
            size += len(c)
    return size


def open_file(uri: str):
    """A file with random access: ``seek``, ``read``, ``size``."""
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def read_file(uri: str) -> bytes:
    with open_file(uri) as f:
        return f.read()


def with_struct(df: DataFrame, text: str, name: str, fields: str, compute: Callable[[list[str | None]], list[tuple]], slice_bytes: int = 4 << 20) -> DataFrame:
    """``df`` and a struct column of ``fields`` (DDL), which ``compute`` makes from some
    texts at a time. Rows stay where they are; the struct's name gets underscores after it
    while it is taken."""
    at, n = df.columns.index(text), len(df.columns)
    struct = T._parse_datatype_string(f"struct<{fields}>")
    plain = df.toDF(*[f"_{i}" for i in range(n)])
    arrow = to_arrow_type(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_ranges(batch.column(at), slice_bytes):
                part = batch.slice(a, b - a)
                rows = compute(part.column(at).to_pylist())
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
                made = pa.StructArray.from_arrays(columns, fields=list(arrow))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[f"_{i}" for i in range(n + 1)])

    schema = T.StructType([*plain.schema.fields, T.StructField(f"_{n}", struct)])
    return plain.mapInArrow(run, schema).toDF(*df.columns, free_name(df, name))


def row_ranges(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text; a longer text is a range of its own."""
    first, size = 0, 0
    for i in range(len(texts)):
        n = texts[i].as_buffer().size if texts[i].is_valid else 0
        if size and size + n > most:
            yield first, i
            first, size = i, 0
        size += n
    if len(texts) > first:
        yield first, len(texts)


def words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    data, at = (text or "").encode().translate(TABLE), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
