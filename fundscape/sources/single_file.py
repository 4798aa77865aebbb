"""One file written by many tasks.

Spark's writers give one file per task, so a single file by them is written by one task, which reads
the whole table. Here tasks write parts, and other tasks put them together: each fills one block of the
file with the bytes of the parts that lie there. Blocks begin at multiples of their size, so no
two tasks write to one page, and a task's second try writes the same bytes again."""

from __future__ import annotations

import os
import re
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscape.sources.tables import CSV_OPTIONS

# The functions below run in tasks and travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 64 << 20
CHUNK = 4 << 20  # read at a time
FORMATS = ("csv", "json", "text")  # whose files can be joined end to end


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and sizes of the files of a written table that are not empty, in the order of its partitions."""
    found = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0").collect()
    number = re.compile(r"part-(\d+)-.*?(?:-c(\d+))?\.[^/]*$")
    return sorted(map(tuple, found), key=lambda f: [int(n or 0) for n in number.search(f[0]).groups()])


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """Where ``path`` is on the local file system, if it is, as told by a file that Spark writes into it."""
    spark.range(1).write.csv(f"{path}/_parts/place")
    name = _files(spark, f"{path}/_parts/place")[0][0]
    return name.removeprefix("file:").rsplit("/", 3)[0] if name.startswith("file:") else None


def _filled(target: str, parts: list[str], starts: list[int], block: int) -> Callable:
    """Rows (written) of the blocks given by their numbers. ``starts`` ends with the file's size."""

    def fill(number: int) -> int:
        first = at = number * block
        end = min(first + block, starts[-1])
        with open(target, "r+b") as out:
            out.seek(at)
            while at < end:
                i = bisect_right(starts, at) - 1
                with open(parts[i], "rb") as part:
                    part.seek(at - starts[i])
                    upto = min(end, starts[i + 1])
                    while at < upto:
                        data = part.read(min(upto - at, CHUNK))
                        if not data:
                            raise OSError(f"{parts[i]} has become shorter")
                        out.write(data)
                        at += len(data)
        return at - first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([fill(k) for k in batch.column(0).to_pylist()], pa.int64())], names=["written"])

    return run


def write_single_file(df: DataFrame, path: str, fmt: str = "csv", block: int = BLOCK) -> None:
    """Write all rows to one file in the new folder ``path``, in the order of the partitions of ``df``; a CSV
    file has one header. The bytes are those of Spark's own writer.

    Parts stay beside the file in ``_parts``, which Spark's readers pass over. Blocks are written in place, which
    folders shared as local ones allow (``file:``). Other stores do not: there one task writes the file."""
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    spark = df.sparkSession
    options = {"compression": "none", **(CSV_OPTIONS if fmt == "csv" else {})}
    folder = _local_folder(spark, path)
    if not folder:
        df.coalesce(1).write.options(**options).mode("append").format(fmt).save(path)
        return
    parts = []
    if fmt == "csv":
        df.limit(0).write.options(**options).format(fmt).save(f"{path}/_parts/head")
        parts += _files(spark, f"{path}/_parts/head")
    df.write.options(**{**options, "header": "false"}).format(fmt).save(f"{path}/_parts/rows")
    parts += _files(spark, f"{path}/_parts/rows")
    starts = [0, *accumulate(size for _, size in parts)]
    target = f"{folder}/part-00000.{'txt' if fmt == 'text' else fmt}"
    open(target, "xb").close()
    blocks = -(-starts[-1] // block)
    if blocks:
        fill = _filled(target, [name.removeprefix("file:") for name, _ in parts], starts, block)
        written = spark.range(0, blocks, 1, blocks).mapInArrow(fill, "written long").agg(F.sum("written")).first()[0]
        if (written, os.path.getsize(target)) != (starts[-1], starts[-1]):
            raise OSError(f"{target} is not whole: do driver and executors share the folder?")
