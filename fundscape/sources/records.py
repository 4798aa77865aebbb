"""Records of large single files, cut by many tasks.

A quoted CSV record may hold line breaks, and a JSON document that is one list or map has no
lines at all, so a task that starts in the middle of a file does not know what it is in. Files are
read in ranges, as pieces between line breaks or commas, twice. First each range is summed up:
whether its quotes leave a string open, and how much deeper it ends, for either state it may
start in. Running sums over the ranges of a file then tell each range where it starts. The second
pass cuts the pieces where no quote is open and, in a document, only the outer bracket is.

Records within a range leave it whole. A record over the end of a range leaves as fragments, at most
two a range, which are put together by the range they begin in. Texts are not shuffled, fragments are."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscape.session import stored

# The functions below run in tasks and travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_RANGES = 100_000  # whose states are broadcast, about 20 MB; more are joined by sorting
WHOLE, HEAD, TAIL, MIDDLE = range(4)  # a record, the end of one, the start of one, neither

# What a piece does: whether it turns "in a string", and by how much it deepens from outside and from inside one.
Effects = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def csv_effects(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Doubled quotes cancel out; there is no depth."""
    turns = pc.count_substring(pieces, '"').to_numpy(zero_copy_only=False) % 2
    none = np.zeros(len(turns), np.int64)
    return turns, none, none


def json_effects(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Escaped characters do not count, brackets only outside strings."""

    def count(texts: pa.Array, *marks: str) -> np.ndarray:
        return sum(pc.count_substring(texts, m).to_numpy(zero_copy_only=False).astype(np.int64) for m in marks)

    def deeper(texts: pa.Array) -> np.ndarray:
        outside = pc.replace_substring_regex(texts, '(?s)"[^"]*("|$)', "")
        return count(outside, "[", "{") - count(outside, "]", "}")

    plain = pc.replace_substring_regex(pieces, r"(?s)\\.", "")
    inside = pc.replace_substring_regex(plain, '(?s)^[^"]*("|$)', "")
    return count(plain, '"') % 2, deeper(plain), deeper(inside)


def _by_range(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The parts of a batch that belong to one range of a file."""
    if not batch.num_rows:
        return
    file = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    block = batch.column("block").to_numpy()
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        part = batch.slice(a, b - a)
        yield (part.column("file")[0].as_py(), int(block[a])), part


def _summed(effects: Effects) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, turned, depth, out = None, 0, [0, 0], []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            made = pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "block", "turned", "outside", "inside"])
            out.clear()
            return made

        for batch in batches:
            for key, part in _by_range(batch):
                if key != at:
                    if at:
                        out.append((*at, turned, *depth))
                    at, turned, depth = key, 0, [0, 0]
                turns, outer, inner = effects(part.column("value"))
                state = (turned + np.cumsum(turns) - turns) % 2  # before each piece, from outside a string
                depth[0] += int(np.where(state == 0, outer, inner).sum())
                depth[1] += int(np.where(state == 0, inner, outer).sum())
                turned = int(turned + turns.sum()) % 2
            yield flush()
        if at:
            out.append((*at, turned, *depth))
        yield flush()

    return run


def _glued(effects: Effects, separator: str) -> Callable:
    """Rows (file, block, n, kind, last, record) of the pieces with their range's ``state`` and
    ``depth``. A record ends where no string is open and the depth is at most 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, depth, n, begun, held = None, 0, 0, 0, False, []

        def rows(records: pa.Array, kinds: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
            m = len(records)
            columns = [pa.array([at[0]] * m, pa.string()), pa.array([at[1]] * m, pa.int64()), pa.array(np.arange(n, n + m)), pa.array(kinds, pa.int32()), pa.array(last), records]
            return pa.record_batch(columns, names=["file", "block", "n", "kind", "last", "record"])

        def rest() -> Iterator[pa.RecordBatch]:
            if held:
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, sum(map(len, held))], pa.int32()), pa.concat_arrays(held)), separator)
                kind = MIDDLE if begun and not n else TAIL
                yield rows(text, np.asarray([kind]), np.asarray([False]))
                held.clear()

        for batch in batches:
            for key, part in _by_range(batch):
                if key != at:
                    yield from rest()
                    at, n = key, 0
                    state, depth = part.column("state")[0].as_py(), part.column("depth")[0].as_py()
                    begun = key[1] > 0 and (state == 1 or depth > 1)
                values = part.column("value")
                turns, outer, inner = effects(values)
                after = (state + np.cumsum(turns)) % 2
                deep = depth + np.cumsum(np.where((after + turns) % 2 == 0, outer, inner))
                state, depth = int(after[-1]), int(deep[-1])
                ends = np.flatnonzero((after == 0) & (deep <= 1))
                if not len(ends):
                    held.append(values)
                    continue
                first = sum(map(len, held))
                pieces = pa.concat_arrays([*held, values.slice(0, int(ends[-1]) + 1)])
                offsets = pa.array(np.r_[0, ends + 1 + first], pa.int32())
                records = pc.binary_join(pa.ListArray.from_arrays(offsets, pieces), separator)
                kinds = np.full(len(ends), WHOLE)
                if begun and not n:
                    kinds[0] = HEAD
                yield rows(records, kinds, deep[ends] == 0)
                n += len(ends)
                held.clear()
                if ends[-1] + 1 < len(values):
                    held.append(values.slice(int(ends[-1]) + 1))
        yield from rest()

    return run


def cut_records(
    spark: SparkSession, path: str, separator: str, effects: Effects, most_ranges: int = MOST_RANGES, made: Column | None = None
) -> DataFrame:
    """file, first (the file's first record), last (closes its document), record. With ``made``, an expression of
    ``record``, its value ``made`` takes the record's place: only that is stored, and it is found once."""
    text = spark.read.text(path, lineSep=separator)
    pieces = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    sums = pieces.mapInArrow(_summed(effects), "file string, block long, turned long, outside long, inside long")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("state", F.coalesce(F.sum("turned").over(before), F.lit(0)) % 2)
    starts = starts.withColumn("deeper", F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside")))
    starts = starts.select("file", "block", "state", F.coalesce(F.sum("deeper").over(before), F.lit(0)).alias("depth"))
    starts = stored(starts, "ranges")

    if starts.count() <= most_ranges:
        placed = pieces.join(F.broadcast(starts), ["file", "block"])  # pieces stay in order
    else:
        placed = pieces.withColumn("_at", F.monotonically_increasing_id()).join(starts.hint("merge"), ["file", "block"])
        placed = placed.repartition("file", "block").sortWithinPartitions("file", "block", "_at")
    placed = placed.select("file", "block", "value", F.col("state").cast("long"), F.col("depth").cast("long"))
    cut = placed.mapInArrow(_glued(effects, separator), "file string, block long, n long, kind int, last boolean, record string")
    if made is not None:
        is_whole = F.col("kind") == WHOLE
        cut = cut.select("file", "block", "n", "kind", "last", F.when(~is_whole, F.col("record")).alias("record"), F.when(is_whole, made).alias("made"))
    cut = stored(cut, "records", "zstd")

    found = "record" if made is None else "made"
    whole = cut.filter(F.col("kind") == WHOLE).select("file", ((F.col("block") == 0) & (F.col("n") == 0)).alias("first"), "last", found)
    upto = W.partitionBy("file").orderBy("block", "n").rowsBetween(W.unboundedPreceding, 0)
    parts = cut.filter(F.col("kind") != WHOLE).withColumn("begin", F.max(F.when(F.col("kind") == TAIL, F.col("block"))).over(upto))
    listed = F.sort_array(F.collect_list(F.struct("block", "n", "record")))
    glued = parts.groupBy("file", "begin").agg(
        F.array_join(F.transform(listed, lambda p: p["record"]), separator).alias("record"), F.max("last").alias("last"),
        F.max((F.col("kind") == TAIL) & (F.col("block") == 0) & (F.col("n") == 0)).alias("first"),
    )
    if made is not None:
        glued = glued.withColumn("made", made)
    return whole.unionByName(glued.select("file", "first", "last", found))


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str], most_ranges: int = MOST_RANGES) -> DataFrame:
    """A CSV table whose quoted fields may hold line breaks, large files read by many tasks. Each
    file starts with a header. Quotes stand only around fields and, doubled, inside quoted ones."""
    line = F.regexp_replace("record", "\r$", "")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(line, fields, {**options, "header": "false", "multiLine": "true"})
    made = F.struct((line != "").alias("kept"), parsed.alias("row"))
    rows = cut_records(spark, path, "\n", csv_effects, most_ranges, made).filter("NOT first AND made.kept").select("made.row")
    return rows.select(*[F.col("row").getField(f.name).alias(f.name) for f in schema.fields])


def read_json_elements(spark: SparkSession, path: str, most_ranges: int = MOST_RANGES) -> DataFrame:
    """The elements of files that are one JSON list or map each, as text (``value``): the items of a list,
    the ``"key": value`` entries of a map. White space around them is dropped."""
    found = cut_records(spark, path, ",", json_effects, most_ranges)
    text = F.when(F.col("first"), F.regexp_replace("record", r"^\s*[\[{]", "")).otherwise(F.col("record"))
    text = F.when(F.col("last"), F.regexp_replace(text, r"[\]}]\s*$", "")).otherwise(text)
    return found.select(F.regexp_replace(text, r"^\s+|\s+$", "").alias("value")).filter("value <> ''")
