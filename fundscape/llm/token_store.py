"""Token ids in raw binary shards, found by key through a minimal perfect hash.

``write_store`` sorts rows by key over range partitions, encodes each text and writes
one shard per partition: ``<shard>.ids``, all ids of its rows one after another as
little-endian unsigned integers (2 bytes where the vocabulary fits, else 4), and
``<shard>.off``, the rows' first positions and the end as unsigned 64-bit integers.
``index`` holds one file per bucket of key hashes: a minimal perfect hash of the
bucket's distinct keys, and per key a 32-bit fingerprint, the number of its first row
and how many rows it has. ``read_keys`` goes key -> bucket -> slot -> row -> shard and
offset, each in constant time, without a search over keys.

Nulls: a null text is empty (only the end id is written); a null key is a key of its
own and sorts first. Repeated keys keep all their rows, next to each other. An absent key gives no row (a wrong
hit needs equal 32-bit fingerprints). Columns other than key and text are not read. An
empty table makes a store without shards. A text of any length is one row."""

from __future__ import annotations

import io
import json
import os
import re
import sys
import types
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscape.llm.common import open_file, partitions, read_file, stored, text_or_empty, write_file

SLICE = 512  # rows encoded at a time
CACHE = 500_000  # words, and pieces, remembered by a task
LONGEST = 64  # longer words and pieces are encoded each time

# The normalizer and pre-tokenizer that the shortcut below is written for.
KNOWN_NORMALIZER = ["NFC", "Replace", "Lowercase"]
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Texts of these characters only: ASCII, and Latin letters that are composed, have one
# lower-case letter each and are letters in every version of Unicode.
SIMPLE = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ſ]*")
LETTERS = "a-zß-öø-įı-ſ"
PRE_TOKENS = re.compile(f"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t\n\r\x200-9{LETTERS}]+")


class Words(dict):
    """Ids, as bytes, of the words asked for, by the tokenizer's own model."""

    def __init__(self, tokenizer, dtype: np.dtype):
        self.model, self.dtype, self.alphabet = tokenizer.model, dtype, tokenizer.pre_tokenizer[1]

    def __missing__(self, word: str) -> bytes:
        spelled = word if word.isascii() else self.alphabet.pre_tokenize_str(word)[0][0]
        ids = np.array([t.id for t in self.model.tokenize(spelled)], self.dtype).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Encodes whole texts with a ``tokenizers`` file.

    For a tokenizer that composes and lower-cases characters, splits at white space,
    letters, digits and other signs, and merges within such words only, the ids of a text
    are those of its words in order. Words repeat, so their ids come from the tokenizer's
    model once and are remembered. Texts with other than simple characters are taken by
    their space-separated pieces, which such a tokenizer never joins either, and pieces
    with other characters, or that could hold special tokens, are encoded as they are. Any
    other tokenizer encodes whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        config = json.loads(self.tokenizer.to_str())
        self.by_word = self._splits_at_words(config)
        self.words = Words(self.tokenizer, self.dtype) if self.by_word else {}
        self.pieces: dict[str, bytes] = {}

    @staticmethod
    def _splits_at_words(config: dict) -> bool:
        steps = (config.get("normalizer") or {}).get("normalizers", [])
        split, spell = ((config.get("pre_tokenizer") or {}).get("pretokenizers", []) + [{}, {}])[:2]
        model = config["model"]
        return (
            [x["type"] for x in steps] == KNOWN_NORMALIZER
            and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
            and (split.get("pattern"), split.get("behavior"), split.get("invert")) == ({"Regex": KNOWN_SPLIT}, "Removed", True)
            and (spell.get("type"), spell.get("add_prefix_space"), spell.get("use_regex")) == ("ByteLevel", False, False)
            and (model["type"], model.get("dropout"), config.get("truncation")) == ("BPE", None, None)
        )

    def _plain(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if "<|" not in piece and SIMPLE.fullmatch(piece):
                return b"".join(map(self.words.__getitem__, PRE_TOKENS.findall(piece.lower())))
            ids = self._plain(piece)
            if len(piece) <= LONGEST:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        """The ids of a text, as bytes."""
        if not self.by_word or "<|" in text:
            return self._plain(text)
        if SIMPLE.fullmatch(text):
            words = self.words
            return b"".join([words[w] for w in PRE_TOKENS.findall(text.lower())])
        return b"".join(map(self._piece, text.replace("\n", " ").split(" ")))


def encoder_of(path: str) -> Encoder:
    """This worker process's encoder of a file. Tasks get their functions anew, so it is
    held by a module of the process; its caches are bounded."""
    held = sys.modules.setdefault("fundscape_worker_cache", types.ModuleType("fundscape_worker_cache")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def key_hashes(key: str) -> list[Column]:
    """Two 64-bit hashes of a key; a null key has hashes of its own."""
    k = F.col(f"`{key}`").cast("string")
    return [F.xxhash64(F.lit(s), F.isnull(k), k) for s in (1, 2)]


def write_store(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> dict:
    """Encode and write all rows, build the index; returns the store's description.

    The description is a small dict (one entry per shard) that ``read_keys`` takes."""
    spark = docs.sparkSession
    rows = (
        docs.select(F.col(f"`{key}`").alias("key"), text_or_empty(F.col(f"`{text}`")).alias("text"))
        .repartitionByRange(partitions(spark), F.col("key").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text"))
        .select(*key_hashes("key"), "text")
        .toDF("h1", "h2", "text")
        .withColumn("pid", F.spark_partition_id())
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, offsets, pid = encoder_of(tokenizer), [0], None
        end = np.asarray([end_id], encode.dtype).tobytes()
        name = uuid.uuid4().hex
        pending: list[pa.RecordBatch] = []

        def chunks():
            nonlocal pid
            for batch in batches:
                for a in range(0, batch.num_rows, SLICE):
                    part = batch.slice(a, SLICE)
                    pid = part.column("pid")[0].as_py()
                    first = len(offsets) - 1
                    coded = [encode(t) for t in part.column("text").to_pylist()]
                    for c in coded:
                        offsets.append(offsets[-1] + len(c) // encode.dtype.itemsize + 1)
                    n = part.num_rows
                    pending.append(
                        pa.record_batch(
                            [own(part, "h1"), own(part, "h2"), own(part, "pid"),
                             pa.array(range(first, first + n), pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())],
                            names=["h1", "h2", "pid", "row", "file", "ids"],
                        )
                    )
                    yield b"".join([x for c in coded for x in (c, end)])

        write_file(f"{path}/{name}.ids", chunks())
        if pid is None:
            return
        write_file(f"{path}/{name}.off", [np.asarray(offsets, "<u8").tobytes()])
        yield from pending
        yield pa.record_batch(
            [pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([pid], pa.int32()),
             pa.array([len(offsets) - 1], pa.int64()), pa.array([name]), pa.array([offsets[-1]], pa.int64())],
            names=["h1", "h2", "pid", "row", "file", "ids"],
        )

    wrote = stored(rows.mapInArrow(write, "h1 long, h2 long, pid int, row long, file string, ids long"), f"{path}/rows")
    shards = sorted((r.pid, r.file, r.row, r.ids) for r in wrote.filter("file is not null").select("pid", "file", "row", "ids").collect())
    store = {"path": path, "width": encoder_of(tokenizer).dtype.itemsize, "files": [s[1] for s in shards], "row_base": [], "id_base": []}
    n_rows = n_ids = 0
    for _, _, rows_here, ids_here in shards:
        store["row_base"].append(n_rows)
        store["id_base"].append(n_ids)
        n_rows, n_ids = n_rows + rows_here, n_ids + ids_here
    store["rows"] = n_rows
    store["buckets"] = max(-(-n_rows // 500_000), min(-(-n_rows // 1024), 64), 1)
    bases = [0] * (max((s[0] for s in shards), default=0) + 1)
    for s, b in zip(shards, store["row_base"], strict=True):
        bases[s[0]] = b
    keys = wrote.filter("file is null").withColumn("row", F.col("row") + F.lit(bases)[F.col("pid")])
    keys = keys.groupBy("h1", "h2").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    _write_index(keys, store)
    return store


def own(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A numeric column as a copy that does not keep the rest of its batch in memory."""
    return pa.array(batch.column(name).to_numpy().copy(), batch.schema.field(name).type)


# -- minimal perfect hash -----------------------------------------------------------


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    x = h1 + h2 * np.uint64(2 * level + 1)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def build_mph(h1: np.ndarray, h2: np.ndarray) -> dict[str, np.ndarray]:
    """Levels of bit sets: a key takes the first level where it stands alone. A key's
    number is the count of bits before its own, so n keys get the numbers 0 to n - 1."""
    if len(np.unique(np.stack([h1, h2]), axis=1).T) != len(h1):
        raise ValueError("two keys share both 64-bit hashes")
    sizes, levels, left = [], [], np.arange(len(h1))
    while len(left):
        size = 2 * len(left) + 1
        at = _place(h1[left], h2[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        sizes.append(size)
        left = left[~alone[at]]
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    packed = np.packbits(np.pad(bits, (0, -len(bits) % 64)), bitorder="little").view("<u8")
    rank = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]) if len(packed) else np.zeros(0, np.int64)
    return {"sizes": np.asarray(sizes, np.int64), "bits": packed, "rank": rank.astype(np.int64)}


def find_slots(mph: dict[str, np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Each key's number; for a key outside the set any number, or -1."""
    slot, left, start = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for level, size in enumerate(mph["sizes"].tolist()):
        at = _place(h1[left], h2[left], level, size) + start
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        hit = (mph["bits"][word] >> bit) & np.uint64(1) == 1
        w, b = word[hit], bit[hit]
        slot[left[hit]] = mph["rank"][w] + np.bitwise_count(mph["bits"][w] & ((np.uint64(1) << b) - np.uint64(1)))
        left, start = left[~hit], start + size
    return slot


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("h1", "h2"), F.lit(buckets)).cast("int").alias("bucket")


def _fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return ((h1 * np.uint64(0xD6E8FEB86659FD93)) ^ h2).astype("<u4")


def _by_bucket(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", _bucket(buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket")


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Rows with equal values of an int column; they must follow one another."""
    held: list[pa.RecordBatch] = []
    value = None
    for batch in batches:
        values = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and values[a] != value:
                yield value, pa.Table.from_batches(held)
                held = []
            value = int(values[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield value, pa.Table.from_batches(held)


def _u8(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy().astype(np.int64).view(np.uint64)


def _write_index(keys: DataFrame, store: dict) -> None:
    path = store["path"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, t in _runs(batches, "bucket"):
            h1, h2 = _u8(t, "h1"), _u8(t, "h2")
            mph = build_mph(h1, h2)
            slot = find_slots(mph, h1, h2)
            first, n, fp = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64), np.zeros(len(h1), "<u4")
            first[slot], n[slot], fp[slot] = t.column("first").to_numpy(), t.column("n").to_numpy(), _fingerprint(h1, h2)
            out = io.BytesIO()
            np.savez(out, **mph, first=first, n=n, fp=fp)
            name = f"{uuid.uuid4().hex}.mph"
            write_file(f"{path}/{name}", [out.getvalue()])
            yield pa.record_batch([pa.array([bucket], pa.int32()), pa.array([name])], names=["bucket", "file"])

    made = stored(_by_bucket(keys, store["buckets"]).mapInArrow(build, "bucket int, file string"), f"{path}/index")
    store["index"] = {r.bucket: r.file for r in made.collect()}


def lookup(keys: DataFrame, store: dict, key: str = "doc_id") -> DataFrame:
    """``keys`` distinct keys -> key, row: one line per stored row of each key found."""
    path, index = store["path"], store["index"]
    hashed = keys.select(F.col(f"`{key}`").alias("key"), *key_hashes(key)).toDF("key", "h1", "h2")
    dtype = hashed.schema["key"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, t in _runs(batches, "bucket"):
            if bucket not in index:
                continue
            with np.load(io.BytesIO(read_file(f"{path}/{index[bucket]}"))) as z:
                mph = {k: z[k] for k in z.files}
            h1, h2 = _u8(t, "h1"), _u8(t, "h2")
            slot = find_slots(mph, h1, h2)
            ok = (slot >= 0) & (mph["fp"][np.maximum(slot, 0)] == _fingerprint(h1, h2))
            found = t.select(["key"]).filter(pa.array(ok))
            s = slot[ok]
            for name, values in (("first", mph["first"][s]), ("n", mph["n"][s])):
                found = found.append_column(name, pa.array(values))
            yield from found.combine_chunks().to_batches()

    hit = _by_bucket(hashed, store["buckets"]).mapInArrow(find, f"key {dtype}, first long, n long")
    return hit.select("key", F.explode(F.expr("sequence(first, first + n - 1)")).alias("row"))


def read_keys(keys: DataFrame, store: dict, key: str = "doc_id", wide: bool = False) -> DataFrame:
    """The stored rows of distinct ``keys``: key, row, start (ids before it in the whole
    store), n_tokens and ids (little-endian, ``width`` bytes each, 4 if ``wide``)."""
    path, width = store["path"], store["width"]
    files, row_base, id_base = store["files"], store["row_base"], store["id_base"]
    rows = lookup(keys, store, key)
    dtype = rows.schema["key"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, off, held, held_at = -1, None, None, b"", 0
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                start, count, raw = [], [], []
                for r in part.column("row").to_pylist():
                    s = bisect_right(row_base, r) - 1
                    while s + 1 < len(row_base) and row_base[s + 1] <= r:
                        s += 1
                    if s != shard:
                        if ids:
                            ids.close()
                        shard, held, held_at = s, b"", 0
                        ids, off = open_file(f"{path}/{files[s]}.ids"), np.frombuffer(read_file(f"{path}/{files[s]}.off"), "<u8")
                    i = r - row_base[s]
                    lo, hi = int(off[i]) * width, int(off[i + 1]) * width
                    if lo < held_at or hi > held_at + len(held):
                        ids.seek(lo)
                        held, held_at = ids.read(max(hi - lo, 1 << 20)), lo
                    got = held[lo - held_at : hi - held_at]
                    raw.append(np.frombuffer(got, "<u2").astype("<u4").tobytes() if wide and width == 2 else got)
                    start.append(id_base[s] + lo // width)
                    count.append((hi - lo) // width)
                yield pa.record_batch(
                    [part.column("key"), part.column("row"), pa.array(start, pa.int64()), pa.array(count, pa.int64()), pa.array(raw, pa.binary())],
                    names=["key", "row", "start", "n_tokens", "ids"],
                )
        if ids:
            ids.close()

    near = rows.repartitionByRange(partitions(keys.sparkSession), "row").sortWithinPartitions("row")
    return near.mapInArrow(read, f"key {dtype}, row long, start long, n_tokens long, ids binary").withColumnRenamed("key", key)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_digest(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs``, read every key back and give doc_id, start, n_tokens, ids_crc32."""
    store = write_store(docs, path, tokenizer, end_id)
    rows = read_keys(docs.select("doc_id").distinct(), store, wide=True)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
