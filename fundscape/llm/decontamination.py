"""Benchmark decontamination with suffix arrays over the training texts.

Each task cuts its documents into shards, numbers a shard's words, builds one suffix array of
them and binary-searches in it every suffix of every benchmark item for its longest verbatim match.
A suffix that matches at least ``window`` words (an item of fewer words: all of them) gives
the range of places where its window occurs. Words of a document that lie in an occurrence are
hit; a document with a hit is contaminated, and lists the longest matches that were found in
it. Whole documents are in one shard, so results need no shuffle, and removal is a filter.

The benchmark is written once, in blocks of at most about ``BLOCK_WORDS`` words, to the
shared folder; a task holds one block at a time and goes through them all. Words that no
block has cannot be part of a match, nor can runs of other words shorter than the
shortest window; both are left out of the suffix array, which changes no match.

Nulls: a null text has no words. An item without words has no windows; an item with null
id counts for hits but has no id to list; items with one id count as one. Null, repeated
or clashing columns of documents pass through untouched: the result is their columns and a
struct ``leak`` (with underscores after it while the name is taken). Empty tables give no
rows, or no hits. Texts of any length are read whole."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.llm.common import read_file, shared_dir, stored, with_struct, words, write_file

WINDOW = 10
BLOCK_WORDS = 200_000
SHARD_BYTES = 16 << 20  # of text; one longer text is a shard of its own


# -- benchmark blocks ----------------------------------------------------------------


def write_blocks(benchmark: DataFrame, path: str, id_col: str, text: str) -> list[tuple[str, int, int]]:
    """Deal items to blocks by hash; returns the blocks' files with the lengths of their
    shortest and longest items. Beside each file lies one with the block's distinct words."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // (BLOCK_WORDS * 6)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list] = {}
        for b in batches:
            for block, i, t in zip(b.column("block").to_pylist(), b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                found = [w.decode() for ws in words(t) for w in ws]
                if found:
                    blocks.setdefault(block, []).append((i, found))
        for rows in blocks.values():
            name = f"{path}/{uuid.uuid4().hex}.json"
            write_file(name, [json.dumps(rows).encode()])
            write_file(f"{name}.words", ["\n".join({w for r in rows for w in r[1]}).encode()])
            sizes = [len(r[1]) for r in rows]
            yield pa.record_batch([pa.array([name]), pa.array([min(sizes)]), pa.array([max(sizes)])], names=["file", "least", "most"])

    dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int")).repartition(n, "block")
    made = stored(dealt.mapInArrow(write, "file string, least long, most long"), f"{path}/blocks")
    return sorted(tuple(r) for r in made.collect())


class Block:
    """A block's items one after another as word numbers, a 0 after each, and the suffixes that hold a window."""

    def __init__(self, file: str, window: int):
        rows = json.loads(read_file(file))
        numbers: dict[str, int] = defaultdict(count(1).__next__)
        self.ids = [r[0] for r in rows]
        sizes = np.asarray([len(r[1]) for r in rows])
        self.flat = np.fromiter((n for r in rows for n in (*map(numbers.__getitem__, r[1]), 0)), np.int32, int((sizes + 1).sum()))
        self.vocabulary = [w.encode() for w in numbers]
        least = np.minimum(sizes, window)
        suffixes = sizes - least + 1
        self.item = np.repeat(np.arange(len(rows)), suffixes)
        self.item_at = np.arange(len(self.item)) - np.repeat(np.cumsum(suffixes) - suffixes, suffixes)
        self.at = np.repeat(np.cumsum(sizes + 1) - sizes - 1, suffixes) + self.item_at
        self.least = np.repeat(least, suffixes)
        # Equal windows have one number, and the ids of all items that hold them.
        self.holders: list[set[str]] = []
        seen: dict[bytes, int] = {}
        self.window = np.empty(len(self.at), np.int64)
        for i, (a, k, item) in enumerate(zip(self.at.tolist(), self.least.tolist(), self.item.tolist(), strict=True)):
            w = self.window[i] = seen.setdefault(self.flat[a : a + k].tobytes(), len(seen))
            if w == len(self.holders):
                self.holders.append(set())
            if self.ids[item] is not None:
                self.holders[w].add(self.ids[item])


# -- suffix array --------------------------------------------------------------------


class Suffixes:
    """Sorted suffixes of a word-id sequence; 0 ends every run and matches nothing.

    ``least``: runs shorter than this are left out. ``depth``: suffixes are in order of
    at least their first ``depth`` words, which is all that a search for so many needs."""

    def __init__(self, sequence: np.ndarray, least: int, depth: int):
        known = sequence > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        enough = ends - starts >= least
        starts, ends = starts[enough], ends[enough]
        lengths = ends - starts
        # Kept runs one after another, a 0 after each.
        base = np.cumsum(np.concatenate([[0], lengths[:-1] + 1])) if len(starts) else np.zeros(0, np.int64)
        n = int((lengths + 1).sum())
        self.words = np.zeros(n + 1, np.int32)
        inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        to, source = np.repeat(base, lengths) + inside, np.repeat(starts, lengths) + inside
        self.words[to] = sequence[source]
        self.origin = np.full(n + 1, -1, np.int64)
        self.origin[to] = source
        rank, h, ranks = self.words.astype(np.int64), 1, 0
        reach = min(depth, int(lengths.max(initial=0)))
        while h < reach and ranks < len(to):
            ahead = np.zeros_like(rank)
            ahead[:-h] = rank[h:]
            ahead[rank == 0] = 0
            key = rank * (int(rank.max()) + 1) + ahead
            kinds, place = np.unique(key[to], return_inverse=True)
            rank[to], ranks = place + 1, len(kinds)
            h *= 2
        self.order = to[np.argsort(rank[to], kind="stable")]

    def compare(self, queries: np.ndarray, at: np.ndarray, places: np.ndarray, most: np.ndarray | None = None, above: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """For each query (a place in the flat, 0-ended ``queries``) and suffix: whether
        the suffix is less, and how many words they share. Where ``most`` words are given
        and shared, the suffix is less if ``above``."""
        shared = np.zeros(len(at), np.int64)
        left = np.arange(len(at))
        less = np.zeros(len(at), bool)
        while len(left):
            if most is not None:
                full = shared[left] == most[left]
                less[left[full]] = above
                left = left[~full]
            q, s = queries[at[left] + shared[left]], self.words[places[left] + shared[left]]
            same = (q == s) & (q > 0)
            done = left[~same]
            less[done] = s[~same] < q[~same]
            left = left[same]
            shared[left] += 1
        return less, shared

    def insertion(self, queries: np.ndarray, at: np.ndarray, most: np.ndarray | None = None, above: bool = False) -> np.ndarray:
        """Binary search: for each query the number of suffixes that are less."""
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(self.order), np.int64)
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            less, _ = self.compare(queries, at[open_], self.order[mid], None if most is None else most[open_], above)
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        return lo

    def ranges(self, queries: np.ndarray, at: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-last suffix that begins with the first ``most`` words of each query."""
        return self.insertion(queries, at, most), self.insertion(queries, at, most, above=True)

    def longest(self, queries: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the length of its longest match and a place of it."""
        where = self.insertion(queries, at)
        best, place = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
        for side in (where - 1, where):
            ok = (side >= 0) & (side < len(self.order))
            _, shared = self.compare(queries, at[ok], self.order[side[ok]])
            better = shared > best[ok]
            rows = np.flatnonzero(ok)[better]
            best[rows], place[rows] = shared[better], self.origin[self.order[side[ok]][better]]
        return best, place


# -- documents -----------------------------------------------------------------------


def sequence_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, dict[bytes, int]]:
    """Word numbers of all texts, a 0 after each text, the texts' first places, and the words' numbers."""
    numbers: dict[bytes, int] = defaultdict(count(1).__next__)
    parts, starts, at = [], [], 0
    for t in texts:
        starts.append(at)
        for ws in words(t):
            parts.append(np.fromiter(map(numbers.__getitem__, ws), np.int32, len(ws)))
            at += len(ws)
        parts.append(np.zeros(1, np.int32))
        at += 1
    return np.concatenate(parts), np.asarray(starts), numbers


def search_shard(texts: list[str | None], blocks: list[tuple[str, int, int]], window: int, cache: dict[str, Block]) -> list[tuple]:
    """n_words, n_hit, items and matches of each text."""
    sequence, starts, numbers = sequence_of(texts)
    hits = np.zeros(len(sequence) + 1, np.int32)
    items: list[set[str]] = [set() for _ in texts]
    matches: list[list[tuple]] = [[] for _ in texts]
    known = np.zeros(len(numbers) + 1, bool)
    for file, *_ in blocks:
        for w in cache[file].vocabulary if file in cache else read_file(f"{file}.words").split(b"\n"):
            known[numbers.get(w, 0)] = True
    known[0] = False
    if known.any():
        least, most = min(b[1] for b in blocks), max(b[2] for b in blocks)
        found = Suffixes(np.where(known[sequence], sequence, 0), min(least, window), most)
        for file, *_ in blocks:
            if file not in cache:
                cache.clear()
                cache[file] = Block(file, window)
            search_block(found, cache[file], numbers, starts, hits, items, matches)
    ends = np.concatenate([starts[1:], [len(sequence)]])
    hit = np.concatenate([[0], np.cumsum(np.cumsum(hits[:-1]) > 0)])
    n_words, n_hit = (ends - starts - 1).tolist(), (hit[ends] - hit[starts]).tolist()
    return [(n, h, sorted(i), m) for n, h, i, m in zip(n_words, n_hit, items, matches, strict=True)]


def search_block(found: Suffixes, block: Block, numbers: dict[bytes, int], starts: np.ndarray, hits: np.ndarray, items: list[set[str]], matches: list[list[tuple]]) -> None:
    """Search the block's suffixes and note what they match."""
    own = np.fromiter((numbers.get(w, 0) for w in [b"", *block.vocabulary]), np.int32, len(block.vocabulary) + 1)
    flat = own[block.flat]
    # A suffix whose window has a word that the shard lacks matches nowhere.
    gaps = np.flatnonzero(flat == 0)
    able = np.flatnonzero(gaps[np.searchsorted(gaps, block.at)] - block.at >= block.least)
    length, place = found.longest(flat, block.at[able])
    matched = length >= block.least[able]
    able, length, place = able[matched], length[matched], place[matched]
    docs = np.searchsorted(starts, place, side="right") - 1
    for i, n, p, d in zip(able.tolist(), length.tolist(), place.tolist(), docs.tolist(), strict=True):
        matches[d].append((block.ids[block.item[i]], int(block.item_at[i]), n, p - int(starts[d])))
    windows, first = np.unique(block.window[able], return_index=True)
    at, size = block.at[able[first]], block.least[able[first]]
    lo, hi = found.ranges(flat, at, size)
    for w, a, b, k in zip(windows.tolist(), lo.tolist(), hi.tolist(), size.tolist(), strict=True):
        places = found.origin[found.order[a:b]]
        np.add.at(hits, places, 1)
        np.add.at(hits, places + k, -1)
        for d in np.unique(np.searchsorted(starts, places, side="right") - 1).tolist():
            items[d] |= block.holders[w]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, path: str | None = None, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Columns of ``docs`` and ``leak``: n_words, n_hit, items (sorted as strings) and matches.

    A match is an item suffix (item, item_at), the length of its longest match in the document's
    shard and where that begins in the document, in words. Each suffix gives at most one match a
    shard, so another document with the same passage may have hits and no match."""
    blocks = write_blocks(benchmark, path or shared_dir(docs.sparkSession, "decontamination"), item_id, item_text)
    cache: dict[str, Block] = {}

    def compute(texts: list[str | None]) -> list[tuple]:
        return search_shard(texts, blocks, window, cache)

    fields = "n_words: bigint, n_hit: bigint, items: array<string>, matches: array<struct<item: string, item_at: bigint, length: bigint, at: bigint>>"
    return with_struct(docs, text, "leak", fields, compute, SHARD_BYTES)


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", least: int = WINDOW,
) -> DataFrame:
    """item, item_at, length, doc, doc_at: for every item suffix its longest match of at
    least ``least`` words over all documents, and a place of that length."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    per_shard = find_leaks(narrow, benchmark, path, "text", item_id, item_text, least).select("doc", F.inline("leak.matches"))
    longest = per_shard.filter(F.col("length") >= least).groupBy("item", "item_at")
    longest = longest.agg(F.min(F.struct((-F.col("length")).alias("n"), "doc", "at")).alias("m"))
    return longest.select("item", "item_at", (-F.col("m.n")).alias("length"), "m.doc", F.col("m.at").alias("doc_at"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated documents."""
    found = find_leaks(docs, benchmark, **options)
    return found.filter(F.col(f"`{found.columns[-1]}`.n_hit") == 0).drop(found.columns[-1])
