"""Spelling variant grouping by permuterm rotations.

Words are maximal runs of letters (``[A-Za-z\\u00C0-\\u00FF]+``), A-Z lower-cased, of at least
``least`` code points and ``occurrences`` occurrences. So that every corpus holds known misspellings, a run
whose crc32 (with its document's id) is a multiple of ``every`` first loses one code point;
``every=None`` leaves the text as it is.

Each word is closed by ``$`` and turned: the rotation that starts behind code point i ends
with that code point, so all but its last code point is the word with i skipped. Words that
differ by a replaced code point agree in such a prefix, and a word with one code point less
has that prefix as a rotation of its own. Rotations, whole and without their last code point,
are sorted over range partitions; equal ones stand next to each other and every two words
of such a group are near. A group has at most one word per letter and one shorter word, so
its size is bounded by the alphabet, whatever the corpus. Neighbours are counted and the best
is taken within the sorted group by window functions; pairs never become rows. Where a letter
repeats (``ss``), skipping either gives the same shorter word: only the first of a run of
equal letters counts for that pair.

A word's form is its near word of largest n (ties: the smallest in code-point order) if that n is
at least ``times`` the word's; following forms ends at the root. As n grows ``times``-fold with
each step, chains are short and pointer doubling needs few rounds.

Nulls: a null text has no words, a null id counts as an empty one. Empty texts and texts without
long words give nothing. Repeated rows are rows of their own and count again. An empty table
gives no rows. Only id and text are read; other columns, whatever their names, stay out. Texts
of any length are read whole, some megabytes at a time."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscape.llm.common import PIECE, row_ranges, shared_dir, stored

LEAST = 7
OCCURRENCES = 2
EVERY = 31
TIMES = 10
HELD = 1_000_000  # words that a task counts before it hands them on

# One byte a code point: A-Z lower-cased, letters kept, all else a space.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)


def runs(text: str) -> Iterator[list[bytes]]:
    """The letter runs of a text, in Latin-1, some at a time. Code points beyond U+00FF end a run."""
    data, at = text.encode("latin-1", "replace").translate(LETTERS), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def document_words(doc_id: str | None, text: str | None, least: int = LEAST, every: int | None = EVERY) -> Counter:
    """Occurrences of each word in one document."""
    found: Counter = Counter()
    for some in runs(text or ""):
        found.update([w for w in some if len(w) >= least])
    if not every:
        return found
    start, out = zlib.crc32(f"{doc_id or ''}:".encode()), Counter()
    for w, n in found.items():
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
        if h % every == 0:
            i = h % len(w)
            w = w[:i] + w[i + 1 :]
            if len(w) < least:
                continue
        out[w] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST, occurrences: int = OCCURRENCES, every: int | None = EVERY) -> DataFrame:
    """word and n, its occurrences in all documents. Tasks add up before the shuffle."""

    def flush(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.record_batch([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for a, b in row_ranges(batch.column("text"), 4 << 20):
                part = batch.slice(a, b - a)
                for d, t in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    for w, n in document_words(d, t, least, every).items():
                        counts[w] += n
                if len(counts) > HELD:
                    yield flush(counts)
                    counts.clear()
        yield flush(counts)

    narrow = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    counted = narrow.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def rotations(words: DataFrame) -> DataFrame:
    """turn, word, n, whole, counts: every rotation of each marked word as it is (``whole``),
    and those that end with a letter without it. ``counts`` is false where the letter left
    out repeats the one before."""
    skipped = """transform(sequence(0, length(word) - 1), i -> struct(
        concat(substr(word, i + 2), '$', substr(word, 1, i)) AS turn, false AS whole,
        i = 0 OR substr(word, i + 1, 1) <> substr(word, i, 1) AS counts))"""
    whole = """transform(sequence(0, length(word)), i -> struct(
        concat(substr(word, i + 1), '$', substr(word, 1, i)) AS turn, true AS whole, true AS counts))"""
    return words.select("word", "n", F.expr(f"inline(concat({skipped}, {whole}))"))


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near and best (n, word) of each word that has near words."""
    ordered = rotations(words).repartitionByRange("turn")
    by_n = Window.partitionBy("turn").orderBy(F.desc("n"), "word")
    group = by_n.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edited, shorter = ~F.col("whole"), F.col("whole")
    scanned = ordered.select(
        "word", "whole", "counts",
        F.row_number().over(by_n).alias("place"),
        F.count(F.when(edited, 1)).over(group).alias("edits"),
        F.count(F.when(edited & F.col("counts"), 1)).over(group).alias("longer"),
        F.count(F.when(shorter, 1)).over(group).alias("shorter"),
        *[F.nth_value(F.struct((-F.col("n")).alias("less"), "word"), i).over(group).alias(f"at{i}") for i in (1, 2)],
    )
    near = F.when(shorter, F.col("longer")).otherwise(F.col("edits") - 1 + F.when(F.col("counts"), F.col("shorter")).otherwise(0))
    best = F.when(F.col("place") == 1, F.col("at2")).otherwise(F.col("at1"))
    found = scanned.filter("edits + shorter > 1").select("word", near.alias("near"), best.alias("best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, path: str) -> DataFrame:
    """word and root of every word that has a form (``word``, ``form``)."""
    up, step = forms.select("word", F.col("form").alias("root")), 0
    while True:
        step += 1
        above = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        up = stored(up.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), f"{path}/roots-{step}")
        if up.filter("moved").isEmpty():
            return up.select("word", "root")
        up = up.select("word", "root")


def group_variants(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", least: int = LEAST,
    occurrences: int = OCCURRENCES, every: int | None = EVERY, times: int = TIMES,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    path = path or shared_dir(docs.sparkSession, "spelling")
    words = stored(word_counts(docs, id_col, text, least, occurrences, every), f"{path}/words")
    joined = words.join(neighbours(words), "word", "left")
    form_n = -F.col("best.less")
    fits = form_n >= times * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"), F.when(fits, form_n).alias("form_n"),
    )
    formed = stored(formed, f"{path}/forms")
    found = roots(formed.filter("form IS NOT NULL").select("word", "form"), path)
    return formed.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
