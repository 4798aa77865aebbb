"""Relevance of phrases by vectors: how near a phrase's usual company is to a text.

Every word has a place and a sign in ``dims`` dimensions, by MD5 (random indexing). A text's vector
adds up its words; a word's vector adds up the words around it in all texts. A phrase's vector is
that of its words one after the other and is compared with the text's, as often repeated, by cosine. So dot products are needed
per text and distinct word only, and a phrase adds those of its words.

All sums are of whole numbers. Texts are worked on in slices: a slice adds up the company of each of its words and
sends it to the task of a range of words, which gets the sums of all slices and sends each slice those of its words.
No task holds the vocabulary."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.functions.text import TOKEN
from fundscape.operators.keyphrases import _distinct_runs, _joined, _large, _slices, _small, _words
from fundscape.session import stored

DIMS = 32
REACH = 2  # words on either side that are a word's company
SLICE = 500_000  # words that are worked on at once
RANGE = 500_000  # words of slices that one call adds up, about that many

# The functions that run in tasks travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def vector_relevance(
    texts: DataFrame,
    key: str = "projectID",
    text: str = "objective",
    n: tuple[int, int] = (1, 3),
    stop_words: Sequence[str] | None = None,
    pattern: str = TOKEN,
    dims: int = DIMS,
    reach: int = REACH,
    best: int | None = None,
) -> DataFrame:
    """Phrases of ``n[0]`` to ``n[1]`` neighbouring words with their relevance to each text:
    ``(key, phrase, tf, score)``, the cosine to six places, 0 for words without company. ``texts``
    holds one text per key; a NULL text has no phrases, and a NULL key's text is company only. With ``best`` at
    least the ``best`` first of each text by score and phrase are among the rows, and most others are not."""
    kind = texts.schema[key].dataType.simpleString()
    packed = f"_slice long, _keys array<{kind}>, _sizes array<int>, _codes array<int>, _words array<string>"
    slices = stored(_words(texts, key, text, stop_words, pattern).mapInArrow(_packed, packed), "slices", "zstd")
    entries = slices.agg(F.coalesce(F.sum(F.size("_words")), F.lit(0))).first()[0]
    bits = (entries // RANGE).bit_length()
    blocks = slices.drop("_keys").mapInArrow(_company(dims, reach, bits), "_range long, _slice long, _words array<string>, _sums binary")
    sums = blocks.groupBy("_range").applyInArrow(_summed(dims), "_slice long, _range long, _sums binary")
    met = slices.groupBy("_slice").cogroup(sums.groupBy("_slice"))
    found = met.applyInArrow(_near(key, *n, dims, bits, best), f"`{key}` {kind}, phrase string, tf long, size int, dot double, norm double, own double")
    cosine = F.try_divide(F.col("dot"), F.sqrt("norm") * F.sqrt(F.col("size") * F.col("own")))
    scored = found.withColumn("score", F.round(F.coalesce(cosine, F.lit(0.0)), 6))
    return scored.filter(F.col(key).isNotNull()).select(key, "phrase", "tf", "score")


def _packed(batches):
    """One row for each slice: its number, the keys, the texts' numbers of words, all words by their places among the
    distinct ones, and those."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    def one(values):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    number = TaskContext.get().partitionId() << 32
    for part, sizes in _slices(batches, SLICE):
        words = part.column("_w").flatten().dictionary_encode()
        columns = [part.column(0), pa.array(sizes.astype(np.int32)), words.indices, words.dictionary]
        yield pa.record_batch([pa.array([number]), *map(one, columns)], names=["_slice", "_keys", "_sizes", "_codes", "_words"])
        number += 1


def _indexed(words, dims: int, bits: int):
    """The words' dimensions and signs, their order by range and word, and the ranges in that order."""
    from hashlib import md5

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    marks = np.frombuffer(b"".join(md5(w.encode()).digest() for w in words.to_pylist()), np.uint8).reshape(-1, 16)
    first, last = (np.ascontiguousarray(marks[:, i : i + 4]).view(">u4")[:, 0].astype(np.int64) for i in (0, 8))
    ranges = last >> (32 - bits)
    order = pc.sort_indices(words.cast(pa.binary())).to_numpy().astype(np.int64)
    order = order[np.argsort(ranges[order], kind="stable")]
    return first % dims, np.where(marks[:, 4] < 128, 1, -1), order, ranges[order]


def _unsigned(sums):
    """Whole numbers in a row, their signs as the lowest bits."""
    import numpy as np

    flat = np.ascontiguousarray(sums, np.int64).ravel()
    return ((flat << 1) ^ (flat >> 63)).view(np.uint64)


def _signed(flat, dims: int):
    import numpy as np

    return ((flat >> np.uint64(1)).view(np.int64) ^ -(flat & np.uint64(1)).view(np.int64)).reshape(-1, dims)


def _cuts(ranges):
    import numpy as np

    at = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]])
    return list(zip(at, [*at[1:], len(ranges)], strict=True))


def _company(dims: int, reach: int, bits: int):
    """Rows range, slice, words, sums of slices: the company of the words of a range in the slice's texts."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                sizes, codes = (batch.column(c)[i].values.to_numpy().astype(np.int64) for c in ("_sizes", "_codes"))
                words = batch.column("_words")[i].values
                place, sign, order, ranges = _indexed(words, dims, bits)
                row = np.repeat(np.arange(len(sizes)), sizes)
                sums = np.zeros(len(words) * dims, np.int64)
                for step in range(1, reach + 1):
                    near = np.flatnonzero(row[step:] == row[:-step])
                    for word, other in ((codes[near], codes[near + step]), (codes[near + step], codes[near])):
                        sums += np.bincount(word * dims + place[other], sign[other], len(sums)).astype(np.int64)
                sums, cuts = sums.reshape(-1, dims), _cuts(ranges)
                texts = pa.array([words.take(pa.array(order[a:b])) for a, b in cuts], pa.list_(pa.string()))
                columns = [pa.array([ranges[a] for a, _ in cuts]), pa.array([batch.column("_slice")[i].as_py()] * len(cuts)), texts]
                columns.append(pa.array([_small(_unsigned(sums[order[a:b]])) for a, b in cuts], pa.binary()))
                yield pa.record_batch(columns, names=["_range", "_slice", "_words", "_sums"])

    return run


def _summed(dims: int):
    """The sums over all slices of one range of words, for each slice those of its words in their order."""

    def run(blocks):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = blocks.column("_words").combine_chunks()
        words = pc.list_flatten(lists).dictionary_encode()
        codes = words.indices.to_numpy().astype(np.int64)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        parts = [codes[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        sums = np.zeros((len(words.dictionary), dims), np.int64)
        for part, data in zip(parts, blocks.column("_sums").to_pylist(), strict=True):
            sums[part] += _signed(_large(data), dims)  # a slice has a word once
        out = pa.array([_small(_unsigned(sums[part])) for part in parts], pa.binary())
        return pa.table({"_slice": blocks.column("_slice"), "_range": blocks.column("_range"), "_sums": out})

    return run


def _near(key: str, shortest: int, longest: int, dims: int, bits: int, best: int | None):
    """Rows key, phrase, tf, size, dot, norm, own of a slice and the sums of its words. With ``best`` those that score, as
    computed here, more than a hair less than the ``best``-th of a text are left out: rounding and ties are left to Spark."""

    def run(slices, sums):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        keys, words = (slices.column(c)[0].values for c in ("_keys", "_words"))
        sizes, codes = (slices.column(c)[0].values.to_numpy().astype(np.int64) for c in ("_sizes", "_codes"))
        place, sign, order, ranges = _indexed(words, dims, bits)
        vectors = np.empty((len(words), dims), np.int64)
        for (a, b), data in zip(_cuts(ranges), sums.sort_by("_range").column("_sums").to_pylist(), strict=True):
            vectors[order[a:b]] = _signed(_large(data), dims)
        row = np.repeat(np.arange(len(sizes)), sizes)
        left = np.cumsum(sizes)[row] - np.arange(len(codes))
        of_text = np.bincount(row * dims + place[codes], sign[codes], len(sizes) * dims).reshape(-1, dims)
        pairs, pair = np.unique(row * len(words) + codes, return_inverse=True)
        texts, kinds = pairs // len(words), pairs % len(words)
        dots, norms, own = np.zeros(len(pairs)), np.zeros(len(words)), np.zeros(len(sizes))
        for i in range(dims):
            v, t = vectors[:, i].astype(float), of_text[:, i]
            dots, norms, own = dots + t[texts] * v[kinds], norms + v * v, own + t * t
        dot_at, norm_at = dots[pair], norms[codes]
        parts = []
        for size, (at, tf) in enumerate(_distinct_runs(codes, row, left, longest), 1):
            if size >= shortest:
                dot, norm = (sum((x[at + i] for i in range(1, size)), x[at]) for x in (dot_at, norm_at))
                parts.append((row[at], at, tf, np.full(len(at), size), dot, norm))
        of, at, tf, size, dot, norm = map(np.concatenate, zip(*parts, strict=True))
        below = np.sqrt(norm) * np.sqrt(size * own[of])
        score = np.divide(dot, below, out=np.zeros(len(dot)), where=below > 0)

        placed = words.take(pa.array(codes))
        if pc.any(pc.match_substring(words, " ")).as_py():  # other words may then make the same phrase
            same = _joined(placed, at, size, longest).dictionary_encode().indices.to_numpy().astype(np.int64)
            down = np.lexsort((-score, same, of))
            first = np.flatnonzero(np.r_[True, (np.diff(of[down]) != 0) | (np.diff(same[down]) != 0)])
            tf, down = np.add.reduceat(tf[down], first), down[first]
            of, at, size, dot, norm, score = (x[down] for x in (of, at, size, dot, norm, score))
        if best is not None:
            down = np.lexsort((-score, of))
            begin = np.flatnonzero(np.r_[True, np.diff(of[down]) != 0])
            last = begin + best - 1
            last = last[last < np.r_[begin[1:], len(down)]]
            least = np.full(len(sizes), -np.inf)
            least[of[down[last]]] = score[down[last]] - 1e-5
            kept = np.flatnonzero(score >= least[of])
            of, at, tf, size, dot, norm = (x[kept] for x in (of, at, tf, size, dot, norm))
        columns = [keys.take(pa.array(of)), _joined(placed, at, size, longest), *map(pa.array, (tf, size.astype(np.int32), dot, norm, own[of]))]
        return pa.table(columns, names=[key, "phrase", "tf", "size", "dot", "norm", "own"])

    return run
