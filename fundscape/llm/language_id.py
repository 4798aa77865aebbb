"""Language identification with error-correcting output codes.

Every language has a codeword of +1 and -1. One binary classifier per bit predicts the
bit from hashed character 1- to 3-grams of the lower-cased letters: a naive Bayes
log-odds per gram, averaged over the text and calibrated by a logistic fit. Decoding
takes the codeword with the least loss: the sum over bits of log(1 + exp(-bit * margin)),
each bit weighted by how well its classifier did in training. A text whose best codeword
leads the next by less than ``AMBIGUOUS`` per bit is flagged.

Gram counts come from a sample of labelled rows of about ``SAMPLE`` in all, but about ``LEAST`` of each language or
all it has, chosen by a hash of their ids, whole texts. The ``MOST`` most frequent labels are learned, which bounds what
the driver sees; the model has one column per bit and a row per hash bucket.

Nulls: a null text, or one without a letter, gets ``und`` and score 0; rows with a null
label teach nothing; null ids count as empty ones when rows are chosen. Without labels every text is ``und``; with
one language every text with a letter gets it. Repeated rows get equal results. Empty
tables give no rows. Texts of any length are read whole. Other columns pass through."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.llm.common import row_ranges, with_struct

UNKNOWN = "und"
BUCKET_BITS = 15
SAMPLE, LEAST = 20_000, 200  # labelled rows, about, that the classifiers are fitted on, in all and of a language
MOST = 200  # languages that are told apart
AMBIGUOUS = 0.02
FULL_CODE = 5  # up to so many languages get all distinct columns
SLICE = 1 << 19  # bytes of texts weighed at a time; of a longer text, places


def codewords(n: int) -> np.ndarray:
    """n codewords: every way to split the languages in two where there are few, else
    random splits, of which the set with the farthest nearest pair is taken."""
    if n < 2:
        return np.ones((n, 1))
    if n <= FULL_CODE:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.asarray(splits, float).T
    rng, bits = np.random.default_rng(5), int(np.ceil(10 * np.log2(n)))
    best, far = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, bits))
        code[:, np.abs(code.sum(0)) == n] *= np.where(np.arange(n) % 2, 1, -1)[:, None]
        apart = ((code[:, None] != code[None]).sum(2) + np.eye(n, dtype=int) * bits).min()
        if apart > far:
            best, far = code, apart
    return best


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point of the basic plane its lower-case letter, else a space."""
    if not _letters:
        _letters.append(np.asarray([letter(c) for c in range(1 << 16)], np.uint32))
    return _letters[0]


def letter(point: int) -> int:
    """The lower-case letter of a code point, else a space."""
    return ord(chr(point).lower()[0]) if chr(point).isalpha() else 32


def grams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of 1-, 2- and 3-grams at every place of all texts in a row, the texts' first
    places (a space stands before each and two at the end), and letters per text."""
    table = letters()
    points = np.frombuffer("".join(f" {t or ''}" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0, *[len(t or "") + 1 for t in texts[:-1]]])
    far = points >= 1 << 16
    low = table[np.where(far, 32, points)]
    if far.any():
        found, which = np.unique(points[far], return_inverse=True)
        low[far] = np.asarray([letter(c) for c in found.tolist()], np.uint32)[which]
    points = low
    n_letters = np.add.reduceat((points != 32).astype(np.int64), starts)
    p = np.concatenate([points, [32, 32]]).astype(np.uint32)
    one = p * np.uint32(0x9E3779B1)
    two = one[:-1] ^ (p[1:] * np.uint32(0x85EBCA77)) ^ np.uint32(0x27D4EB2F)
    three = two[:-1] * np.uint32(0x2C1B3C6D) ^ (p[2:] * np.uint32(0xC2B2AE3D))
    shift = np.uint32(32 - BUCKET_BITS)
    out = []
    for h in (one[:-2], two[:-1], three):
        h = h ^ (h >> np.uint32(15))
        h = h * np.uint32(0x2C1B3C6D)
        out.append((h ^ (h >> np.uint32(12))) * np.uint32(0x297A2D39) >> shift)
    return out, starts, n_letters


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    scale: np.ndarray  # slope and intercept of each bit's margin
    trust: np.ndarray  # weight of each bit in decoding

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Uncalibrated margins per text and bit, and letters per text."""
        found, starts, n_letters = grams(texts)
        if len(texts) > 1 or len(found[0]) <= SLICE:
            total = sum(np.add.reduceat(self.weights[g], starts, axis=0) for g in found)
        else:  # one long text, cut from its start, so that equal texts get equal sums
            total = sum(self.weights[g[a : a + SLICE]].sum(0, dtype=float) for g in found for a in range(0, len(g), SLICE))[None]
        return total.astype(float) / np.sqrt(np.maximum(n_letters, 1))[:, None], n_letters

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """lang, score, ambiguous of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0, True)] * len(texts)
        raw, n_letters = self.margins(texts)
        margin = np.clip(raw * self.scale[0] + self.scale[1], -30, 30)
        loss = (np.logaddexp(0, -self.code[None] * margin[:, None]) * self.trust).sum(2)
        order = np.argsort(loss, axis=1, kind="stable")
        likely = np.exp(loss.min(1, keepdims=True) - loss)
        score = likely.max(1) / likely.sum(1)
        out = []
        for i, n in enumerate(n_letters.tolist()):
            if not n:
                out.append((UNKNOWN, 0.0, True))
                continue
            first = int(order[i, 0])
            lead = loss[i, order[i, 1]] - loss[i, first] if len(self.languages) > 1 else np.inf
            out.append((self.languages[first], float(score[i]), bool(lead < AMBIGUOUS * self.trust.sum())))
        return out


def any_language() -> Model:
    """A model that gives every text with a letter one language, for tables that teach none."""
    return Model(["any"], np.ones((1, 1)), np.zeros((1 << BUCKET_BITS, 1), np.float32), np.asarray([[1.0], [0.0]]), np.ones(1))


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % 4 == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, least: int = LEAST, most: int = MOST) -> Model:
    """Learn from the text and label of ``docs``; the caller leaves held-out rows out. About ``sample`` rows
    are drawn in all, but about ``least`` of each language, and all of one that has fewer. Of more than ``most``
    labels the most frequent are learned."""
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    n = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = sizes.orderBy(F.desc("n"), "lang").limit(most).collect()
    shares = [(r["lang"], int(min(1.0, max(sample / n, least / r["n"])) * (1 << 31))) for r in known]
    drawn = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share long"))
    rows = rows.join(drawn, "lang").filter(F.shiftrightunsigned(F.xxhash64(F.lit("language"), "id"), 33) < F.col("share"))
    rows = rows.select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for a, b in row_ranges(batch.column("text"), SLICE):
                part = batch.slice(a, b - a)
                by: dict[str, list[str]] = {}
                for t, label in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                    by.setdefault(label, []).append(t)
                for label, texts in by.items():
                    found, _, _ = grams(texts)
                    counts = sum(np.bincount(g, minlength=1 << BUCKET_BITS) for g in found)
                    totals[label] = totals.get(label, 0) + counts
        for label, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([label] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))], names=["lang", "bucket", "n"])

    counted = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((1, 1)), np.zeros((2, 1)), np.ones(1))
    share = np.zeros((len(languages), 1 << BUCKET_BITS))
    share[table["lang"].map({x: i for i, x in enumerate(languages)}), table["bucket"]] = table["n"]
    share = (share + 0.1) / (share + 0.1).sum(1, keepdims=True)
    code = codewords(len(languages))
    weights = np.zeros((1 << BUCKET_BITS, code.shape[1]), np.float32)
    if len(languages) > 1:
        for b in range(code.shape[1]):
            weights[:, b] = np.log(share[code[:, b] > 0].mean(0)) - np.log(share[code[:, b] < 0].mean(0))
    model = Model(languages, code, weights, np.stack([np.ones(code.shape[1]), np.zeros(code.shape[1])]), np.ones(code.shape[1]))
    if len(languages) > 1:
        _calibrate(model, rows)
    return model


def _calibrate(model: Model, rows: DataFrame) -> None:
    """A logistic fit of each bit to its margin over the sample, and the bits' trust."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_ranges(batch.column("text"), SLICE):
                part = batch.slice(a, b - a)
                raw, _ = model.margins(part.column("text").to_pylist())
                yield pa.record_batch([part.column("lang"), pa.array(raw.tolist())], names=["lang", "margins"])

    seen = rows.mapInArrow(measure, "lang string, margins array<double>").toPandas()
    margins = np.stack(seen["margins"])
    wanted = model.code[seen["lang"].map({x: i for i, x in enumerate(model.languages)})]
    for b in range(margins.shape[1]):
        x, y = margins[:, b], (wanted[:, b] + 1) / 2
        spread = max(float(np.abs(x).mean()), 1e-9)
        x, slope, shift = x / spread, 1.0, 0.0
        for _ in range(100):  # Newton steps of a ridge logistic fit in two unknowns
            p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
            g = np.asarray([((p - y) * x).sum() + slope, (p - y).sum() + shift])
            v = p * (1 - p)
            h = np.asarray([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 1]])
            step = np.linalg.solve(h, g)
            slope, shift = slope - step[0], shift - step[1]
            if np.abs(step).max() < 1e-8:
                break
        right = float((((slope * x + shift) > 0) == (y > 0)).mean())
        model.scale[:, b] = slope / spread, shift
        model.trust[b] = max(right - 0.5, 0.0) * 2
    if not model.trust.any():
        model.trust[:] = 1.0


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Columns of ``docs`` and a struct ``language``: lang, score, ambiguous."""
    return with_struct(docs, text, "language", "lang: string, score: double, ambiguous: boolean", model.predict, SLICE)
