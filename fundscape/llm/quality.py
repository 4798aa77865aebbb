"""Quality scores by co-training two views of a document.

The text view is what the text holds: hashed words and how its characters, words and lines
are made up. The metadata view is the page's record: source, language, stored length and
their combinations. Each view has a logistic classifier. In every round each classifier
labels all documents without a label, on Spark, and the ``TAKE`` it is surest of, as many of each
class as the labels suggest, join the training set of the other.

A view teaches only what it knows: on labelled rows kept apart, the share of wrong labels among
those at least as sure must be at most 1 - ``FLOOR``, and at most a quarter of what guessing that class gets
wrong; a view at chance teaches nothing. A pupil takes a lesson only if that raises its area under the
curve on the rows kept apart. Rounds end when nobody learns anything. At the end each view is calibrated
on the rows kept apart, the two calibrated log-odds are combined by a last
logistic fit on the same rows, and all documents are scored.

The classifiers are fitted on about ``SAMPLE`` labelled rows, chosen by a hash of their ids, whole texts, and
at most ``TAKE`` taught ones per round and view; only those rows' features reach the driver. Teaching and
scoring cover all rows. Unlabelled texts are read again only after the text classifier has changed.

Nulls: a null text is empty; a null source, language or length is a value of its own.
Labels that are null are left out; a document with several labels is taken with their mean.
Without labels of both classes all scores are the share of good labels (0.5 without any).
Empty tables give no rows. Repeated rows score alike. Texts of any length are read whole.
Other columns of documents pass through, whatever their names."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundscape.llm.common import free_name, shared_dir, stored, with_struct

TEXT_BITS, META_BITS = 9, 8
SAMPLE = 8_000
ROUNDS, TAKE = 5, 1_000  # rows taught per round and view
FLOOR, LEAST = 0.95, 20  # precision of a teacher, and rows to see it on
RIDGE = 1e-2
KEEP = 0.5
N_SHAPE = 12
ROWS = 1024  # summed at a time in a fit

WORDS = re.compile(r"\w+")
SYMBOLS = re.compile(r"[^\w\s.,;:'\"!?()-]")


def shape(text: str) -> list[float]:
    """How a text is made up, as numbers from 0 to about 1."""
    n = max(len(text), 1)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    k = max(len(words), 1)
    symbols = len(SYMBOLS.findall(text))
    upper = sum(map(str.isupper, words))
    return [
        1.0,
        min(np.log1p(len(text)) / 12, 1.0),
        min(np.log1p(len(words)) / 10, 1.0),
        symbols / n * 10,
        upper / k,
        (len(text) - sum(map(len, words))) / n,
        len(set(words)) / k,
        len(set(lines)) / max(len(lines), 1),
        min(n / k / 20, 2.0),
        sum(w[-1:] in ".!?" for w in words) / k,
        min(max(map(len, words), default=0) / 50, 2.0),
        min(len(lines) / k * 5, 2.0),
    ]


def text_features(texts: list[str | None]) -> np.ndarray:
    """Rows of hashed word shares (square roots) and shapes."""
    size = 1 << TEXT_BITS
    out = np.zeros((len(texts), size + N_SHAPE), np.float32)
    known: dict[str, int] = {}
    for i, t in enumerate(texts):
        t = t or ""
        found = WORDS.findall(t.lower())
        at = np.empty(len(found), np.int64)
        for j, w in enumerate(found):
            b = known.get(w)
            if b is None:
                b = known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) >> (32 - TEXT_BITS)
            at[j] = b
        if len(found):
            out[i, :size] = np.sqrt(np.bincount(at, minlength=size) / len(found))
        out[i, size:] = shape(t)
    return out


def meta_buckets(source: str, lang: str, length: str):
    """Hash buckets of the metadata values and their pairs, as an array column."""
    s, n = (F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in (source, lang))
    size = F.coalesce(F.floor(F.log2(F.col(length).cast("double") + 1)).cast("string"), F.lit("\x00"))
    parts = [F.concat(F.lit("s"), s), F.concat(F.lit("l"), n), F.concat(F.lit("n"), size)]
    parts += [F.concat(F.lit("sl"), s, F.lit("\x01"), n), F.concat(F.lit("ln"), n, F.lit("\x01"), size)]
    return F.array(*[F.shiftrightunsigned(F.xxhash64(p), 64 - META_BITS).cast("int") for p in parts])


def meta_matrix(buckets: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(buckets), (1 << META_BITS) + 1), np.float32)
    for i, b in enumerate(buckets):
        np.add.at(out[i], list(b), 1)
    out[:, -1] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Weights of a ridge logistic fit by Newton steps, summed over some rows at a time."""
    n, k = x.shape
    w, penalty = np.zeros(k), ridge * n / 10 + 1e-9
    for _ in range(steps):
        g, h = penalty * w, np.eye(k) * penalty
        for a in range(0, n, ROWS):
            part = x[a : a + ROWS].astype(float)
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            v = weight[a : a + ROWS]
            g += part.T @ (v * (p - y[a : a + ROWS]))
            h += part.T @ (part * (v * p * (1 - p))[:, None])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    combine: np.ndarray  # calibration: slope and shift of each view, then slopes and shift of both
    prior: float | None = None  # the only score where nothing can be learned

    def text_margin(self, texts: list[str | None]) -> np.ndarray:
        return text_features(texts) @ self.text


def meta_margin(buckets: Column, weights: np.ndarray) -> Column:
    table = F.lit([float(x) for x in weights])
    return F.aggregate(buckets, F.lit(float(weights[-1])), lambda s, b: s + F.get(table, b))


def area(margin: np.ndarray, good: np.ndarray) -> float:
    """Area under the curve; ties count half."""
    values, at, n = np.unique(margin, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    ones, zeros = int(good.sum()), int(len(good) - good.sum())
    return float((rank[good == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros))


def surest(margin: np.ndarray, good: np.ndarray, floor: float = FLOOR, least: int = LEAST) -> tuple[float, float]:
    """Margins from which on a view may teach: at most the first for bad, at least the second for good;
    infinite where it may not."""
    limits = []
    for sign, right in ((-1, good == 0), (1, good == 1)):
        order = np.argsort(-sign * margin, kind="stable")
        n = np.arange(1, len(order) + 1)
        wrong = (np.cumsum(~right[order]) + 1) / (n + 2)  # a cautious share
        ends = np.append(np.diff(margin[order]) != 0, True)  # equal margins stand together
        allowed = np.flatnonzero((wrong <= min(1 - floor, (1 - right.mean()) / 4)) & (n >= least) & ends)
        limits.append(float(margin[order][allowed[-1]]) if len(allowed) else sign * float("inf"))
    low, high = limits
    return (low, high) if low < high else ((low + high) / 2,) * 2


def calibrated(fitted: dict[str, np.ndarray], views: dict[str, np.ndarray], label: np.ndarray) -> Model:
    """Views calibrated and combined on rows kept apart."""
    one = np.ones(len(label))
    margins = [views[v] @ fitted[v] for v in ("text", "meta")]
    each = [logistic(np.stack([m, one], axis=1), label, one) for m in margins]
    logits = [m * c[0] + c[1] for m, c in zip(margins, each, strict=True)]
    both = logistic(np.stack([*logits, one], axis=1), label, one)
    return Model(fitted["text"], fitted["meta"], np.concatenate([*each, both]))


def with_features(rows: DataFrame) -> DataFrame:
    """Rows (id, text, meta, ...) with the text's features as bytes in place of the text."""
    seen = with_struct(rows, "text", "f", "x: binary", lambda t: [(x.tobytes(),) for x in text_features(t)])
    return seen.withColumn("x", F.col("f.x")).drop("text", "f")


def matrices(seen) -> dict[str, np.ndarray]:
    text = np.frombuffer(b"".join(seen["x"]), np.float32).reshape(len(seen), -1)
    return {"text": text, "meta": meta_matrix(seen["meta"].tolist())}


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    length: str = "n_chars", label: str = "quality", sample: int = SAMPLE, rounds: int = ROUNDS, take: int = TAKE, floor: float = FLOOR,
) -> Model:
    """Fit on rows of ``docs`` whose ids are in ``labels`` and on what the views teach each other."""
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("double").alias("y")).dropna()
    marked = marked.groupBy("id").agg(F.avg("y").alias("y"))
    totals = marked.agg(F.count("*"), F.avg("y"), F.min("y"), F.max("y")).first()
    if not totals[0] or totals[2] == totals[3]:
        return Model(np.zeros(0), np.zeros(0), np.zeros(0), float(totals[1]) if totals[0] else 0.5)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("quality"), F.col("id").cast("string")), 33)
    some = marked.filter(draw < int(min(1.0, sample / totals[0]) * (1 << 31)))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"),
        meta_buckets(f"`{source}`", f"`{lang}`", f"`{length}`").alias("meta"),
    ).filter("id IS NOT NULL")
    known = with_features(rows.join(some, "id").select("id", "text", "meta", "y"))
    seen = known.withColumn("apart", F.pmod(F.xxhash64(F.lit("apart"), "id"), F.lit(4)) == 0).toPandas()
    seen = seen.sort_values("id", kind="stable").drop_duplicates("id")
    y, apart = (seen["y"].to_numpy(float) >= 0.5).astype(float), seen["apart"].to_numpy(bool)
    for part in (~apart, apart):
        if len(set(y[part])) < 2:
            return Model(np.zeros(0), np.zeros(0), np.zeros(0), float(totals[1]))
    views = matrices(seen)
    held = {v: x[apart] for v, x in views.items()}
    train = {v: (x[~apart], y[~apart], np.ones(int((~apart).sum()))) for v, x in views.items()}
    fitted = {v: logistic(*train[v]) for v in views}

    path, good = shared_dir(docs.sparkSession, "quality"), float(y[~apart].mean())
    taught: dict[str, set] = {v: set() for v in views}
    pool = None
    for n in range(rounds):
        limits = {v: surest(held[v] @ fitted[v], y[apart], floor) for v in views}
        if not np.isfinite(list(limits.values())).any():
            break
        if pool is None:  # the text classifier's margins of all rows without a label
            weights = fitted["text"]
            found = with_struct(rows, "text", "made", "margin: double", lambda t, w=weights: [(float(m),) for m in text_features(t) @ w])
            found = found.select("id", "meta", F.col("made.margin").alias("text")).join(marked.select("id"), "id", "left_anti")
            pool = stored(found, f"{path}/pool-{n}")
        margins = pool.select("id", "text", meta_margin(F.col("meta"), fitted["meta"]).alias("meta"))
        learned = set()
        for mine, other in (("text", "meta"), ("meta", "text")):
            low, high = limits[mine]
            picks: dict = {}
            for limit, order, value, most in ((high, F.desc(mine), 1.0, round(take * good)), (low, F.asc(mine), 0.0, take - round(take * good))):
                if not np.isfinite(limit):
                    continue
                sure = margins.filter(F.col(mine) >= limit if value else F.col(mine) <= limit)
                first = sure.select("id", mine).orderBy(order, "id").limit(most + len(taught[other])).toPandas()["id"]
                picks |= {i: value for i in [i for i in first.tolist() if i not in taught[other]][:most]}
            if not picks:
                continue
            chosen = docs.sparkSession.createDataFrame(list(picks.items()), f"id {rows.schema['id'].dataType.simpleString()}, y double")
            lesson = with_features(rows.join(F.broadcast(chosen), "id").select("id", "text", "meta", "y")).toPandas()
            lesson = lesson.sort_values("id", kind="stable").drop_duplicates("id")
            more = (matrices(lesson)[other], lesson["y"].to_numpy(float), np.full(len(lesson), 0.3))  # a pseudo-label counts less
            tried = tuple(np.concatenate(p) for p in zip(train[other], more, strict=True))
            pupil = logistic(*tried)
            taught[other] |= set(picks)
            if area(held[other] @ pupil, y[apart]) > area(held[other] @ fitted[other], y[apart]):
                train[other], fitted[other] = tried, pupil
                learned.add(other)
        if not learned:
            break
        if "text" in learned:
            pool = None
    return calibrated(fitted, held, y[apart])


def score(docs: DataFrame, model: Model, text: str = "text", source: str = "source", lang: str = "lang", length: str = "n_chars") -> DataFrame:
    """Columns of ``docs`` and a struct ``quality``: score, text_score, meta_score, keep."""
    free = free_name(docs, "quality")
    if model.prior is not None:
        p = F.lit(model.prior)
        return docs.withColumn(free, F.struct(p.alias("score"), p.alias("text_score"), p.alias("meta_score"), (p >= KEEP).alias("keep")))
    names = [f"_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = {c: names[docs.columns.index(c)] for c in (text, source, lang, length)}
    found = with_struct(plain, at[text], "made", "margin: double", lambda t: [(float(m),) for m in model.text_margin(t)])
    buckets = meta_buckets(at[source], at[lang], at[length])
    meta = meta_margin(buckets, model.meta)
    c = [float(x) for x in model.combine]
    lt, lm = F.col("made.margin") * c[0] + c[1], meta * c[2] + c[3]
    total = lt * c[4] + lm * c[5] + c[6]
    sigmoid = lambda x: 1 / (1 + F.exp(-x))
    struct = F.struct(
        sigmoid(total).alias("score"), sigmoid(lt).alias("text_score"), sigmoid(lm).alias("meta_score"), (sigmoid(total) >= KEEP).alias("keep")
    )
    return found.select(*names, struct.alias("made")).toDF(*docs.columns, free)
