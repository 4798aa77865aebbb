"""Topic clusters of texts and their most frequent words."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import StorageLevel, cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundscape.functions import tokens
from fundscape.operators.keyphrases import _slices
from fundscape.operators.ranks import with_rank
from fundscape.session import stored

SLICE = 500_000  # words that are worked on at once

# The functions that run in tasks travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def text_clusters(
    df: DataFrame,
    key: str = "projectID",
    text: str = "objective",
    stop_words: Sequence[str] | None = None,
    seed: int = 42,
    n_features: int = 1 << 18,
    min_texts: int = 5,
) -> DataFrame:
    """Cluster texts by their TF-IDF vectors into min(8, max(2, n div 25)) groups:
    ``(key, words, cluster)``. Fewer than ``min_texts`` texts give no rows.

    Words share one of ``n_features`` hash buckets when there are more words than that, and
    then weigh as one word. Words are made once and stored. Vectors are held on the executors' disks, not in their
    memory, while the fit reads them round by round, and released after it."""
    if stop_words is None:
        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    words = stored(df.filter(F.col(text).isNotNull()).select(key, tokens(F.col(text), stop_words).alias("words")), "words")
    n = words.count()
    if n < min_texts:
        return words.withColumn("cluster", F.lit(0)).limit(0)
    hashed = HashingTF(inputCol="words", outputCol="counts", numFeatures=n_features)
    counts = hashed.transform(words).select("counts")
    idf = IDF(inputCol="counts", outputCol="features").fit(counts)
    # The fit holds vectors that nobody else holds in memory, as objects.
    vectors = idf.transform(counts).select("features").persist(StorageLevel.DISK_ONLY)
    try:
        groups = KMeans(k=min(8, max(2, n // 25)), seed=seed, maxIter=20, predictionCol="cluster", solver="row")
        model = groups.fit(vectors)
    finally:
        vectors.unpersist()
    return model.transform(idf.transform(hashed.transform(words))).select(key, "words", "cluster")


def stored_model(clustered: DataFrame, key: str = "projectID") -> tuple[DataFrame, DataFrame]:
    """A clustering as two stored tables that outlive its session: ``(word, idf)`` and the centres,
    ``(cluster, word, weight)``, each the mean tf-idf vector of its texts. ``clustered``: key, words, cluster.

    ``idf`` is ``ln((N + 1) / (df + 1))``. Both numbers are in whole thousandths, so that sums over
    them do not depend on their order. Words keep their own weights and share no hash buckets."""
    own = clustered.select("cluster", key, _known("words").alias("_w")).groupBy("cluster", key).agg(F.collect_list("_w").alias("_w"))
    kind = clustered.schema["cluster"].dataType.simpleString()
    counts = own.select("cluster", "_w").mapInArrow(_counted, f"cluster {kind}, word string, tf long, df long")
    counts = stored(counts.groupBy("cluster", "word").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")), "cluster-words")
    n = clustered.agg(F.count("*")).scalar()
    per_word = counts.groupBy("word").agg(F.sum("df").alias("df"))
    idf = stored(per_word.select("word", F.round(1000 * F.ln((n + 1) / (F.col("df") + 1))).cast("long").alias("idf")), "idf")
    sizes = clustered.groupBy("cluster").agg(F.count("*").alias("n"))
    weight = F.round(F.col("tf") * F.col("idf") / F.col("n")).cast("long")
    return idf, stored(counts.join(idf, "word").join(sizes, "cluster").select("cluster", "word", weight.alias("weight")), "centres")


def _known(words: str) -> Column:
    return F.filter(words, lambda w: w.isNotNull())


def _counted(batches):
    """Rows cluster, word, tf, df of rows cluster, lists of words, one row for each text: added up over about
    ``SLICE`` words."""
    import numpy as np
    import pyarrow as pa

    for part, sizes in _slices(batches, SLICE):
        words, groups = part.column("_w").flatten().flatten().dictionary_encode(), part.column(0).dictionary_encode("encode")
        kinds = len(words.dictionary)
        pairs, tf = np.unique(np.repeat(np.arange(len(sizes)), sizes) * kinds + words.indices.to_numpy(), return_counts=True)
        cells = groups.indices.to_numpy().astype(np.int64)[pairs // kinds] * kinds + pairs % kinds
        cells, of, df = np.unique(cells, return_inverse=True, return_counts=True)
        columns = [groups.dictionary.take(pa.array(cells // kinds)), words.dictionary.take(pa.array(cells % kinds))]
        columns += [pa.array(np.bincount(of, tf, len(cells)).astype(np.int64)), pa.array(df.astype(np.int64))]
        yield pa.record_batch(columns, names=["cluster", "word", "tf", "df"])


def assign_clusters(texts: DataFrame, idf: DataFrame, centres: DataFrame, key: str = "projectID", words: str = "words") -> DataFrame:
    """The nearest stored centre of each text by squared distance: ``(key, cluster, distance)``; of equally near ones
    the smallest cluster.

    Only words that a text and a centre share are looked at: ``|x|^2 - 2 x.c + |c|^2`` needs no others. Of the
    centres that share no word with a text the shortest is the nearest, so that one is a choice of every
    text. Words the model does not know are left out; a NULL list of words counts as empty. Distances are exact
    up to 2^53 millionths.

    Texts are stored in slices of about ``SLICE`` words. A slice asks for each of its words once, by a join with the
    model's words, and adds up the products of its texts."""
    kind = texts.schema[key].dataType.simpleString()
    own = texts.select(key, F.when(F.col(key).isNotNull(), _known(words)).alias("_w"))
    own = own.groupBy(key).agg(F.collect_list("_w").alias("_w"), F.count("*").alias("_rows"))
    packed = f"_slice long, _keys array<{kind}>, _rows array<long>, _sizes array<int>, _codes array<int>, _words array<string>"
    slices = stored(own.mapInArrow(_packed, packed), "slices")
    plain = centres.select("cluster", F.col("weight").cast("double").alias("c"))
    sizes = plain.groupBy("cluster").agg(F.sum(F.col("c") * F.col("c")).alias("cc"))
    numbered = with_rank(sizes.filter("cluster IS NOT NULL"), ["cluster"], "_no").withColumn("_no", F.col("_no").cast("int"))
    weights = centres.filter("weight <> 0").join(numbered, "cluster").groupBy("word")
    model = idf.join(weights.agg(F.collect_list("_no").alias("_in"), F.collect_list("weight").alias("_c")), "word", "left")
    asked = slices.select(F.col("_slice").alias("_of"), F.posexplode("_words").alias("_code", "word"))
    met = asked.join(model, "word").select("_of", "_code", F.col("idf").cast("long").alias("idf"), "_in", "_c")
    dots = slices.drop("_words").groupBy("_slice").cogroup(met.groupBy("_of")).applyInArrow(
        _products(key), f"`{key}` {kind}, _rows long, xx double, _no int, xc double"
    )
    choice = F.struct((F.col("cc") - 2 * F.col("xc")).alias("d"), "cluster")
    near = dots.join(numbered, "_no", "left").groupBy(key).agg(
        F.max("_rows").alias("_rows"), F.max("xx").alias("xx"), F.min(F.when(F.col("cc").isNotNull(), choice)).alias("near")
    )
    shortest = sizes.agg(F.min(F.struct(F.col("cc").alias("d"), "cluster"))).scalar()
    found = near.withColumn("_best", F.least(F.col("near"), shortest))
    found = found.select(key, F.col("_best.cluster").alias("cluster"), ((F.col("_best.d") + F.col("xx")) / 1e6).alias("distance"), "_rows")
    return found.withColumn("_rows", F.explode(F.sequence(F.lit(1).cast("long"), "_rows"))).drop("_rows")


def _packed(batches):
    """One row for each slice: its number, the keys, their rows, their numbers of words, all words by their places
    among the distinct ones, and those."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    def one(values):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    number = TaskContext.get().partitionId() << 32
    for part, sizes in _slices(batches, SLICE, empty=True):
        words = part.column("_w").flatten().flatten().dictionary_encode()
        columns = [part.column(0), part.column("_rows"), pa.array(sizes.astype(np.int32)), words.indices, words.dictionary]
        yield pa.record_batch([pa.array([number]), *map(one, columns)], names=["_slice", "_keys", "_rows", "_sizes", "_codes", "_words"])
        number += 1


def _products(key: str):
    """Rows key, rows, xx, number of a centre, xc of a slice and the model's rows of its words: one for each centre that a text
    shares a word with, or one without."""

    def run(slices, model):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        keys, rows, sizes, codes = (slices.column(c)[0].values for c in ("_keys", "_rows", "_sizes", "_codes"))
        sizes, codes = sizes.to_numpy(), codes.to_numpy().astype(np.int64)
        kinds = int(codes.max(initial=0)) + 1
        pairs, tf = np.unique(np.repeat(np.arange(len(sizes)), sizes) * kinds + codes, return_counts=True)
        places = np.full(kinds, -1)
        places[model.column("_code").to_numpy()] = np.arange(model.num_rows)
        place = places[pairs % kinds]
        text, place, tf = (pairs // kinds)[place >= 0], place[place >= 0], tf[place >= 0]
        x = tf.astype(float) * model.column("idf").to_numpy()[place]
        xx = np.bincount(text, x * x, len(sizes))

        def flat(name):
            return pc.list_flatten(model.column(name)).to_numpy()

        many = pc.fill_null(pc.list_value_length(model.column("_c")), 0).to_numpy().astype(np.int64)
        number, c = flat("_in").astype(np.int64), flat("_c").astype(float)
        centres = int(number.max(initial=0)) + 1
        each, begin = many[place], (np.cumsum(many) - many)[place]
        at = np.repeat(begin - (np.cumsum(each) - each), each) + np.arange(each.sum())
        cells, of = np.unique(np.repeat(text, each) * centres + number[at], return_inverse=True)
        xc = np.bincount(of, np.repeat(x, each) * c[at], len(cells))
        owner = cells // centres
        rest = np.setdiff1d(np.arange(len(sizes)), owner)
        owner = pa.array(np.r_[owner, rest].astype(np.int64))
        group, xc = (pa.concat_arrays([v, pa.nulls(len(rest), v.type)]) for v in (pa.array((cells % centres).astype(np.int32)), pa.array(xc)))
        return pa.table([keys.take(owner), rows.take(owner), pa.array(xx).take(owner), group, xc], names=[key, "_rows", "xx", "_no", "xc"])

    return run


def cluster_top_words(clusters: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most frequent words of each cluster as ``(topic, word)``."""
    counts = clusters.select("cluster", F.explode("words").alias("word")).groupBy("cluster", "word").count()
    best = W.partitionBy("cluster").orderBy(F.desc("count"), "word")
    top = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
    return top.select(F.concat(F.lit("topic_"), F.col("cluster")).alias("topic"), "word", "rank")
