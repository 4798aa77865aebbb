"""The analysis inputs as views over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscape.operators.participation import flagged_participations, merge_participations
from fundscape.operators.relevance import select_relevant
from fundscape.operators.scoring import minmax_scale, row_mean, weighted_sum
from fundscape.session import stored
from fundscape.sources import read_table

PREFIXES = ("1-", "2-")
PATTERN = r"\b(license|worthless)\b"
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "for", "on", "with", "as", "are", "this", "by",
    "de", "la", "le", "les", "des", "et", "der", "die", "das", "und", "el", "los", "las", "que",
)
STEMS = ("tion", "ment", "ing")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a test table."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as projects, with the document of the same number as objective."""
    orders = table(spark, sf_dir, "orders")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("objective"))
    status = (
        F.when(F.col("o_orderstatus") == "F", "closed")
        .when(F.col("o_orderstatus") == "O", "Signed")
        .otherwise("TERMINATED")
    )
    return orders.join(docs, orders.o_orderkey == docs.doc_id, "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("topics"),
        "objective",
        status.alias("status"),
        F.col("o_totalprice").alias("totalCost"),
    )


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as participations of suppliers."""
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_orderkey").alias("projectID"),
            F.col("l_suppkey").alias("organisationID"),
            F.col("l_linenumber").alias("order"),
            F.col("n_name").alias("country"),
            F.col("l_extendedprice").alias("ecContribution"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("netEcContribution"),
            (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("totalCost"),
        )
    )


def relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_relevant(projects(spark, sf_dir), prefixes=PREFIXES, pattern=PATTERN)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_participations(organizations(spark, sf_dir), relevant(spark, sf_dir), drop=("id",))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged_participations(organizations(spark, sf_dir), relevant(spark, sf_dir))


def gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer balances per nation as the denominator."""
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
    return joined.groupBy(F.col("n_name").alias("iso2")).agg(F.sum("c_acctbal").alias("2023"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").filter("n_regionkey <> 4").select(F.col("n_name").alias("country"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each member nation with the next one of its region as peer, where both have suppliers."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").filter("n_regionkey <> 4").join(suppliers, "n_nationkey", "left_semi")
    peer = nation.select(F.col("n_name").alias("peer"), (F.col("n_nationkey") - 5).alias("n_nationkey"))
    return nation.join(peer, "n_nationkey").select(F.col("n_name").alias("country"), "peer")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def shifted_names(spark: SparkSession, sf_dir: str, by: int) -> DataFrame:
    """Every nation's name under the code of the nation ``by`` places on, so that the first
    nations' codes have no name: ``(code, name)``."""
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        F.concat(F.lit("NATION_"), F.col("n_nationkey") + by).alias("code"),
        F.concat(F.lit("Nation no. "), F.col("n_nationkey")).alias("name"),
    )


# Weights of the scaled order metrics; they sum to 1.
ORDER_WEIGHTS = {"price": 0.35, "lines": 0.1, "quantity": 0.2, "discount": 0.1, "tax": 0.05, "suppliers": 0.2}


def order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with metrics of their line items, scaled, and both scores."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"),
        F.avg("l_tax").alias("tax"), F.countDistinct("l_suppkey").alias("suppliers"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    wide = stored(orders.join(lines, "o_orderkey").withColumn("order_id", F.col("o_orderkey").cast("string")).drop("o_orderkey"), "orders")
    scaled = minmax_scale(wide, list(ORDER_WEIGHTS))
    names = {f"{m}_scaled": w for m, w in ORDER_WEIGHTS.items()}
    return weighted_sum(row_mean(scaled, list(names)), names)
