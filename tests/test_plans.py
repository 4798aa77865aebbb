"""Properties of plans that matter at scale."""

import __spark_entry__ as entry
from fundscape.functions import starts_with_any
from fundscape.operators import keyphrases
from fundscape.plans import queries, views
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefix_filter_reaches_the_scan(spark):
    text = plan(entry.queries()["prefix_filter"](spark, SF).select("topics"))
    assert "FileScan" in text
    orders = views.table(spark, SF, "orders").filter(starts_with_any(F.col("o_orderpriority"), views.PREFIXES))
    assert "StringStartsWith(o_orderpriority,1-)" in plan(orders)


def test_scan_reads_only_needed_columns(spark):
    text = plan(entry.queries()["minmax_scale"](spark, SF).select("l_discount_scaled"))
    assert "ReadSchema: struct<l_discount:double>" in text and "Exchange hashpartitioning" not in text


def test_counting_phrases_needs_no_shuffle_of_its_own(spark):
    text = plan(queries._candidates(spark, SF))
    assert text.count("Exchange hashpartitioning") == 1 and "hashpartitioning(doc_id" in text


def test_few_candidates_enter_the_second_shuffle(spark):
    every = queries._scored_phrases(spark, SF)
    some = queries._scored_phrases(spark, SF, 20)
    few, many = some.count(), every.count()
    assert few < many / 2
    assert keyphrases.phrase_topk(some, 20, "doc_id").exceptAll(keyphrases.phrase_topk(every, 20, "doc_id")).isEmpty()


def test_wide_participations_are_scanned_and_shuffled_once(spark):
    text = plan(queries.collab_flag(spark, SF))
    wide = [x for x in text.splitlines() if "FileScan parquet" in x and "l_linenumber" in x]
    assert len(wide) == 1


def test_top_terms_is_a_bounded_top_k(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_terms"](spark, SF))
