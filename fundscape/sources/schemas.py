"""Declared schemas. Money columns are text: they are parsed explicitly."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


PROJECT = T.StructType(
    [T.StructField("id", T.LongType())]
    + _strings(
        "acronym", "status", "title", "totalCost", "ecMaxContribution", "legalBasis", "topics",
        "ecSignatureDate", "frameworkProgramme", "masterCall", "subCall", "nature", "objective",
        "contentUpdateDate", "rcn", "grantDoi",
    )
)

ORGANIZATION = T.StructType(
    [T.StructField("projectID", T.LongType())]
    + _strings("projectAcronym")
    + [T.StructField("organisationID", T.LongType())]
    + _strings(
        "vatNumber", "name", "shortName", "SME", "activityType", "street", "postCode", "city",
        "country", "nutsCode", "geolocation", "organizationURL", "contactForm", "contentUpdateDate",
        "rcn", "order", "role", "ecContribution", "netEcContribution", "totalCost",
        "endOfParticipation", "active",
    )
)

GDP = T.StructType(
    _strings("Country Name", "Country Code", "Indicator Name", "Indicator Code", "2023")
)

COUNTRY_SCORES = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("Weighted_Score", T.DoubleType()),
        T.StructField("ramp", T.DoubleType()),
        T.StructField("is_average", T.BooleanType()),
    ]
)

KEYPHRASES = T.StructType(
    [
        T.StructField("project_id", T.StringType()),
        T.StructField("phrases", T.ArrayType(T.StringType())),
    ]
)

IMPORTANCE = T.StructType(
    [T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]
)

PROJECTIONS = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("draw", T.IntegerType()),
        T.StructField("years", T.ArrayType(T.IntegerType())),
        T.StructField("score_current", T.ArrayType(T.DoubleType())),
        T.StructField("score_improved", T.ArrayType(T.DoubleType())),
        T.StructField("top_country", T.StringType()),
        T.StructField("explanation", T.StringType()),
        T.StructField("summary", T.StringType()),
    ]
)

# The four tables a dashboard reads, by name.
DASHBOARD = {
    "country_scores": COUNTRY_SCORES,
    "project_keyphrases": KEYPHRASES,
    "feature_importance": IMPORTANCE,
    "country_projections": PROJECTIONS,
}
