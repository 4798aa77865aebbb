"""Joining organisations to projects, and who collaborates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscape.constants import MERGE_DROP, MERGE_RENAME, MONEY_COLUMNS
from fundscape.functions import parse_eu_number


def merge_participations(
    orgs: DataFrame,
    projects: DataFrame,
    org_key: str = "projectID",
    project_key: str = "id",
    drop: Sequence[str] = MERGE_DROP,
    rename: Mapping[str, str] = MERGE_RENAME,
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Inner join of participations to their projects (one project, many rows).

    Columns both sides have get a suffix, then columns are dropped and renamed;
    missing ones are ignored. A project id that occurs twice multiplies its rows."""
    shared = (set(orgs.columns) & set(projects.columns)) - {org_key, project_key}
    left = orgs.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = projects.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    if org_key == project_key:
        joined = left.join(right, org_key)
    else:
        joined = left.join(right, left[org_key] == right[project_key])
    return joined.drop(*drop).withColumnsRenamed(dict(rename))


def parse_money(df: DataFrame, cols: Sequence[str] = MONEY_COLUMNS) -> DataFrame:
    """Parse the money columns that are present and still text."""
    texts = [f.name for f in df.schema.fields if f.name in cols and isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: parse_eu_number(F.col(c)) for c in texts})


def countries_per_project(
    df: DataFrame, project_col: str = "projectID", country_col: str = "country", out: str = "n_countries"
) -> DataFrame:
    """Distinct countries of each project; a NULL country is none."""
    known = df.filter(F.col(project_col).isNotNull())
    return known.groupBy(project_col).agg(F.countDistinct(country_col).alias(out))


def collab_by_project(
    df: DataFrame, project_col: str = "projectID", country_col: str = "country", out: str = "is_collab"
) -> DataFrame:
    """Whether each project has more than one country, one row per project.

    The distinct count runs as hash aggregates over (project, country) pairs, which are
    merged before the shuffle and spread over all tasks, so a project with very many
    rows sends a few rows per task."""
    counts = countries_per_project(df, project_col, country_col, "_n")
    return counts.select(project_col, (F.col("_n") > 1).alias(out))


def collab_flag(
    df: DataFrame, project_col: str = "projectID", country_col: str = "country", out: str = "is_collab"
) -> DataFrame:
    """Add the flag to every participation row."""
    flags = collab_by_project(df, project_col, country_col, out)
    joined = df.join(flags, project_col, "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(False)))


def flagged_participations(
    orgs: DataFrame,
    projects: DataFrame,
    org_key: str = "projectID",
    project_key: str = "id",
    country_col: str = "country",
    out: str = "is_collab",
    **merge: object,
) -> DataFrame:
    """``merge_participations`` followed by ``collab_flag``, planned as one.

    All rows of a kept project survive the inner join, so the flag can be found from
    the organisations alone, of kept projects only, and ride along on the project side:
    the large side is then shuffled once in full, not twice."""
    ids = projects.select(F.col(project_key).alias(org_key))
    members = orgs.select(org_key, country_col).join(ids, org_key, "left_semi")
    flags = collab_by_project(members, org_key, country_col, out).withColumnRenamed(org_key, "_flag_key")
    flagged = projects.join(flags, F.col(project_key) == F.col("_flag_key"), "left").drop("_flag_key")
    merged = merge_participations(orgs, flagged, org_key, project_key, **merge)
    return merged.withColumn(out, F.coalesce(out, F.lit(False)))
