"""Conforming the survey tables: surveys, seines, fish and sites into season tables.

The wide survey-seine table is small next to the fish table; it is put together first, so the fish
rows are shuffled once, on ``seine_id``. Products that only need fish counts combine the fish by
seine before this join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.functions.dates import sampling_week
from brinewave.functions.labels import sampling_week_label
from brinewave.functions.nulls import complete
from brinewave.operators.joins import lookup_join, null_safe_join

TOTALS = ["so_total", "pi_total", "cu_total", "co_total", "he_total", "ck_total"]


def survey_seines(surveys: DataFrame, seines: DataFrame, sites: DataFrame) -> DataFrame:
    """Surveys with their seines (surveys without a seine kept), site attributes, year and week."""
    joined = complete(surveys, ["survey_id"]).join(complete(seines, ["seine_id"]), "survey_id", "left")
    joined = lookup_join(joined, sites, "site_id", ["site_name", "region", "zone"])
    week = sampling_week("survey_date")
    return joined.withColumns(
        {
            "year": F.year("survey_date"),
            "yday": F.dayofyear("survey_date"),
            "week_number": week,
            "sampling_week": sampling_week_label(week),
        }
    )


def seine_attributes(ss: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The seine-level columns to attach to fish; seine_id is unique here."""
    return complete(ss, ["seine_id"]).select("seine_id", *columns)


def fish_with_survey(fish: DataFrame, ss: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fish with survey attributes; fish of unknown seines are kept with nulls."""
    return complete(fish, ["ufn"]).join(seine_attributes(ss, columns), "seine_id", "left")


def counted_by_seine(
    fish: DataFrame, ss: DataFrame, by: Sequence[str], columns: Sequence[str], aggregates: Sequence
) -> DataFrame:
    """Aggregate fish by seine first, then attach survey attributes.

    A seine with a very large catch shrinks to a few rows on the map side before anything moves.
    """
    small = fish.groupBy("seine_id", *by).agg(*aggregates)
    return small.join(seine_attributes(ss, columns), "seine_id", "left")


def star(surveys: DataFrame, seines: DataFrame, fish: DataFrame, lice: DataFrame) -> DataFrame:
    """Survey, seine, fish and lice in one chain of left joins from the lice down.

    Shared columns other than the join key would join naturally; here they are the key.
    """
    located = seines.join(surveys, "survey_id", "left")
    hosts = fish.join(located, "seine_id", "left")
    return null_safe_join(lice, hosts, ["ufn", "seine_id"], "left")
