"""Totals over bibliographic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kardex.functions import marc as MC


def criteria_combinations(bibs: DataFrame, features: str = "features", name: str = "all_criteria") -> DataFrame:
    """A5: number of bibs by the combination of criteria that they meet."""
    combination = F.array_join(MC.all_criteria(features), ", ").alias(name)
    return bibs.select(combination).groupBy(name).agg(F.count(F.lit(1)).alias("records"))


def entity_totals(bibs: DataFrame, mentions: str = "mentions", label: str = "PERSON") -> DataFrame:
    """In one row, bibs with a statement of responsibility, mentions of the
    label, and all other mentions."""
    def number(keep) -> Column:
        return F.coalesce(F.sum(F.size(F.filter(F.col(mentions), keep))), F.lit(0)).cast("long")

    return bibs.agg(F.count(F.get(MC.subfields("245", "c"), 0)).alias("texts"),
                    number(lambda m: m["label"] == label).alias("names"),
                    number(lambda m: m["label"] != label).alias("other_entities"))
