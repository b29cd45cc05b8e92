"""Who is who: groups and their approvers, identities behind addresses and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_members(roster: DataFrame, history: DataFrame, overlay: DataFrame, group: str, name: str) -> DataFrame:
    """Members of each group: those of the roster, of the history where the roster has none, and of the overlay.

    Names that differ in case only are one (``id``); the smallest spelling stands for it.
    """
    rest = history.join(roster.select(group).distinct(), group, "left_anti")
    both = roster.select(group, name).unionByName(rest.select(group, name)).unionByName(overlay.select(group, name))
    return both.where(F.col(name).isNotNull()).groupBy(group, F.lower(name).alias("id")).agg(F.min(name).alias(name))


def resolved(people: DataFrame, email: str, person: str) -> DataFrame:
    """Addresses that belong to one person only: an address of several resolves to nobody."""
    held = people.groupBy(F.lower(email).alias(email)).agg(F.countDistinct(person).alias("_n"), F.min(person).alias(person))
    return held.where("_n = 1").drop("_n")


def token_key(name: Column) -> Column:
    """First and last word of a name, lower-cased, without signs and without a suffix such as Jr or III; null for one word."""
    bare = F.regexp_replace(F.lower(name), "[^a-z ]", "")
    words = F.filter(F.split(F.regexp_replace(F.trim(bare), " (jr|sr|ii|iii|iv)$", ""), " +"), lambda w: w != "")
    return F.when(F.size(words) > 1, F.concat_ws(" ", F.get(words, F.lit(0)), F.element_at(words, -1)))


def by_name_tokens(df: DataFrame, name: str, roster: DataFrame, full_name: str, person: str) -> DataFrame:
    """``df`` with the person whose first and last name it has; a key that several have stands for nobody."""
    keyed = roster.select(token_key(F.col(full_name)).alias("_key"), person).where("_key IS NOT NULL")
    only = keyed.groupBy("_key").agg(F.countDistinct(person).alias("_n"), F.min(person).alias(person)).where("_n = 1").drop("_n")
    return df.withColumn("_key", token_key(F.col(name))).join(only, "_key", "left").drop("_key")
