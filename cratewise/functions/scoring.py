"""Scores that rank the release groups competing for a cluster."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base score of each release-group type. Any other type, or none, scores 0.
TYPE_SCORES = {
    "Album": 1000,
    "EP": 900,
    "Single": 800,
    "Soundtrack": 700,
    "Other": 600,
    "Broadcast": 500,
    "Audio Drama": 400,
    "Audiobook": 300,
    "Spokenword": 200,
    "Interview": 100,
    "Demo": 50,
    "Live": -1000,
    "Remix": -1100,
    "DJ-mix": -1200,
    "Mixtape/Street": -1300,
    "Compilation": -1400,
}

# Fixed value: extra points when release group and recording carry the same artist credit.
CREDIT_BONUS = 50


def type_score(type_name: Column | str) -> Column:
    name = F.col(type_name) if isinstance(type_name, str) else type_name
    branches = reduce(
        lambda chain, item: chain.when(name == item[0], F.lit(item[1])), TYPE_SCORES.items(), F
    )
    return branches.otherwise(F.lit(0))


def credit_bonus(release_group_credit: Column, recording_credit: Column) -> Column:
    """:data:`CREDIT_BONUS` on equal credits; an unknown credit on either side earns nothing."""
    return F.when(release_group_credit == recording_credit, F.lit(CREDIT_BONUS)).otherwise(F.lit(0))
