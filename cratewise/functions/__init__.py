"""Pure ``Column -> Column`` building blocks; no UDFs, everything stays in the JVM."""

from cratewise.functions.dates import UNKNOWN_DATE, repair_date
from cratewise.functions.links import (
    has_provider,
    history_identifier,
    url_identifier,
    url_provider,
    wikidata_id,
)
from cratewise.functions.scoring import CREDIT_BONUS, TYPE_SCORES, credit_bonus, type_score
from cratewise.functions.text import length_bucket, norm

__all__ = [
    "CREDIT_BONUS",
    "TYPE_SCORES",
    "UNKNOWN_DATE",
    "credit_bonus",
    "has_provider",
    "history_identifier",
    "length_bucket",
    "norm",
    "repair_date",
    "type_score",
    "url_identifier",
    "url_provider",
    "wikidata_id",
]
