"""Text normalisation and length bucketing: the two halves of the cluster key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace of the normalisation contract is this ASCII set. Java's own \s also
# holds the vertical tab, which the contract deletes, so the set is spelled out.
_SPACE = r"\t\n\f\r "

# Fixed value: milliseconds per length bucket.
BUCKET_MS = 5000.0


def norm(text: Column | str) -> Column:
    """Lower-case, drop all but letters, numbers and whitespace, squeeze whitespace runs.

    There is no trim. Capital sigma is mapped by hand because Java lower-cases a word-final one to
    a different letter, and both sides of a lookup must agree byte for byte.
    """
    given = F.col(text) if isinstance(text, str) else text
    lowered = F.lower(F.replace(given, F.lit("Σ"), F.lit("σ")))
    kept = F.regexp_replace(lowered, rf"[^\p{{L}}\p{{N}}{_SPACE}]+", "")
    return F.regexp_replace(kept, rf"[{_SPACE}]+", " ")


def length_bucket(length_ms: Column | str) -> Column:
    """Five-second bucket of a length; an unknown length falls in bucket 0."""
    length = F.col(length_ms) if isinstance(length_ms, str) else length_ms
    return F.round(F.coalesce(length, F.lit(0)) / F.lit(BUCKET_MS))
