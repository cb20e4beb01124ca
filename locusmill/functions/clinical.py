"""Clinical significance text and review stars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusmill.functions.basics import literal_map
from locusmill.vocabulary import GOLD_STARS


def status_text(statuses: Column) -> Column:
    """Distinct statuses joined by a comma, those with a leading ``_`` last."""
    keyed = F.transform(
        F.array_distinct(statuses),
        lambda s: F.struct(F.regexp_replace(s, "^_", "z").alias("key"), s.alias("status")),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda k: k["status"]), ",")


def gold_stars(review_status: Column) -> Column:
    """0 to 4; NULL for an unknown status, so that callers can count rejects."""
    return literal_map(GOLD_STARS)[review_status]
