"""Hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column) -> Column:
    """md5 over the columns' text joined by ``-``; a NULL counts as empty text.

    Pass timestamps without zone so that the text does not depend on the session.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
