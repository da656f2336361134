"""Content hash of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(columns: Sequence[str], length_prefixed: bool = False) -> Column:
    """SHA-256 over the columns' text, '||' between them and 'NULL' for a missing value.

    The plain form cannot tell 'a||b' from 'a','b', nor the text 'NULL' from a missing value;
    ``length_prefixed`` writes each length first and can.
    """
    texts = [F.col(c).cast("string") for c in columns]
    if length_prefixed:
        parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    else:
        parts = [F.coalesce(t, F.lit("NULL")) for t in texts]
    return F.sha2(F.concat_ws("||", *parts), 256)
