"""Business and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text hashed in place of a NULL key part.
NULL_KEY_PART = "_null_"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the key parts as text; never NULL."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def joined_key(*parts: Column | str) -> Column:
    """Key parts as text joined with dashes; NULL as soon as one part is NULL."""
    texts: list[Column] = []
    for part in parts:
        if texts:
            texts.append(F.lit("-"))
        texts.append(_col(part).cast("string"))
    return F.concat(*texts)
