"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The key is the hex MD5 of the listed columns cast to text,
# joined with '-', with NULL replaced by this sentinel text.  They must stay
# as they are for keys to agree with the published marts.
KEY_SEPARATOR = "-"
KEY_NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """Hex MD5 over the columns in order (NULL-safe)."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                        F.lit(KEY_NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
