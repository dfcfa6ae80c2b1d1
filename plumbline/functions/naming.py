"""Names of checks and what can be read out of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name prefixes of the four generic checks.
GENERIC_PREFIXES = ("not_null_", "unique_", "accepted_values_", "relationships_")

# Fixed value: longest message kept in the history.
MESSAGE_LENGTH = 1000

# A generic check names its table with the first two words after the prefix.
_TABLE_WORDS = 2

_UNPREFIXED = f"^(?:{'|'.join(GENERIC_PREFIXES)})(.*)$"


def null_rate_check_name(table_name: str, column_name: str) -> str:
    return f"null_rate_drift__{table_name}__{column_name.replace(' ', '_')}"


def short_name(unique_id: Column) -> Column:
    """The check's own name, the third dotted part of ``kind.project.name[.hash]``."""
    parts = F.split(unique_id, r"\.")
    return F.coalesce(F.get(parts, F.lit(2)), F.nullif(unique_id, F.lit("")), F.lit("unknown"))


def last_segment(unique_id: Column) -> Column:
    """The last dotted part, which is a hash for generic checks."""
    return F.coalesce(
        F.nullif(F.element_at(F.split(unique_id, r"\."), -1), F.lit("")), F.lit("unknown")
    )


def _words(unique_id: Column) -> Column:
    remainder = F.regexp_extract(F.get(F.split(unique_id, r"\."), F.lit(2)), _UNPREFIXED, 1)
    return F.when(remainder != "", F.split(remainder, "_"))


def table_of(unique_id: Column) -> Column:
    """Table named by a generic check id; empty for any other id."""
    words = F.slice(_words(unique_id), 1, _TABLE_WORDS)
    return F.coalesce(F.array_join(words, "_"), F.lit(""))


def column_of(unique_id: Column) -> Column:
    """Column named by a generic check id; empty for any other id."""
    words = _words(unique_id)
    rest = F.slice(words, F.lit(_TABLE_WORDS + 1), F.greatest(F.size(words), F.lit(1)))
    return F.coalesce(F.array_join(rest, "_"), F.lit(""))


def kept_message(message: Column) -> Column:
    return F.substring(F.coalesce(message, F.lit("")), 1, MESSAGE_LENGTH)
