"""Bulk and streaming scoring helpers (inventory 2.12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis import schemas as S

_WS = "[\\s\\x1c-\\x1f]"


def strip_text(c: str | Column) -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, f"(?U)^{_WS}+|{_WS}+$", "")


def request_validity(df: DataFrame, text: str = "clinical_text") -> DataFrame:
    """``flt_request_valid`` / ``score_reject_invalid``: stripped length
    must be 1..5000; adds ``valid`` and a rejection ``reason``. A missing
    text is invalid, not unknown."""
    n = F.length(strip_text(text))
    return df.select("*", F.coalesce(n.between(S.REQUEST_MIN_CHARS, S.REQUEST_MAX_CHARS), F.lit(False)).alias("valid"),
                     F.when(F.col(text).isNull(), F.lit("missing"))
                      .when(n < S.REQUEST_MIN_CHARS, F.lit("empty"))
                      .when(n > S.REQUEST_MAX_CHARS, F.lit("too_long")).alias("reason"))


def probability_map(labels: Sequence[str], prob_col: str = "probability") -> Column:
    """Class -> probability map from a probability vector, labels in index
    order (alphabetical, as the label indexer assigns them)."""
    from pyspark.ml.functions import vector_to_array
    return F.map_from_arrays(F.array(*[F.lit(l) for l in labels]), vector_to_array(F.col(prob_col)))


def confidence(prob_map: str | Column = "probabilities") -> Column:
    """``score_confidence``: the largest class probability."""
    col = F.col(prob_map) if isinstance(prob_map, str) else prob_map
    return F.array_max(F.map_values(col))
