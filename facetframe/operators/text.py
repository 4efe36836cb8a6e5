"""Token match over text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from facetframe.functions.predicates import has_token


def token_filter(df: DataFrame, text_col: str, token: str) -> DataFrame:
    """Rows whose text has the token as a whole word of letters and digits, ignoring case."""
    return df.filter(has_token(text_col, token))
