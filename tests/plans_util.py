"""Reading physical plans in tests."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
