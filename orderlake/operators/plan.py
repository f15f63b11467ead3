"""The physical plan as text, for logs and for tests on plan shape."""

from __future__ import annotations

from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import DataFrame


def plan_text(rows: DataFrame, name: str = "", mode: str = "formatted") -> str:
    captured = StringIO()
    with redirect_stdout(captured):
        rows.explain(mode)
    title = f"== {name} ==\n" if name else ""
    return title + captured.getvalue()
