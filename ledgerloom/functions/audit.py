from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.config import RunContext
from ledgerloom.functions.dates import ts_lit


def audit_columns(ctx: RunContext, model: str, prefix: str = "dbt_") -> dict[str, Column]:
    """Run metadata for the end of a mart; literals, so they cost nothing until written."""
    return {
        f"{prefix}updated_at": ts_lit(ctx.now),
        f"{prefix}invocation_id": F.lit(ctx.invocation_id),
        f"{prefix}model_name": F.lit(model),
        f"{prefix}target": F.lit(ctx.env),
    }
