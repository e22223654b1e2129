"""Run-wide settings. Nothing in the package reads the wall clock: the caller states the business date."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from decimal import Decimal

BUSINESS_ZONE = "Asia/Jakarta"


@dataclass(frozen=True)
class Thresholds:
    """Business limits used by the staging models, the marts and the quality checks."""

    fraud_high_confidence: Decimal = Decimal("0.80")
    npl_dpd: int = 90
    dormant_days: int = 180
    max_null_rate_pct: float = 5.0
    max_duplicate_rate_pct: float = 0.1
    high_value_idr: int = 50_000_000


@dataclass(frozen=True)
class RunContext:
    """The clock, environment and limits of one run."""

    as_of: date
    as_of_ts: datetime | None = None
    env: str = "dev"
    invocation_id: str = "manual"
    # True takes dpd and outstanding balance from the account source where it has them;
    # False keeps the constant placeholders of the base specification.
    servicing: bool = False
    # True lets the finance mart estimate its distinct counts, which spares tripling the rows it shuffles.
    approximate_distinct: bool = False
    limits: Thresholds = field(default_factory=Thresholds)

    @property
    def now(self) -> datetime:
        return self.as_of_ts or datetime(self.as_of.year, self.as_of.month, self.as_of.day)


def resolve_execution_date(run_vars: dict | None, today: date) -> date:
    """Execution date from the run's variables; yesterday for a manual run."""
    value = (run_vars or {}).get("execution_date")
    if value is None:
        return today - timedelta(days=1)
    return value if isinstance(value, date) else date.fromisoformat(value)


def target_schema(env: str, default: str, custom: str | None = None) -> str:
    """Namespace of a model: production uses the plain name, every other environment a prefix."""
    if env == "prod":
        return custom.strip() if custom is not None else default
    prefix = "ci_" if env == "ci" else "dev_"
    return prefix + (custom.strip() if custom is not None else default)
