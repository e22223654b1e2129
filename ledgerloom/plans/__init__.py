"""The bank's models: nine staging transforms and five marts, by name."""

from ledgerloom.plans.marts import MARTS
from ledgerloom.plans.staging import STAGING

MODELS = {**STAGING, **MARTS}

__all__ = ["MARTS", "MODELS", "STAGING"]
