"""ledgerloom: customer loyalty and churn analytics as lazy Spark plans."""

from ledgerloom.config import Settings

__all__ = ["Settings"]
