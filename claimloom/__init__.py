"""Health-payer deliveries to clean claims tables, as Spark DataFrame operators."""

from claimloom.payer import DEFAULT_PROFILE, PayerProfile

__all__ = ["DEFAULT_PROFILE", "PayerProfile"]
