"""Masking of account and device identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of masked identifiers and the number of hash digits kept.
ACCOUNT_PREFIX = "ACC-SHA256-"
DEVICE_PREFIX = "DEV-SHA256-"
DIGITS_KEPT = 32


def mask_pii(identifier: Column, salt: str, prefix: str) -> Column:
    """Prefix plus the leading hex digits of a salted SHA-256. A missing identifier masks as an empty one."""
    salted = F.concat(F.lit(f"{salt}:"), F.coalesce(identifier, F.lit("")))
    return F.concat(F.lit(prefix), F.substring(F.sha2(salted, 256), 1, DIGITS_KEPT))
