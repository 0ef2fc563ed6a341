"""Error policy for rows that cannot be read."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
POLICIES = ("skip", "warn", "fail")


def policy_name(policy: str) -> str:
    """Unknown names fall back to ``skip``."""
    name = policy.lower()
    if name not in POLICIES:
        log.warning("unknown error policy %r, using 'skip'", policy)
        return "skip"
    return name


def apply_policy(df: DataFrame, ok: Column, policy: str = "skip", message: Column | None = None) -> DataFrame:
    """Rows where ``ok`` holds. ``skip`` and ``warn`` drop the others, ``fail`` stops the job.

    For ``warn`` the dropped rows are available through :func:`rejected`.
    """
    good = F.coalesce(ok, F.lit(False))
    if policy_name(policy) == "fail":
        text = message if message is not None else F.lit("row could not be read")
        return df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
    return df.where(good)


def rejected(df: DataFrame, ok: Column) -> DataFrame:
    """The rows a ``warn`` run reports."""
    return df.where(~F.coalesce(ok, F.lit(False)))
