"""Threshold grammar and verdicts.

A threshold is a comparator directly followed by a non-negative integer, e.g.
``'> 0'``, ``'!=0'``, ``'>= 5'``. ``==``, decimals, negatives and templated
expressions are rejected at build time, before any job is planned.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted comparators.
COMPARATORS = ("=", "!=", ">", ">=", "<", "<=")

_PATTERN = re.compile(r"^\s*(!=|>=|<=|=|>|<)\s*(\d+)\s*$")


class ThresholdError(ValueError):
    pass


def parse_threshold(expr: str) -> tuple[str, int]:
    if expr is None:
        raise ThresholdError("threshold is required")
    text = str(expr)
    if "${{" in text or "{{" in text:
        raise ThresholdError(f"templated threshold not allowed: {text!r}")
    if "==" in text:
        raise ThresholdError(f"'==' is not a valid comparator: {text!r}")
    m = _PATTERN.match(text)
    if not m:
        raise ThresholdError(
            f"threshold must be a comparator and a non-negative integer: {text!r}")
    return m.group(1), int(m.group(2))


def threshold_column(value: Column, expr: str) -> Column:
    """Boolean column: does ``value`` meet threshold ``expr``."""
    op, n = parse_threshold(expr)
    lit = F.lit(n)
    return {
        "=": value == lit,
        "!=": value != lit,
        ">": value > lit,
        ">=": value >= lit,
        "<": value < lit,
        "<=": value <= lit,
    }[op]


def threshold_eval(value: Column, expr: str) -> Column:
    """Null-safe: a null value never meets a threshold."""
    return F.coalesce(threshold_column(value, expr), F.lit(False))


def verdict(value: Column, warn: str | None = "> 0", error: str | None = "> 0") -> Column:
    """error met -> FAILED, else warn met -> WARNING, else SUCCEEDED (error wins)."""
    out = F.lit("SUCCEEDED")
    if warn is not None:
        out = F.when(threshold_eval(value, warn), F.lit("WARNING")).otherwise(out)
    if error is not None:
        out = F.when(threshold_eval(value, error), F.lit("FAILED")).otherwise(out)
    return out


def severity_downgrade(verdict_col: Column, treat_failure_as_warning: Column | bool = True) -> Column:
    flag = treat_failure_as_warning if isinstance(treat_failure_as_warning, Column) \
        else F.lit(bool(treat_failure_as_warning))
    return F.when((verdict_col == "FAILED") & flag, F.lit("WARNING")).otherwise(verdict_col)
