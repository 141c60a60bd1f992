"""Row-level building blocks as Spark column expressions (all stay in generated code)."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")


def finite(value: Column) -> Column:
    """NaN and both infinities become NULL, the one marker for "missing"."""
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(_INF)), value)


def is_unusable(value: Column) -> Column:
    """True when a number is NULL, NaN or infinite (never NULL itself)."""
    return value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(_INF))


def cast_or_null(value: Column, type_name: str) -> Column:
    """Cast where possible, NULL where not (a plain cast throws in ANSI mode)."""
    return value.try_cast(type_name)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """a / b, missing whenever the result would not be a finite number."""
    return finite(F.try_divide(finite(numerator), finite(denominator)))


def log_plus_one(value: Column) -> Column:
    """ln(1 + x); missing for x <= -1."""
    return F.log1p(value)


def standardize(value: Column, mean: float, std: float) -> Column:
    """(x - mean) / std; a constant column (std 0) is only centred."""
    return (value - F.lit(float(mean))) / F.lit(float(std) if std else 1.0)


def bin_right_closed(value: Column, edges: Sequence[float], labels: Sequence[int]) -> Column:
    """Label of the interval (lo, hi] that holds the value; missing outside all intervals."""
    if len(labels) != len(edges) - 1:
        raise ValueError("labels must be one fewer than edges")
    if any(hi <= lo for lo, hi in zip(edges, edges[1:])):
        raise ValueError("edges must increase")
    # When chains take the first hit, so each step only has to test its upper edge.
    known = finite(value) if not math.isinf(edges[-1]) else F.when(~F.isnan(value), value)
    chain = F.when(known <= F.lit(float(edges[0])), F.lit(None))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(known <= F.lit(float(upper)), F.lit(label))
    return chain.cast("int")


def merge_values(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values in one step (a replaced value is not looked up again)."""
    if not mapping:
        return value
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, value), value)


def one_hot(value: Column, vocabulary: Iterable[str], unknown: str = "ignore") -> dict[str, Column]:
    """One 0/1 double per known value. ``unknown="error"`` makes an unseen value fail the job."""
    if unknown not in {"ignore", "error", "infrequent_if_exist"}:
        raise ValueError(f"unknown handling {unknown!r} is not supported")
    known = list(vocabulary)
    source = value
    if unknown == "error":
        message = F.concat(F.lit("unknown category: "), F.coalesce(value, F.lit("NULL")))
        source = F.when(value.isin(known), value).otherwise(F.raise_error(message).cast("string"))
    return {k: F.coalesce((source == F.lit(k)).cast("double"), F.lit(0.0)) for k in known}


def rbf_similarity(point: Sequence[Column], centre: Sequence[float], gamma: float) -> Column:
    """exp(-gamma * squared distance to a centre), centres as literals."""
    if len(point) != len(centre):
        raise ValueError("point and centre differ in length")
    squares = [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(point, centre)]
    total = squares[0]
    for square in squares[1:]:
        total = total + square
    return F.exp(F.lit(-float(gamma)) * total)


def sanitize_name(name: str) -> str:
    """Only letters, digits and underscores survive; the rest turns into underscores."""
    return re.sub(r"\W", "_", name, flags=re.ASCII)


def sanitize_names(names: Sequence[str | None]) -> list[str]:
    """Sanitised names; nameless columns get a number; two names must not fall together."""
    clean = [sanitize_name(n) if n else f"feature_{i}" for i, n in enumerate(names)]
    clashes = sorted({n for n in clean if clean.count(n) > 1})
    if clashes:
        raise ValueError(f"columns fall together after sanitising: {clashes}")
    return clean
