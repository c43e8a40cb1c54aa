"""Business measures and classifications, each defined once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vendora.functions import fixed_values as V


def gmv(amount: Column | str) -> Column:
    """Delivered-only amount, as an aggregate."""
    return amount_where("is_delivered", amount)


def gmv_all(amount: Column | str) -> Column:
    """Amount over every order status, as an aggregate."""
    return F.sum(_column(amount))


def amount_where(flag: Column | str, amount: Column | str) -> Column:
    return F.sum(F.when(_column(flag), _column(amount)).otherwise(F.lit(0)))


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def is_true(condition: Column) -> Column:
    """A two-valued flag: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def region_of(state: Column, regions: dict[str, list[str]], other: str) -> Column:
    by_state = {code: name for name, codes in regions.items() for code in codes}
    return label_of(state, by_state, other)


def label_of(value: Column, labels: dict[str, str], other: str) -> Column:
    pairs = [F.lit(text) for item in labels.items() for text in item]
    return F.coalesce(F.create_map(*pairs)[value], F.lit(other))


def is_core_state(state: Column) -> Column:
    return is_true(state.isin(V.CORE_STATES))


def weight_tier(grams: Column) -> Column:
    heavy, medium, light, unknown = V.WEIGHT_TIERS
    return (
        F.when(grams >= V.HEAVY_FROM_G, heavy)
        .when(grams >= V.MEDIUM_FROM_G, medium)
        .when(grams > 0, light)
        .otherwise(unknown)
    )


def first_level(value: Column, levels: list[tuple[float, str]], lowest: Column | str) -> Column:
    """Label of the first limit that ``value`` reaches; limits come highest first."""
    (limit, label), *rest = levels
    chain = F.when(value >= limit, label)
    for limit, label in rest:
        chain = chain.when(value >= limit, label)
    return chain.otherwise(lowest)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r >= 3) & (f >= 3) & (m >= 3), V.SEGMENT_HIGH_VALUE)
        .when((r <= 1) & (m >= 3), V.SEGMENT_WIN_BACK)
        .when((r >= 3) & (m <= 1), V.SEGMENT_NEW)
        .when((r <= 1) & (f <= 1), V.SEGMENT_LOST)
        .otherwise(V.SEGMENT_GENERAL)
    )


def rfm_segment_with_keep(r: Column, f: Column, m: Column) -> Column:
    """The written specification's rules, which know one more segment."""
    return (
        F.when((r >= 3) & (f >= 3) & (m >= 3), V.SEGMENT_HIGH_VALUE)
        .when((r >= 3) & (m >= 3), V.SEGMENT_KEEP)
        .when((r <= 2) & (m >= 3), V.SEGMENT_WIN_BACK)
        .when((r >= 3) & (f <= 2), V.SEGMENT_NEW)
        .otherwise(V.SEGMENT_GENERAL)
    )


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lng = F.radians(lng2 - lng1) / 2
    chord = F.sin(half_lat) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lng) ** 2
    return F.lit(2 * V.EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
