"""Ratios, intervals, bins, conversions and order-book arithmetic. Null in, null out, unless the docstring says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_METRES = 6_371_000.0
Z_95 = 1.959963984540054


def safe_ratio(n: Column, d: Column) -> Column:
    """n / d where d is above zero, else null."""
    return F.when(d > 0, n / d)


def effective_field_goal(made: Column, threes: Column, attempted: Column) -> Column:
    return safe_ratio(made + 0.5 * threes, attempted)


def possessions(attempted: Column, free_throws: Column, offensive_rebounds: Column, turnovers: Column) -> Column:
    return attempted + 0.44 * free_throws - offensive_rebounds + turnovers


def per_100(x: Column, possession_count: Column) -> Column:
    return 100 * safe_ratio(x, possession_count)


def points_add_up(points: Column, made: Column, threes: Column, free_throws: Column) -> Column:
    return points == 2 * made + threes + free_throws


def is_integral(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")) & (x == F.floor(x)), F.lit(False))


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """x within bounds; null stays null (greatest and least would skip it)."""
    y = x
    if low is not None:
        y = F.greatest(y, F.lit(float(low)))
    if high is not None:
        y = F.least(y, F.lit(float(high)))
    return F.when(x.isNotNull(), y)


def as_feature(x: Column) -> Column:
    """FLOAT; NaN and infinities become null."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x).cast("float")


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    rad = F.radians
    h = F.pow(F.sin((rad(lat2) - rad(lat1)) / 2), 2) + F.cos(rad(lat1)) * F.cos(rad(lat2)) * F.pow(F.sin((rad(lon2) - rad(lon1)) / 2), 2)
    return F.when(h.isNotNull(), 2 * EARTH_METRES * F.asin(F.least(F.lit(1.0), F.sqrt(h))))  # least would skip a null


def in_box(lat: Column, lon: Column, centre_lat: Column, centre_lon: Column, half_km: float) -> Column:
    """Whether a point lies in the box of half_km to each side of a centre."""
    d = half_km / 111.32
    return (F.abs(lat - centre_lat) <= d) & (F.abs(lon - centre_lon) <= d / F.cos(F.radians(centre_lat)))


def wilson(wins: Column, n: Column) -> tuple[Column, Column]:
    """Bounds of the 95 % Wilson interval; null where n is not above zero."""
    p, z2 = wins / n, Z_95 * Z_95
    middle, half = p + z2 / (2 * n), Z_95 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    return F.when(n > 0, (middle - half) / (1 + z2 / n)), F.when(n > 0, (middle + half) / (1 + z2 / n))


def shrink(wins: Column, n: Column, prior: Column, weight: float = 20) -> Column:
    return (wins + weight * prior) / (n + weight)


def laplace(wins: Column, n: Column) -> Column:
    return (wins + 1) / (n + 2)


def decimal_odds(american: Column) -> Column:
    return F.when(american > 0, 1 + american / 100).when(american < 0, 1 - 100 / american)


def complement_price(bid: Column) -> Column:
    return 1 - bid


def bins(x: Column, edges: Sequence[float], labels: Sequence[str], unknown: str = "unknown", closed: str = "left") -> Column:
    """labels[i] up to edges[i]; closed='left' puts an edge into the bin above it, 'right' into the one below."""
    out = F.when(x.isNull(), unknown)
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(x < edge if closed == "left" else x <= edge, label)
    return out.otherwise(labels[-1])


def celsius(fahrenheit: Column) -> Column:
    return (fahrenheit - 32) * 5 / 9


def kmh(mph: Column) -> Column:
    return mph * 1.609344


def kilograms(pounds: Column) -> Column:
    return pounds * 0.45359237


# The defaults of the next two functions.
def style_class(share: Column, games: Column, plays: Column, high: float = 0.62, low: float = 0.45, least_games: int = 3, least_plays: int = 100) -> Column:
    enough = (games >= least_games) & (plays >= least_plays)
    return F.when(~F.coalesce(enough, F.lit(False)) | share.isNull(), "insufficient").when(share >= high, "high").when(share <= low, "low").otherwise("balanced")


def robust_scale(std: Column, fallback: Column) -> Column:
    """std or the fallback, but not below 0.5 or a quarter of the fallback."""
    return F.greatest(F.coalesce(std, fallback), F.lit(0.5), 0.25 * fallback)


def interval(prediction: Column, scale: Column, q_low: Column, q_high: Column) -> tuple[Column, Column]:
    """Bounds of the calibrated interval, not below zero."""
    return clip(prediction + q_low * scale, low=0), clip(prediction + q_high * scale, low=0)


def book_levels(text: Column, high: str = "1") -> Column:
    """ARRAY<STRUCT<price, size>> of JSON pairs [[price, size], ...]; null where malformed, a price repeats or is out of bounds; size 0 is no level."""
    pairs = F.from_json(text, "array<array<string>>")
    number = lambda x: x.try_cast("decimal(38,18)")
    levels = F.transform(pairs, lambda p: F.struct(number(F.get(p, F.lit(0))).alias("price"), number(F.get(p, F.lit(1))).alias("size")))
    sound = F.forall(levels, lambda x: x["price"].isNotNull() & x["size"].isNotNull() & (x["price"] >= 0) & (x["price"] <= F.lit(high).cast("decimal(38,18)")) & (x["size"] >= 0))
    sound = sound & F.forall(pairs, lambda p: F.size(p) == 2) & (F.size(F.array_distinct(F.transform(levels, lambda x: x["price"]))) == F.size(levels))
    return F.when(sound, F.filter(levels, lambda x: x["size"] > 0))


def book_stats(bids: Column, asks: Column) -> Column:
    """STRUCT(best_bid, best_ask, bid_size, ask_size, bid_levels, ask_levels, spread); spread only where the book isn't crossed."""
    prices = lambda side: F.transform(side, lambda x: x["price"])
    total = lambda side: F.aggregate(side, F.lit(0).cast("decimal(38,18)"), lambda a, x: (a + x["size"]).cast("decimal(38,18)"))
    bid, ask = F.array_max(prices(bids)), F.array_min(prices(asks))
    return F.struct(bid.alias("best_bid"), ask.alias("best_ask"), total(bids).alias("bid_size"), total(asks).alias("ask_size"), F.size(bids).alias("bid_levels"), F.size(asks).alias("ask_levels"), F.when(ask >= bid, ask - bid).alias("spread"))


def sorted_set_json(values: Column) -> Column:
    return F.to_json(F.array_sort(F.array_distinct(values)))


def json_list(text: Column) -> Column:
    return F.from_json(text, "array<string>")


def shared_names(a: Column, b: Column) -> Column:
    """What two arrays have in common, sorted; empty where one is null."""
    return F.array_sort(F.coalesce(F.array_intersect(a, b), F.array().cast("array<string>")))
