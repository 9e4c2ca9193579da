"""Choosing items of ordered arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body uses it, also inside the functions it passes to arrays."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def even_positions(n: Column, count: int) -> Column:
    """Positions of count items spread evenly over n, both ends included, rounded half to even; all positions if n is not larger."""
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    spread = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.rint(i * (n - 1) / F.lit(max(1, count - 1))).cast("int"))
    return F.when(n <= count, every.cast("array<int>")).when(n > count, spread)


def even_sample(values: Column, count: int) -> Column:
    """The items of an array at even_positions; null for a null array, none for an empty one."""
    return F.transform(even_positions(F.size(values), count), lambda i: F.get(values, i))


def even_values(start: Column | float, end: Column | float, count: int) -> Column:
    """count numbers from start to end in equal steps; their middle for one or none."""
    a, b = F.lit(start).cast("double"), F.lit(end).cast("double")
    if count <= 1:
        return F.array((a + b) / 2)
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: a + (b - a) * i / F.lit(float(count - 1)))


def prefix_endpoint(n: Column, ratio: Column) -> Column:
    """The last position of a prefix that holds ratio of n items: rounded half to even, 4 at least, within the sequence."""
    last = n - 1
    return F.least(last, F.greatest(F.lit(4), F.rint(last * ratio).cast("int")))


def prefix_sample(values: Column, ratio: Column, count: int = 5) -> Column:
    """Items spread evenly over such a prefix."""
    return even_sample(F.slice(values, F.lit(1), prefix_endpoint(F.size(values), ratio) + 1), count)


def active_keys(tracks: Column) -> Column:
    """The keys, as ascending numbers, of a map's entries whose list isn't empty; a null list counts as empty."""
    live = F.map_filter(tracks, lambda _, v: F.coalesce(F.size(v), F.lit(0)) > 0)
    return F.array_sort(F.transform(F.map_keys(live), lambda k: k.cast("long")))
