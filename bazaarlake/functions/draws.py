"""Seeded draws: every value is a hash of (seed, label, ids).

A draw does not depend on partitioning, on the order of rows or on retries, so a
lost task gives the same rows again.  One MD5 digest holds four 32-bit draws.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

DRAW_BITS = 32
_SLOTS = 4


def draw(seed: int, label: str, *ids: Column, slot: int = 0) -> Column:
    """A number in [0, 2^32)."""
    text = F.lit(f"{seed}|{label}")
    for i in ids:
        text = F.concat(text, F.lit("|"), i.cast("string"))
    digits = F.substring(F.md5(text), 1 + 8 * slot, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def draws(seed: int, label: str, count: int, *ids: Column) -> list[Column]:
    """``count`` draws that share as few digests as possible."""
    return [
        draw(seed, f"{label}{i // _SLOTS}", *ids, slot=i % _SLOTS)
        for i in range(count)
    ]


def constants(values: Sequence[int | str]) -> Column:
    """A constant array, parsed in one step."""
    cells = [str(v) if isinstance(v, int) else "'" + v.replace("'", "\\'") + "'" for v in values]
    return F.expr(f"array({', '.join(cells)})")


def between(h: Column, low: int, high: int) -> Column:
    return F.lit(low) + h % F.lit(high - low + 1)


def choice(h: Column, values: Column) -> Column:
    return F.element_at(values, (F.lit(1) + h % F.size(values)).cast("int"))


def weighted(h: Column, value_weights: Sequence[tuple]) -> Column:
    """A value as often as its weight says: a look-up in a constant list, one value per unit of weight."""
    units = [value for value, weight in value_weights for _ in range(weight)]
    return choice(h, constants(units))


def with_distinct_picks(
    df: DataFrame, name: str, hs: Sequence[Column], count: Column, weights: Sequence[int]
) -> DataFrame:
    """Add an array of ``count`` (one or more) different positions of ``weights``, picked one after another.

    Each position owns as many tickets as its weight says.  A draw names the n-th
    ticket among those not yet used up; it is found by stepping over the tickets of
    the earlier picks in rising order, so no list of the remaining ones is built.
    """
    tickets = [position for position, weight in enumerate(weights) for _ in range(weight)]
    first = [tickets.index(position) for position in range(len(weights))]
    owner, start, width = (constants(vs) for vs in (tickets, first, weights))

    def nth(values: Column, position: Column) -> Column:
        return F.element_at(values, (position + F.lit(1)).cast("int"))

    def step_over(ticket: Column, taken: Column) -> Column:
        return ticket + F.when(ticket >= nth(start, taken), nth(width, taken)).otherwise(F.lit(0))

    def add_pick(picked: Column, h: Column) -> Column:
        used = F.aggregate(picked, F.lit(0), lambda total, p: total + nth(width, p))
        ticket = (h % (F.lit(len(tickets)) - used)).cast("int")
        free = F.aggregate(F.sort_array(picked), ticket, step_over)
        return F.concat(picked, F.array(nth(owner, free)))

    # The draws are a column of their own, used twice, so that they are computed in
    # generated code and not inside the interpreted array functions.
    first_pick = F.array(nth(owner, F.element_at("_draws", 1) % F.lit(len(tickets))))
    picks = F.aggregate(F.slice("_draws", F.lit(2), count.cast("int") - 1), first_pick, add_pick)
    return df.withColumn("_draws", F.array(*hs)).withColumn(name, picks).drop("_draws")
