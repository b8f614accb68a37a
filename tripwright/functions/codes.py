"""Counters from sample codes and names of driving events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwright.schemas import (
    COLLISION_CODES,
    DRIVING_EVENT_CODES,
    LANE_CODES,
    MASK_COUNTERS,
)


def mask_flags(em: str = "em") -> dict[str, str]:
    """SQL text of a 0/1 flag per abnormal-driving bit of the mask column.

    A NULL or non-positive mask sets nothing.
    """
    return {
        name: f"if({em} > 0, shiftright({em}, {bit}) & 1, 0)"
        for bit, name in enumerate(MASK_COUNTERS)
    }


def assist_flags(ldw: str = "ldw", fcw: str = "fcw") -> dict[str, str]:
    """SQL text of 0/1 flags for lane-departure and forward-collision codes."""
    lanes = {name: f"if({ldw} = {code}, 1, 0)" for name, code in LANE_CODES.items()}
    collisions = {name: f"if({fcw} = {code}, 1, 0)" for name, code in COLLISION_CODES.items()}
    return {**lanes, **collisions}


def sample_flags(em: str = "em", ldw: str = "ldw", fcw: str = "fcw") -> dict[str, str]:
    return {**mask_flags(em), **assist_flags(ldw, fcw)}


def event_code(name: Column) -> Column:
    """Number of a driving-event name, 0 for unknown names."""
    pairs = [x for n, c in DRIVING_EVENT_CODES.items() for x in (F.lit(n), F.lit(c))]
    return F.coalesce(F.create_map(*pairs)[name], F.lit(0))


def event_name(code: Column) -> Column:
    """Name of a driving-event number, NULL for unknown numbers."""
    pairs = [x for n, c in DRIVING_EVENT_CODES.items() for x in (F.lit(c), F.lit(n))]
    return F.create_map(*pairs)[code]
