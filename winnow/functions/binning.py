"""Interval bins as expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def right_closed(value: Column, upper_edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(previous edge, edge]``; the last label is open-ended."""
    if len(labels) != len(upper_edges) + 1:
        raise ValueError("need one label more than edges")
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(upper_edges, labels):
        out = out.when(value <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def left_closed_index(value: Column, edges: Sequence[float]) -> Column:
    """How many edges are at or below the value."""
    out = F.lit(0)
    for edge in edges:
        out = out + (value >= edge).cast("int")
    return out


def histogram_bin(value: Column, edges: Column) -> Column:
    """0-based bin of an ascending edge array: left-closed, the last bin closed.

    Values outside the edges are put into the first or the last bin.
    """
    at_or_below = F.size(F.filter(edges, lambda e: value >= e)) - 1
    return F.greatest(F.lit(0), F.least(at_or_below, F.size(edges) - 2))


def histogram_bin_of(value: Column, edges: Sequence[Column], size: Column) -> Column:
    """``histogram_bin`` for edges in columns, null beyond the ``size`` that a row has."""
    at_or_below = F.lit(-1)
    for edge in edges:
        at_or_below = at_or_below + F.coalesce((value >= edge).cast("int"), F.lit(0))
    return F.greatest(F.lit(0), F.least(at_or_below, size - 2))
