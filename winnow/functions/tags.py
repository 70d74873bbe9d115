"""Packed multi-value strings such as ``"WAR|DRAMA"``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"


def tokens(packed: Column) -> Column:
    return F.split(packed, r"\|")


# What becomes of characters of a tag in its column name.
SLUG_CHANGES = {"-": "_", "'": ""}


def slug(tag: str) -> str:
    """Column-name form of a tag."""
    return tag.lower().translate(str.maketrans(SLUG_CHANGES))


def slug_column(tag: Column) -> Column:
    out = F.lower(tag)
    for old, new in SLUG_CHANGES.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def flag(packed: Column, tag: str, mode: str = "substring") -> Column:
    """1 when ``tag`` occurs in the packed string, else 0.

    ``substring`` also matches inside longer tags; ``token`` compares whole tags.
    """
    if mode == "substring":
        hit = packed.contains(tag)
    elif mode == "token":
        hit = F.array_contains(tokens(packed), tag)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.coalesce(hit.cast("int"), F.lit(0))
