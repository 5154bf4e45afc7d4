"""Runs in tiers: what is new is written by itself, and merged with older runs as they add up.

Once a tier would hold `FAN` runs they become one of the next tier, so there are
few runs after any number of writes, and a row is written again once per tier.
"""

from __future__ import annotations

# So many runs of a tier become one of the next.
FAN = 4


def due(runs: list[dict]) -> tuple[list[dict], int]:
    """The runs that a new one is to be merged with, and its tier then."""
    taken, tier = [], 0
    while len(full := [run for run in runs if run["tier"] == tier]) >= FAN - 1:
        taken, tier = taken + full, tier + 1
    return taken, tier
