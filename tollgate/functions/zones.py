"""Instants and wall clocks.

Stamps are ``TIMESTAMP_NTZ``: an instant is its wall clock in UTC, a stamp is
the wall clock of a zone.  From an instant there is exactly one stamp.  The
other way round a stamp may occur twice (clocks set back) or never (set
forward); which instant is meant is a parameter here, not the session's zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARLIER, LATER = "earlier", "later"
SHIFT, NULL = "shift", "null"
_DAY = "INTERVAL 1 DAY"


def _ntz(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def wall_clock(instant: Column | str, zone: str) -> Column:
    """The zone's wall clock at an instant (UTC)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _ntz(instant))


def _candidates(stamp: Column, zone: str) -> tuple[Column, Column]:
    """The instant by the offset of the day before, and by that of the day
    after: they differ around a change of the offset only."""
    out = []
    for other in (stamp - F.expr(_DAY), stamp + F.expr(_DAY)):
        out.append(stamp + (F.convert_timezone(F.lit(zone), F.lit("UTC"), other) - other))
    return out[0], out[1]


def is_repeated(stamp: Column | str, zone: str) -> Column:
    """TRUE where the stamp occurs twice."""
    stamp = _ntz(stamp)
    before, after = _candidates(stamp, zone)
    return (before != after) & (wall_clock(before, zone) == stamp) & (wall_clock(after, zone) == stamp)


def is_skipped(stamp: Column | str, zone: str) -> Column:
    """TRUE where the stamp never occurs."""
    stamp = _ntz(stamp)
    before, after = _candidates(stamp, zone)
    return (wall_clock(before, zone) != stamp) & (wall_clock(after, zone) != stamp)


def instant_of(stamp: Column | str, zone: str, repeated: str = EARLIER, skipped: str = SHIFT) -> Column:
    """The instant of a zone's wall clock.

    ``repeated`` picks the earlier or the later of two instants.  A skipped
    stamp is read by the offset before the change (``shift``: half an hour into
    the gap is half an hour after it) or gives NULL (``null``)."""
    if repeated not in (EARLIER, LATER) or skipped not in (SHIFT, NULL):
        raise ValueError(f"repeated is {EARLIER} or {LATER}, skipped {SHIFT} or {NULL}")
    stamp = _ntz(stamp)
    before, after = _candidates(stamp, zone)
    fits_before, fits_after = wall_clock(before, zone) == stamp, wall_clock(after, zone) == stamp
    pick = F.least if repeated == EARLIER else F.greatest
    return (F.when(fits_before & fits_after, pick(before, after)).when(fits_before, before).when(fits_after, after)
            .otherwise(before if skipped == SHIFT else F.lit(None).cast("timestamp_ntz")))
