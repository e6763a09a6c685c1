"""Run parameters.  ``as_of`` replaces every ``current_date``/``current_timestamp``
so that a build is deterministic and testable.  The dates of a run have no
defaults; those of the test tables are in :mod:`monthwise.fixture`."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

EXACT = "exact"          # reproduce the reference's behaviour, quirks included
CORRECTED = "corrected"  # opt-in fixes (see README, "Semantics")


@dataclass(frozen=True)
class Params:
    as_of: dt.datetime                             # the run's "now"
    spine_start: dt.date                           # first month of the calendar
    open_end: dt.date = dt.date(2099, 1, 1)        # stand-in end for open subscriptions
    # "now" of single sources, where it is not as_of: ((system, table), clock)
    clocks: tuple = field(default_factory=tuple)
    events_mark: dt.datetime | None = None         # last loaded event time; None = full load
    session_gap_minutes: int = 30
    # incremental SCD2 query: snapshot up to here, later log rows merged in
    scd2_cutoff: dt.datetime | None = None
    mode: str = EXACT
    # CRM account id = prefix || app organization id (the reference's guessed key)
    account_key_prefix: str = "a_"

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    def clock(self, system: str, table: str) -> dt.datetime:
        """'now' for a source table: ``as_of`` unless the run names another."""
        return dict(self.clocks).get((system, table), self.as_of)

    @property
    def spine_end(self) -> dt.date:
        """Last month of the calendar spine: the month of ``as_of``.

        The reference asks for ``dateadd(month, 1, date_trunc('month', today))``
        as an *exclusive* end, so the current month is the last one kept."""
        return dt.date(self.as_of.year, self.as_of.month, 1)
