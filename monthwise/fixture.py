"""Parameters that fit the driver's test tables (FIXTURES.md): their orders end in
2001 and their events cover January 2024, so the events tables have a clock of their own."""

from __future__ import annotations

import datetime as dt

from monthwise.params import Params

EVENTS_AS_OF = dt.datetime(2024, 2, 1)

FIXTURE = Params(
    as_of=dt.datetime(2002, 1, 1),
    spine_start=dt.date(1995, 1, 1),
    clocks=((("app_db", "events"), EVENTS_AS_OF), (("app_db", "sessions"), EVENTS_AS_OF)),
    events_mark=dt.datetime(2024, 1, 15),
    scd2_cutoff=dt.datetime(1999, 6, 30),
)
