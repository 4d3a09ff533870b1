"""Typed report parameters (the procedures' scalar arguments)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Placeholder the claims reports print in columns the source system does not
# hold.  The original reports print a system-specific text here; set this to
# it to reproduce their output byte for byte.
NOT_AVAILABLE = "*NOT AVAILABLE*"

# How code parameters (branch, department, class, product, marketer) are
# compared with the data: "binary" (Spark's default) or "ci" -- case- and
# trailing-blank-insensitive, like the case-insensitive collation the original
# database typically runs with.
BINARY, CASE_INSENSITIVE = "binary", "ci"


@dataclass(frozen=True)
class ClaimsReportedParams:
    """R-01: claims notified in a period."""
    culture_id: int = 3
    branch: str | None = None
    department: str | None = None
    class_code: str | None = None      # accepted, never read (as in the reference)
    product: str | None = None
    date_from: dt.datetime | None = None
    date_to: dt.datetime | None = None
    placeholder: str = NOT_AVAILABLE
    string_compare: str = BINARY


@dataclass(frozen=True)
class ClaimsOutstandingParams:
    """R-02: claims still open at a date.

    ``fix_arms``: the reference's first arm tests the branch and department
    against a literal NULL, so it is always on and ignores both filters (a
    claim on a department can come out twice).  ``True`` applies the filters
    and makes the arms exclusive, as in R-01."""
    culture_id: int = 3
    branch: str | None = None
    department: str | None = None
    class_code: str | None = None      # accepted, never read
    product: str | None = None
    as_at: dt.datetime = dt.datetime(2000, 1, 1)
    run_ts: dt.datetime | None = None   # "now" for open claims' process period
    placeholder: str = NOT_AVAILABLE
    fix_arms: bool = False
    string_compare: str = BINARY


@dataclass(frozen=True)
class ClaimsSettledParams:
    """R-03: payouts approved in a period.

    ``fix_open_end``: with ``date_to`` NULL the reference's test is
    ``x < x`` and the report is empty; ``True`` leaves the period open."""
    culture_id: int = 3
    branch: str | None = None
    department: str | None = None      # accepted, never read
    class_code: str | None = None      # echoed only
    product: str | None = None
    date_from: dt.datetime | None = None
    date_to: dt.datetime | None = None
    placeholder: str = NOT_AVAILABLE
    fix_open_end: bool = False
    string_compare: str = BINARY


# fixed values: the policy id the reference's certificate pivot is pinned to
CERTIFICATE_POLICY_ID = 4679220840107265


@dataclass(frozen=True)
class DailyProductionParams:
    """R-04: written premium and commission per policy change.

    ``basic_date``: 'A' approval (no date test beyond the creation flag),
    'I' inception of the version, 'C' conclusion; anything else -> no rows.
    ``certificate_policy_id``: the certificate pivot is computed for this
    policy only (the reference's pinned id); ``None`` = every policy.
    ``fix_group_exclusion``: NOT IN over group ids without a NULL guard empties
    the report when one NULL id exists; ``True`` ignores NULL ids.
    ``fix_commission_nulls``: splits without commission drop out of
    ``SUM(gross - commission)``; ``True`` counts their commission as 0.
    ``fix_period_end``: transactions created the day after ``date_to`` are
    scanned (and can be summed into groups kept for other rows); ``True``
    stops the scan at ``date_to``."""
    sysown_id: int | None = 2
    branch: str | None = None
    dept: str | None = None            # accepted, never read
    class_code: str | None = None
    product: str | None = None
    marketer: str | None = None
    basic_date: str | None = "C"
    date_from: dt.datetime | None = None
    date_to: dt.datetime | None = None
    culture_id: int = 3
    user_id: int | None = None         # accepted, never read
    certificate_policy_id: int | None = CERTIFICATE_POLICY_ID
    fix_group_exclusion: bool = False
    fix_commission_nulls: bool = False   # count a missing commission as 0 in the net sums
    fix_period_end: bool = False         # do not scan one day past date_to
    string_compare: str = BINARY
