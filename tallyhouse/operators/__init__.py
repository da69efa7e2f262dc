"""Reusable DataFrame → DataFrame operators."""

from tallyhouse.operators.dedup import keep_best  # noqa: F401
from tallyhouse.operators.profile import (  # noqa: F401
    duplicates,
    key_counts,
    key_report,
    orphans,
    profile,
    profile_with_code,
    to_long,
)
from tallyhouse.operators.ranges import rank_by, row_numbers  # noqa: F401
from tallyhouse.operators.series import mom_growth  # noqa: F401
from tallyhouse.operators.segments import SEGMENT_RULES, segment  # noqa: F401
from tallyhouse.operators.cohort import cohort_activity, cohort_sizes, pivot_cohort  # noqa: F401
