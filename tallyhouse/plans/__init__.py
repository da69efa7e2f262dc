"""The named datasets: staging, audit, marts, cohort, and the refresh job."""

from tallyhouse.plans.reference import (  # noqa: F401
    ISSUE_CATALOG,
    issue_catalog,
    ref_allowed_age_group,
    ref_allowed_status,
)
from tallyhouse.plans.staging import stg_orders, stg_products, stg_users  # noqa: F401
from tallyhouse.plans.audit import data_quality_issues, issues_long  # noqa: F401
from tallyhouse.plans.marts import (  # noqa: F401
    category_performance,
    category_totals,
    monthly_revenue,
    monthly_revenue_by_country,
    user_metrics,
    user_segments,
)
from tallyhouse.plans.cohort import cohort_activity_long, cohort_retention  # noqa: F401
from tallyhouse.plans.job import published_run, refresh  # noqa: F401
