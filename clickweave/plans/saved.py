"""Named, described, reusable queries (the saved-query set)."""

from __future__ import annotations

from clickweave.plans import library

# Saved query names and descriptions.
SAVED_QUERIES = {
    "event_type_distribution": ("Count events by type", library.nq1_event_distribution),
    "daily_active_users": ("Count unique users per day", library.nq2_daily_active_users),
    "product_performance": ("Analyze product views and purchases",
                            library.nq3_product_performance),
}
