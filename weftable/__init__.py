"""Alignment and comparison of multi-regional input-output tables on Spark."""

from weftable.plans.comparison import compare_accounts, compare_folder, write_source
from weftable.plans.flat import align_flat, align_flat_folder, reference_value_added
from weftable.plans.weighted import align_weighted, read_release
from weftable.plans.wide import align_wide, align_wide_folder
from weftable.schemas import Accounts

__all__ = [
    "Accounts",
    "align_flat",
    "align_flat_folder",
    "align_weighted",
    "align_wide",
    "align_wide_folder",
    "compare_accounts",
    "compare_folder",
    "read_release",
    "reference_value_added",
    "write_source",
]
