"""Land, read and tidy regulatory filings with Spark."""

from finfilings.plans.balances import get_balance_sheets, import_balance_sheets, read_balance_sheets, tidy_balance_sheets
from finfilings.plans.indicators import get_ifdata_registry, get_ifdata_values, read_ifdata_registry, read_ifdata_values
from finfilings.plans.institutions import get_institutions, tidy_institutions
from finfilings.plans.normative import get_normative_data, get_normative_txt
from finfilings.session import build_session

__all__ = [
    "build_session",
    "get_balance_sheets",
    "get_ifdata_registry",
    "get_ifdata_values",
    "get_institutions",
    "get_normative_data",
    "get_normative_txt",
    "import_balance_sheets",
    "read_balance_sheets",
    "read_ifdata_registry",
    "read_ifdata_values",
    "tidy_balance_sheets",
    "tidy_institutions",
]
