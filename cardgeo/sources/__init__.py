"""Sources: the transactions scan, the vendor mapping, test-table views."""

from .adapters import tx_from_tables, vendor_dup_from_tables, vendor_from_tables
from .transactions import read_transactions, read_vendor, vendor_from_rows

__all__ = [
    "read_transactions",
    "read_vendor",
    "tx_from_tables",
    "vendor_dup_from_tables",
    "vendor_from_rows",
    "vendor_from_tables",
]
