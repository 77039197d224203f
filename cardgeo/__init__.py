"""cardgeo: card-prefix (BIN) country inference on Spark DataFrames.

From card transactions, learn which countries each BIN is used in, keep the
top countries that reach a coverage target, apply minimum support, compare
the leading country with a vendor mapping, and publish monthly snapshots
with version history, data-quality reports and month-to-month drift.
"""

from .params import Params, validate_month
from .plans import Inference, infer, report

__all__ = ["Inference", "Params", "infer", "report", "validate_month"]
