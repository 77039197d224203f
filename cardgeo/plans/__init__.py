"""Plans: the composed inference, publication, the query registry and its SQL oracle."""

from .inference import Inference, infer, report
from .publish import (
    DataQualityError,
    PublishResult,
    flag_violations,
    publish_month,
    publish_months,
    publish_months_from_counts,
)

__all__ = ["DataQualityError", "Inference", "PublishResult", "flag_violations", "infer",
           "publish_month", "publish_months", "publish_months_from_counts", "report"]
