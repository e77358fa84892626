"""Column-level building blocks (dates, ratios, text, e-mail)."""

from .columns import (EMAIL_PATTERN, as_of_date, flag, is_valid_email, minutes_between,
                      report_date, safe_ratio)
from .text import KEYWORD_GROUPS, clean_text_col, keyword_bucket, keyword_group_col

__all__ = [
    "EMAIL_PATTERN", "KEYWORD_GROUPS", "as_of_date", "clean_text_col", "flag",
    "is_valid_email", "keyword_bucket", "keyword_group_col", "minutes_between",
    "report_date", "safe_ratio",
]
