"""Column and frame functions: keys, predicates, cleaning, casts."""

from tidepool.functions.cleaning import (clean_raw_data, drop_columns,
                                         filter_not_null, project_to_target)
from tidepool.functions.keys import assign_id, content_key
from tidepool.functions.predicates import is_true, older_than

__all__ = [
    "assign_id", "clean_raw_data", "content_key", "drop_columns",
    "filter_not_null", "is_true", "older_than", "project_to_target",
]
