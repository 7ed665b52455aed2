"""DataFrame -> DataFrame operators of the staging, silver and gold layers."""

from frostlake.operators.filters import fault_or_breach, live_non_null, nan_to_null
from frostlake.operators.gold import GOLD_TABLES, gold_table, gold_tables
from frostlake.operators.silver import SilverRules, cast_sensors, derived_columns, silver
from frostlake.operators.staging import drop_exact_duplicates, drop_missing_critical, staging

__all__ = [
    "GOLD_TABLES",
    "SilverRules",
    "cast_sensors",
    "derived_columns",
    "drop_exact_duplicates",
    "drop_missing_critical",
    "fault_or_breach",
    "gold_table",
    "gold_tables",
    "live_non_null",
    "nan_to_null",
    "silver",
    "staging",
]
