"""Column expressions; all of them stay inside the JVM unless stated otherwise."""

from shelfpulse.functions.dates import age_days, created_day, day_of, epoch_to_text
from shelfpulse.functions.labels import CATEGORIES, FALLBACK, label_by_rules, labels_by
from shelfpulse.functions.text import clean_text, enabled_keys, join_field, join_list

__all__ = [
    "CATEGORIES",
    "FALLBACK",
    "age_days",
    "clean_text",
    "created_day",
    "day_of",
    "enabled_keys",
    "epoch_to_text",
    "join_field",
    "join_list",
    "label_by_rules",
    "labels_by",
]
