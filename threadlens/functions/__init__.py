"""Column expressions shared by the operators.  All are built-in Spark
functions composed on the JVM side (no Python UDFs), so they stay inside
whole-stage code generation."""

from threadlens.functions.ids import (  # noqa: F401
    base36_to_long, fullname, long_to_base36, stable_hash, strip_fullname, link_url)
from threadlens.functions.timefmt import (  # noqa: F401
    epoch_seconds, utc_date, utc_year, utc_month, minute_slot, second_slot,
    slot_start, format_mdy_hms, slot_of_epoch)
from threadlens.functions.text import html_title, title_head  # noqa: F401
