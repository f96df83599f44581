from wiremap.functions.columns import (  # noqa: F401
    ID_SEPARATOR, fill_unknown, format_time, set_label, sorted_set, stable_id,
    to_ltz, asc_last, desc_last,
)
