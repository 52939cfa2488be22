from .joins import combine, enrich, on_rules, restrict
from .measures import (
    AIR,
    IMPACT_COLUMNS,
    LATE,
    MEASURED,
    ON_TIME,
    OTS_NAMES,
    SOT_NAMES,
    cond_sum,
    finish,
    finish_wide,
    impact_measures,
    impact_sums,
    measures_by,
    on_time_ratio,
    ots_sums,
    plain_sum,
    roll_up,
    sot_sums,
    sums_of_sums,
)
from .quantiles import box_plots, five_numbers, five_of_counts, value_counts
from .shape import (
    beside,
    domain_of,
    nth_level,
    nulls_to_text,
    peek,
    percent_texts,
    relabel,
    stack,
)
from .spine import domain_frame, month_vs_ytd, on_spine, sql_text
from .topk import first_rows, read_snapshot_date, snapshot_date, top_k, top_n

__all__ = [
    "AIR",
    "IMPACT_COLUMNS",
    "LATE",
    "MEASURED",
    "ON_TIME",
    "OTS_NAMES",
    "SOT_NAMES",
    "beside",
    "combine",
    "cond_sum",
    "domain_frame",
    "domain_of",
    "enrich",
    "finish",
    "finish_wide",
    "first_rows",
    "box_plots",
    "five_numbers",
    "five_of_counts",
    "value_counts",
    "impact_measures",
    "impact_sums",
    "measures_by",
    "month_vs_ytd",
    "nth_level",
    "nulls_to_text",
    "on_rules",
    "on_spine",
    "on_time_ratio",
    "ots_sums",
    "peek",
    "percent_texts",
    "plain_sum",
    "read_snapshot_date",
    "relabel",
    "restrict",
    "roll_up",
    "snapshot_date",
    "sql_text",
    "sot_sums",
    "sums_of_sums",
    "stack",
    "top_k",
    "top_n",
]
