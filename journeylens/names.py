"""Column names shared by every module."""

USER = "user_guid"
VISIT_TS = "attribution_visit_start_time"
CONV_TS = "conversion_visit_timestamp"
FLAG = "converting_visit"
TOUCHPOINT = "touchpoint"

# The cohort key: every operator groups by it instead of looping over days, types and windows.
COHORT = ["run_date", "conversion_type", "conversion_window"]
JOURNEY = COHORT + [USER, "journey_no"]

# Window name -> look-back in days. Both ends count, so the look-back is one day longer.
WINDOWS = {30: 31, 60: 61, 90: 91}

MODELS = {
    "last_click": "attribution_last_click_heuristic",
    "first_click": "attribution_first_click_heuristic",
    "position_based": "attribution_position_based_heuristic",
    "time_decay": "attribution_time_decay_heuristic",
    "markov": "attribution_markov_algorithmic",
}

START, CONVERSION, NULL_STATE = "(start)", "(conversion)", "(null)"
