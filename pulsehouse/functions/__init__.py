"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage code generation."""

from pulsehouse.functions.columns import (  # noqa: F401
    behaviour_tags,
    count_if,
    day_key,
    epoch_ms,
    is_c_long_stay,
    is_d1_instant_exit,
    is_e1_fast_swipe,
    is_type,
    safe_ratio,
    stable_round,
    window_bounds,
)
