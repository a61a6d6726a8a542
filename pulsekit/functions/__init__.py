from pulsekit.functions.columns import (
    age_bin, gender_label, safe_ratio, on_day, between_days, before_day_after,
    stable_hash32, stable_uniform, hash_bucket, poisson1_draw, POISSON1_CDF,
)
from pulsekit.functions.pvalues import student_t_pvalue, normal_pvalue, t_pvalue_np, normal_pvalue_np

__all__ = [
    "age_bin", "gender_label", "safe_ratio", "on_day", "between_days", "before_day_after",
    "stable_hash32", "stable_uniform", "hash_bucket", "poisson1_draw", "POISSON1_CDF",
    "student_t_pvalue", "normal_pvalue", "t_pvalue_np", "normal_pvalue_np",
]
