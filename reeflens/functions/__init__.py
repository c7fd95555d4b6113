"""Column-level helpers: NULL rules, factor recodes, name cleaning."""

from .labels import (collapse_species, commercial_label, history_label, lat_band, level_order,
                     period_label, recode, taxon_label, with_factor, within_key)
from .names import clean_name, clean_names, drop_first_column, with_clean_names
from .semantics import (ifelse_na, in_set, mean_na, mean_strict, n_distinct_na,
                        n_rows, nan_to_null, not_in_set, paste_na, round_half_even, safe_div, sd_na,
                        sum_na0, sum_strict, to_double)

__all__ = [
    "clean_name", "clean_names", "collapse_species", "commercial_label", "drop_first_column", "history_label", "ifelse_na", "in_set", "lat_band", "level_order",
    "mean_na", "mean_strict", "n_distinct_na", "n_rows", "nan_to_null", "not_in_set", "paste_na",
    "period_label", "recode", "round_half_even", "safe_div", "sd_na", "sum_na0",
    "sum_strict", "taxon_label", "to_double", "with_clean_names", "with_factor", "within_key",
]
