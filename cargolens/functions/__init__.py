"""Column expressions."""

from .classes import combined_class, combined_score, concentration_class, dependence_class, growth_class
from .dates import month_date, month_label, month_name, month_number, year_of
from .numbers import amount_per_tonne, clean_number, freight_cost, growth_pct, half_even, percent, to_number
from .text import map_units, normalize_text, shorten

__all__ = [
    "amount_per_tonne",
    "clean_number",
    "combined_class",
    "combined_score",
    "concentration_class",
    "dependence_class",
    "freight_cost",
    "growth_class",
    "growth_pct",
    "half_even",
    "map_units",
    "month_date",
    "month_label",
    "month_name",
    "month_number",
    "normalize_text",
    "percent",
    "shorten",
    "to_number",
    "year_of",
]
