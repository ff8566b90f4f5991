"""Valuation counts."""

from navspan.operators import prepare as p


def valuation_count(key):
    """Rows from the as-of start row to the current row, both included."""
    return p.frame_rows(key)


def range_count(key):
    """Rows dated from the anchor of the key to the current date."""
    return p.rows_in_range(key)
