"""Point tables, coefficient tables, fixtures and sinks."""

from .points import PointSet, points_from_array, points_from_columns

__all__ = ["PointSet", "points_from_array", "points_from_columns"]
