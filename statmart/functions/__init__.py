"""Scalar Column helpers: coercion, ratios, rounding, names, lookups."""
