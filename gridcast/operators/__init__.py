"""DataFrame operators: resampling, series windows, joins, dedupe, validation, scoring, ML."""
