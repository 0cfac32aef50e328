"""Composed plans: feature profiles, future rows, forecasting and evaluation flows."""
