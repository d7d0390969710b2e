"""Models, calibration, explanations and survival regression on MLlib and distributed aggregates."""
