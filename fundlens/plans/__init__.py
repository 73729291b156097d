"""Composed analyses: reporting views, reports, forecasting, anomaly and segmentation models."""
