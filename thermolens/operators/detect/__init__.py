"""Anomaly detectors D1-D16."""
