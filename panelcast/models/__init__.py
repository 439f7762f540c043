"""Spark ML estimators and models for panels, all with save and load."""
