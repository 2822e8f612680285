"""Spark-native preparation and scoring of time-series forecasting data."""
