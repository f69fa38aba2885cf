"""Civic document analytics as composable Spark DataFrame functions."""
