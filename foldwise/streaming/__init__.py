"""Fitted stages applied to streaming DataFrames."""
