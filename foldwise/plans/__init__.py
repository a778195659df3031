"""Validation splits, Spark ML learners and the training flows that chain stages."""
