"""Evaluation measures. Each returns a one-row (or per-user) DataFrame; nothing is collected."""
