"""Operators for training data: each works on whole tables and whole texts."""
