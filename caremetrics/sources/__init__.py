"""Typed readers, landing-directory writers and stand-in tables."""
