"""Layered models (bronze, silver, gold), analyses, and the runner."""
