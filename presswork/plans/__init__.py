"""Whole flows: feed -> bronze, bronze -> silver, silver -> gold."""
