"""Readers of landed JSON and CSV, and the layer and snapshot writers."""
