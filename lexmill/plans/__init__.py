"""Runnable queries over the driver tables, each paired with its SQL check."""
