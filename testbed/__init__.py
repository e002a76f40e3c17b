"""Queries over the driver tables: place-shaped adapters, registry, SQL oracle."""
