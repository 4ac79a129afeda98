"""Readers and the mapping of the driver tables onto the sales and retail models."""
