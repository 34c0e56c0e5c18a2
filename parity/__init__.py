"""Parity harness: the operators over the driver's tables, each next to independent SQL."""
