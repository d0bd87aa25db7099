"""Queries on the driver's tables, their SQL checks, and the plan of stages."""
