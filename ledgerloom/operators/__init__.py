"""Reusable DataFrame operators: pure, lazy, and none of them collects data to the driver."""
