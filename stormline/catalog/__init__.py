"""Registered queries: every operator applied to the driver's tables, with its SQL."""
