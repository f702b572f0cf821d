"""Assembled plans: silver/gold builds over the driver tables, the query
registry and its SQL oracle."""
