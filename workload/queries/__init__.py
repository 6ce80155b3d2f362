"""Importing this package registers every query."""

from workload.queries import chains, columns, identity, keyed, lifetimes, payments, rides, sensors, streams, tables  # noqa: F401
