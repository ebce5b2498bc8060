"""Registered queries: each one is a Spark plan over the landed tables plus, where SQL can state it,
the equivalent DuckDB SQL used as the correctness oracle."""

from tidings.plans.registry import ORACLES, QUERIES, load_all  # noqa: F401
