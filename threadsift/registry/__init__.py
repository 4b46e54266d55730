"""Registered queries: each pairs a Spark job with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadsift.registry.inputs import Inputs, oracle_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a job under a name, with the SQL that must give equal rows."""

    def register(job: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: job(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle_text(oracle)
        return job

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from threadsift.registry import (  # noqa: F401
        documents,
        evaluation,
        mail_rules,
        mutations,
        outcomes,
        replies,
        scans,
        states,
        texts,
    )
