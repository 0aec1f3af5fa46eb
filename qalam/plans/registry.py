"""All registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from qalam.plans import corpus, evaluation, io, runs, tokens

    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    out.update(corpus.QUERIES)
    out.update(runs.QUERIES)
    out.update(evaluation.QUERIES)
    out.update(tokens.QUERIES)
    out.update(io.QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    from qalam.plans import oracle

    out: dict[str, str] = {}
    out.update(oracle.corpus_oracles())
    out.update(oracle.run_oracles())
    out.update(oracle.eval_oracles())
    out.update(oracle.io_oracles())
    out.update(oracle.token_oracles())
    return out
