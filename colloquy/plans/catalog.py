"""The registry behind ``__spark_entry__``."""

from __future__ import annotations

from colloquy.plans import evaluation, extra, history, modelling, oracle, queries, streams

MODULES = (evaluation, modelling, history, streams, extra)


def all_queries() -> dict:
    """Every registered query: name -> fn(spark, sf_dir)."""
    out = dict(queries.EXACT)
    for mod in MODULES:
        out.update(mod.EXACT)
    return out


def all_oracles() -> dict:
    """The DuckDB SQL of every query."""
    out = dict(oracle.SQL)
    for mod in MODULES:
        out.update(mod.SQL)
    return out
