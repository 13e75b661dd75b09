"""Table and partition names."""

from __future__ import annotations


def namespace(env: str, layer: str) -> str:
    """Database of a layer: ``{env}_{layer}``, dashes in ``env`` as underscores."""
    return f"{env.replace('-', '_')}_{layer}"


def table_name(env: str, layer: str, table: str, catalog: str | None = None) -> str:
    """``[catalog.]{env}_{layer}.{table}``."""
    parts = [namespace(env, layer), table]
    return ".".join([catalog, *parts] if catalog else parts)
