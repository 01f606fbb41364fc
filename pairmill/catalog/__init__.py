"""The queries of the check tool: a Spark form and, where SQL can say it, a SQL form."""

from __future__ import annotations

from pairmill.catalog import registry


def load() -> dict[str, registry.Entry]:
    from pairmill.catalog import (corpus, dictionaries, gating, scores,  # noqa: F401
                                  streams, texts, transfer)
    return registry.ENTRIES
