"""Training-data operators: thirteen corpus operations and their registered queries.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
:func:`queries` and :func:`oracle_sql` when it is present.
"""

from __future__ import annotations

from importlib import import_module

#: One module per operator; each defines ``QUERIES`` and ``ORACLES``.
MODULES = (
    "chat",
    "quality",
    "mixing",
    "decontam",
    "tokens",
    "simhash",
    "langid",
    "toxicity",
    "lmscore",
    "ann",
    "runs",
    "whiten",
    "bpe",
)


def _merged(name: str) -> dict:
    out: dict = {}
    for module in MODULES:
        out.update(getattr(import_module(f"{__name__}.{module}"), name))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLES")
