"""Registered queries over the test tables, each next to the SQL that checks it."""

from caseflow.plans.queries import (
    conversations,
    evaluation,
    models,
    profiles,
    replies,
    search,
    splits,
    terms,
    texts,
)

_MODULES = (profiles, conversations, texts, splits, terms, search, models, replies, evaluation)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
