"""All registered queries."""

from workloads import cleaning, lake, scoring, selection, spine

_GROUPS = (spine, cleaning, selection, scoring, lake)

QUERIES = {name: run for group in _GROUPS for name, run in group.QUERIES.items()}
ORACLE = {name: text for group in _GROUPS for name, text in group.ORACLE.items()}
