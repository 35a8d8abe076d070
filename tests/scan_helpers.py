"""Scan settings that make keys hot on small tables."""

from refillscope.operators.ordered_scan import find_hot_keys
from refillscope.schema import CANONICAL_KEYS


def hot_options(df, rows_per_run, chunk_rows, keys=CANONICAL_KEYS):
    hot = find_hot_keys(df, list(keys), rows_per_run)
    return {"hot": hot, "rows_per_run": rows_per_run, "chunk_rows": chunk_rows}
