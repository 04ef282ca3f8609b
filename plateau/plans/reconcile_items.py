"""Item reconciliation job (T04): recipe events of two versions -> v1->v2 id mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plateau.operators.reconcile import ITEM_FIELDS, first_per_key, reconcile_ids, reconcile_report

ORDER = ["timestamp", "seq"]


def reconcile_items(v1_events: DataFrame, v2_events: DataFrame, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (mapping, report). Inputs: recipe events with ``recipe_id, recipe_url,
    recipe_name, recipe_author`` and the columns of ``order`` (``timestamp, seq``)."""
    f1 = first_per_key(v1_events, "recipe_url", order or ORDER, ITEM_FIELDS)
    f2 = first_per_key(v2_events, "recipe_url", order or ORDER, ITEM_FIELDS)
    return reconcile_ids(f1, f2), reconcile_report(v1_events, v2_events)


def write_mapping(mapping: DataFrame, path: str) -> None:
    """JSON-lines mapping document."""
    mapping.write.mode("overwrite").json(path)
