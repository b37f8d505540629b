"""Layers: how each one is stored and which database it goes to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyloom.sinks.marts import store_mart

VIEW, TABLE = "view", "table"


@dataclass(frozen=True)
class Layer:
    name: str
    stored_as: str


LAYERS = {
    "staging": Layer("staging", VIEW),
    "intermediate": Layer("intermediate", VIEW),
    "marts": Layer("marts", TABLE),
    "seeds": Layer("seeds", TABLE),
    "snapshots": Layer("snapshots", TABLE),
    "dq_failures": Layer("dq_failures", TABLE),
}


def database_name(layer: str | None, user_schema: str, production: bool) -> str:
    """Bare layer name in production; prefixed by the user's own schema otherwise."""
    if layer is None:
        return user_schema
    layer = layer.strip()
    return layer if production else f"{user_schema}_{layer}"


def is_production(target: str, environment_type: str = "") -> bool:
    """Production is named either by the target or by the kind of environment."""
    return target == "prod" or environment_type.lower() == "prod"


def materialise(
    df: DataFrame, layer: str, name: str, user_schema: str, production: bool, **storage
) -> str:
    """Register a view or store a mart, as the layer says; returns the full name.

    ``storage`` is passed to ``store_mart``, and only layers stored as tables accept it.
    """
    chosen = LAYERS[layer]
    database = database_name(chosen.name, user_schema, production)
    if chosen.stored_as == TABLE:
        return store_mart(df, database, name, **storage)
    if storage:
        raise ValueError(f"layer {layer} is stored as views, which take no {', '.join(sorted(storage))}")
    view = f"{database}__{name}"
    df.createOrReplaceTempView(view)
    return view
