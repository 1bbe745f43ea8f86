"""Named processing steps and the order they run in.

A step takes rows and a ``Load`` and returns rows; a recipe is a list of steps
applied with ``DataFrame.transform``: one lazy plan, no files in between.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from tidegate.operators.clean import normalise_reasons
from tidegate.operators.duplicates import DEFAULT_KEYS, DEFAULT_MAXIMA, collapse_duplicates
from tidegate.operators.lineage import attach_lineage, files_of, resolve_lineage
from tidegate.schema import LINEAGE_COLUMNS
from tidegate.session import materialise
from tidegate.sources.headers import clean_names


@dataclass(frozen=True)
class Load:
    """What steps may need to know about the load they run in."""

    sidecars: DataFrame | None = None
    files: DataFrame | None = None
    now: float | None = None
    compat_dates: bool = False
    keys: tuple[str, ...] = DEFAULT_KEYS
    maxima: tuple[str, ...] = DEFAULT_MAXIMA
    scope: tuple[str, ...] = ("file_path",)
    row_order: tuple[str, ...] = ("row_id",)
    drop_null_keys: str | bool = "auto"


Step = Callable[[DataFrame, Load], DataFrame]


def sanitise_step(rows: DataFrame, load: Load) -> DataFrame:
    return rows.toDF(*clean_names(rows.columns))


def lineage_step(rows: DataFrame, load: Load) -> DataFrame:
    if all(c in rows.columns for c in LINEAGE_COLUMNS):
        return rows
    if load.sidecars is None:
        raise ValueError("the lineage step needs the sidecars of the load")
    # A listing knows the files without reading them; the rows know them too, for a scan.
    files = load.files if load.files is not None else files_of(rows)
    resolved = materialise(resolve_lineage(files, load.sidecars, load.now, load.compat_dates))
    return attach_lineage(rows, resolved)


def capacity_step(rows: DataFrame, load: Load) -> DataFrame:
    scope = [c for c in load.scope if c in rows.columns]
    collapsed = collapse_duplicates(
        rows, load.row_order, load.keys, load.maxima, scope, load.drop_null_keys
    )
    return normalise_reasons(collapsed)


_STEPS: dict[str, Step] = {
    "header_sanitizer": sanitise_step,
    "lineage": lineage_step,
    "capacity": capacity_step,
}
DEFAULT_STEP = "lineage"


def register_step(name: str, step: Step) -> None:
    _STEPS[name.lower()] = step


def step_for(name: str) -> Step:
    """The step of that name, in any case; unknown names mean lineage."""
    return _STEPS.get(name.lower(), _STEPS[DEFAULT_STEP])


def recipe(kind: str) -> list[Step]:
    """Sanitise, lineage, then the step of ``kind`` unless it is one of those."""
    base = [sanitise_step, lineage_step]
    own = step_for(kind)
    return base if own in base else [*base, own]


def kind_of_asset(asset_id: str) -> str:
    return "capacity" if "capacity" in asset_id else "default"


def run_recipe(rows: DataFrame, kind: str, load: Load) -> DataFrame:
    return reduce(lambda df, step: df.transform(step, load), recipe(kind), rows)
