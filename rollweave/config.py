"""Run recipes: defaults, checks, and recipes of the first version brought to the second."""

from __future__ import annotations

import copy
import json
import re
from collections.abc import Mapping
from pathlib import Path
from typing import Any

# fixed values: the recipe's fields with their defaults, the modules and the search modes
DEFAULTS: dict[str, Any] = {
    "version": 2,
    "runname": "",
    "inputs": {"pensioners": "", "cgr": "", "start_row": 0, "end_row": None},
    "engine": {"backend": "findagrave", "throttle": 2.5, "state_filter": "OK"},
    "pipeline": {
        "modules": ["regional_planner", "fag_scraper", "candidate_scorer", "deep_refiner"],
        "decision": {"threshold": "hardcoded", "hardcoded_value": 0.85},
        "mode": {"mode": "standard"},
        "learning": {"classifier_path": None},
    },
    "post": {"collect_labels": True, "labels_path": "output/labels/labels_v1.jsonl"},
}
MODULES = {"regional_planner", "fag_scraper", "candidate_scorer", "deep_refiner", "newspapers_scraper", "label_collector"}
MODES = {
    "conservative": {"max_refinements": 4, "skip_refine_above": 0.85, "bail_on_auto_accept": True},
    "standard": {"max_refinements": 6, "skip_refine_above": 0.85, "bail_on_auto_accept": True},
    "aggressive": {"max_refinements": 8, "skip_refine_above": 0.85, "bail_on_auto_accept": False},
}
RUN_NAME = re.compile(r"[a-z0-9](?:[a-z0-9_-]*[a-z0-9])?")
#: Where a field of a first-version recipe is now.
MOVED = {"runname": ("runname",), "input": ("inputs", "pensioners"), "input_path": ("inputs", "pensioners"), "cgr": ("inputs", "cgr"), "cgr_path": ("inputs", "cgr"), "start_row": ("inputs", "start_row"), "end_row": ("inputs", "end_row"), "throttle": ("engine", "throttle"), "fag_state_filter": ("engine", "state_filter")}


class RecipeError(ValueError):
    """A recipe that can't be run, with what is wrong in it."""


def _merged(base: dict[str, Any], given: Mapping[str, Any]) -> dict[str, Any]:
    out = copy.deepcopy(base)
    for k, v in given.items():
        out[k] = _merged(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, Mapping) else v if v is not None or k not in out or out[k] is None else out[k]
    return out


def recipe(given: Mapping[str, Any]) -> dict[str, Any]:
    """A whole, checked recipe: what is given over the defaults, a search mode's own settings under what is given for it.

    A recipe without a version, or of version 1, is brought to version 2 first.
    """
    if given.get("version", 1) == 1:
        moved: dict[str, Any] = {"version": 2}
        for old, path in MOVED.items():
            if old in given and not (len(path) > 1 and path[1] in moved.get(path[0], {})):
                if len(path) == 1:
                    moved[path[0]] = given[old]
                else:
                    moved.setdefault(path[0], {})[path[1]] = given[old]
        given = moved
    out = _merged(DEFAULTS, given)
    if not RUN_NAME.fullmatch(out["runname"]):
        raise RecipeError(f"run name {out['runname']!r} is not lower-case letters, digits, - and _ between them")
    mode = out["pipeline"]["mode"]["mode"]
    if mode not in MODES:
        raise RecipeError(f"search mode {mode!r} is none of {', '.join(sorted(MODES))}")
    out["pipeline"]["mode"] = MODES[mode] | out["pipeline"]["mode"]
    unknown = [m for m in out["pipeline"]["modules"] if m not in MODULES]
    if unknown:
        raise RecipeError(f"modules {', '.join(map(repr, unknown))} are none of {', '.join(sorted(MODULES))}")
    start, end = out["inputs"]["start_row"], out["inputs"]["end_row"]
    if start < 0 or end is not None and end < start:
        raise RecipeError(f"rows {start} to {end} are no range")
    return out


def read_recipe(path: str) -> dict[str, Any]:
    """The checked recipe in a JSON file."""
    try:
        return recipe(json.loads(Path(path).read_text(encoding="utf-8")))
    except FileNotFoundError as e:
        raise RecipeError(f"no recipe at {path}") from e
    except json.JSONDecodeError as e:
        raise RecipeError(f"{path} is no JSON: line {e.lineno}") from e


def start_run(name: str, root: str, overwrite: bool = False) -> str:
    """A run's folder with a default recipe in it; an existing one is kept unless ``overwrite``."""
    folder = Path(root) / name
    made = recipe({"version": 2, "runname": name})
    if folder.exists() and not overwrite:
        raise RecipeError(f"there is a run {name!r} already")
    folder.mkdir(parents=True, exist_ok=True)
    target = folder / "config.json"
    target.write_text(json.dumps(made, indent=2) + "\n", encoding="utf-8")
    return str(target)
