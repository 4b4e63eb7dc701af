"""Plain Python statements of what the operators promise, for comparison."""

from __future__ import annotations

import json
import random


def text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def leaves(record: dict, lists: str = "whole") -> list[tuple[str, str]]:
    """(path, JSON text) of every leaf, sorted."""
    found, waiting = [], [((), record)]
    while waiting:
        path, value = waiting.pop()
        if isinstance(value, dict):
            waiting += [((*path, key), below) for key, below in value.items()]
            continue
        name = ".".join(path)
        if lists == "leaf" or not isinstance(value, list):
            found.append((name, text(value)))
            continue
        waiting += [(path, item) for item in value if isinstance(item, dict)]
        shown = [item for item in value if not isinstance(item, dict)]
        found += [
            (name, text(value if lists == "whole" else item)) for item in shown
        ]
    return sorted(found)


def search(record: dict, paths: list[str]) -> dict:
    by_path: dict[str, list] = {}
    for path, shown in leaves(record):
        by_path.setdefault(path, []).append(json.loads(shown))
    result = {}
    for path in paths:
        match by_path.get(path, []):
            case []:
                result[path] = None
            case [single]:
                result[path] = single
            case several:
                result[path] = several
    return result


def as_float(value):
    try:
        return float(value)
    except (ValueError, TypeError):
        return None


def is_json(line: str) -> bool:
    try:
        json.loads(line)
    except json.JSONDecodeError:
        return False
    return True


_NAMES = ["a", "b", "c", "name", "x y", "ü"]


def random_value(rng: random.Random, depth: int):
    kind = rng.random()
    if depth > 0 and kind < 0.3:
        return random_record(rng, depth - 1)
    if depth > 0 and kind < 0.55:
        return [
            random_value(rng, depth - 1) for _ in range(rng.randrange(4))
        ]
    return rng.choice(
        [None, True, False, 0, -7, 12345678901, "", "1", 'q"uo\\te', "tab\t", "é"]
    )


def random_record(rng: random.Random, depth: int = 3) -> dict:
    names = rng.sample(_NAMES, rng.randrange(5))
    return {name: random_value(rng, depth) for name in names}
