"""Token ids of many texts by way of their distinct stretches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa

# Stretches encoded, and stretches of texts looked up, at once.
NEW_AT_ONCE = 5_000
BLOCK = 1 << 22


class Kept:
    """Stretch -> its ids, as bytes of little-endian 32-bit integers.

    When full, half of the room is given to new results, and an old one moves
    over when it is asked for again, so that frequent stretches stay; what was
    not asked for since the last time goes. Stretches longer than ``longest``
    are worked out each time.
    """

    def __init__(self, make: Callable, room: int, longest: int):
        self.make, self.room, self.longest = make, room // 2, longest
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids_of(self, stretches: list[str]) -> list[bytes]:
        """Ids of distinct stretches."""
        found = list(map(self.new.get, stretches))
        missing, again = [], {}
        for k in [k for k, ids in enumerate(found) if ids is None]:
            ids = self.old.get(stretches[k])
            if ids is None:
                missing.append(k)
            else:
                found[k] = again[stretches[k]] = ids
        self._keep(again)
        for start in range(0, len(missing), NEW_AT_ONCE):
            some = missing[start : start + NEW_AT_ONCE]
            texts = [stretches[k] for k in some]
            made = self.make(texts)
            for k, ids in zip(some, made):
                found[k] = ids
            self._keep(
                {x: i for x, i in zip(texts, made) if len(x) <= self.longest}
            )
        return found

    def _keep(self, found: dict[str, bytes]) -> None:
        if len(self.new) + len(found) > self.room:
            self.old, self.new = self.new, found
        else:
            self.new |= found

    def join(self, stretches: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, given as lists of stretches, and the place
        where each text begins, with the end of the last."""
        values = stretches.flatten()
        tokens, ends = [], [np.zeros(1, np.int64)]
        for start in range(0, len(values), BLOCK):
            coded = values.slice(start, BLOCK).dictionary_encode()
            found = self.ids_of(coded.dictionary.to_pylist())
            data = np.frombuffer(b"".join(found), "<u4")
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            codes = coded.indices.to_numpy()
            size = sizes[codes]
            end = np.cumsum(size)
            # A block is short enough for 32-bit places within it.
            shift = (np.cumsum(sizes)[codes] - end).astype(np.int32)
            place = np.repeat(shift, size)
            place += np.arange(len(place), dtype=np.int32)
            tokens.append(data.take(place))
            ends.append(end + ends[-1][-1])
        lengths = stretches.value_lengths().to_numpy(zero_copy_only=False)
        places = np.r_[0, np.cumsum(lengths)].astype(np.int64)
        return (
            np.concatenate(tokens) if tokens else np.zeros(0, "<u4"),
            np.concatenate(ends)[places],
        )


def per_worker(name: str, *args, make: Callable):
    """``make(*args)``, kept for the life of a Python worker.

    Functions reach a worker anew with every task and bring their globals
    along, so what should outlast a task is kept in a module of the worker.
    """
    store = sys.modules.setdefault(
        "_llm_kept_per_worker", types.ModuleType("_llm_kept_per_worker")
    ).__dict__
    key = (name, *args)
    if key not in store:
        store[key] = make(*args)
    return store[key]
