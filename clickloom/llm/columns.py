"""Names of columns that an operator makes on its way."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame


def sets_aside(*names: str) -> Callable:
    """For a function of a table that makes columns called ``names`` and drops them again.

    Columns of the table with such names (in any case) bear others meanwhile, so they pass.
    """
    own = {name.lower() for name in names}

    def around(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(fn)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            taken = own | {name.lower() for name in docs.columns}
            moved = {}
            for name in docs.columns:
                if name.lower() in own:
                    other = name + "_"
                    while other.lower() in taken:
                        other += "_"
                    taken.add(other.lower())
                    moved[name] = other
            if not moved:
                return fn(docs, *args, **kwargs)
            found = fn(docs.withColumnsRenamed(moved), *args, **kwargs)
            return found.withColumnsRenamed({other: name for name, other in moved.items()})

        return run

    return around
