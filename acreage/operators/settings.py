"""Settings that may differ by the value of a key column, so that one job runs an operator with many settings."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from acreage.functions import arrays as A


@dataclass(frozen=True)
class PerKey:
    """A setting for each value of the integer key column ``key``. The values are trial definitions: few, and known to the driver."""

    key: str
    values: tuple[tuple[int, object], ...]

    @staticmethod
    def of(key: str, values: Mapping[int, object]) -> object:
        """A plain value if all are equal."""
        return next(iter(values.values())) if len(set(values.values())) == 1 else PerKey(key, tuple(sorted(values.items())))


def at(setting, keys: Mapping[str, object]):
    """The setting of a group of rows, from its key values."""
    return dict(setting.values)[keys[setting.key]] if isinstance(setting, PerKey) else setting


def column(setting) -> Column:
    """The setting as a column of the rows."""
    if not isinstance(setting, PerKey):
        return F.lit(setting)
    pairs = [F.lit(x) for pair in setting.values for x in pair]
    return F.element_at(F.create_map(*pairs), F.col(setting.key))


def largest(setting):
    return max(v for _, v in setting.values) if isinstance(setting, PerKey) else setting


def any_set(setting) -> bool:
    return largest(setting) > 0


def disks(setting) -> Callable[[Mapping[str, object]], list[tuple[int, int]]]:
    """Disk elements by setting; ``reach`` is the largest radius."""
    fn = lambda keys: A.disk(at(setting, keys))
    fn.reach = max(0, int(largest(setting)))
    return fn
