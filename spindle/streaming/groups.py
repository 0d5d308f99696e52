"""Groups of keys that share one state row.

A stateful Python step costs a call, a state read and a state write for each group
it is given. With a group per key that is a call for every key of a micro-batch;
here a key goes to one of STATE_GROUPS groups by its hash, and the state of a group
holds its keys side by side. The calls of a micro-batch are then bounded, and a
group is a 1 / STATE_GROUPS share of the keys. The number is part of a checkpoint's
layout, as the number of state stores is.

Keys reach Python as text, and come back by a cast: pandas turns a column of whole
numbers into floating point as soon as it holds a null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
STATE_GROUPS = 2048


def state_group(key: str) -> Column:
    """Number of a key's group; null is a key like any other."""
    return F.pmod(F.xxhash64(key), F.lit(STATE_GROUPS)).cast("int")


def as_text(key: str) -> Column:
    return F.col(key).cast("string")


def plain(values) -> list:
    """The values of a pandas column of text, null as None."""
    return [None if v is None or v != v else v for v in values.tolist()]
