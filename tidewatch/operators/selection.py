"""The k smallest numbers of each class, found without sorting a class."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, functions as F

DIGEST_BITS, STEP_BITS = 60, 12
MOST_CLASSES = 1_000


def smallest(rows: DataFrame, wanted: Callable[[int], int]) -> dict[Any, int]:
    """For each class, a limit below which `wanted(its size)` digests lie.

    `rows` has class and digest, a whole number of up to 60 bits; rows with a null are ignored.
    Each pass counts the next 12 bits of the digests that are still in question: two or three
    passes settle a class. If equal digests lie on both sides of the wish, the limit leaves them out.
    """
    known = rows.where("class IS NOT NULL AND digest IS NOT NULL")
    sizes = known.groupBy("class").count().limit(MOST_CLASSES + 1).collect()
    if len(sizes) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    limits: dict[Any, int] = {}
    # Classes in question: the leading bits that are settled, and how many digests with them are wanted.
    open_ = {row["class"]: (0, wanted(row["count"])) for row in sizes}
    for shift in range(DIGEST_BITS - STEP_BITS, -1, -STEP_BITS):
        if not open_:
            break
        asked = F.lit(False)
        for name, (prefix, _) in open_.items():
            asked = asked | (F.col("class") == F.lit(name)) & (F.shiftright("digest", shift + STEP_BITS) == prefix)
        step = F.shiftright("digest", shift).bitwiseAND(F.lit((1 << STEP_BITS) - 1))
        # At most 4,096 numbers for each class.
        counts: dict[Any, dict[int, int]] = {name: {} for name in open_}
        for row in known.where(asked).groupBy("class", step.alias("step")).count().collect():
            counts[row["class"]][row["step"]] = row["count"]
        for name, (prefix, missing) in list(open_.items()):
            for place in range(1 << STEP_BITS):
                count = counts[name].get(place, 0)
                if count > missing:
                    break
                missing -= count
            else:
                place = 1 << STEP_BITS
            settled = (prefix << STEP_BITS) + place
            if missing and place < 1 << STEP_BITS and shift:
                open_[name] = settled, missing
            else:
                limits[name] = settled << shift
                del open_[name]
    return limits
