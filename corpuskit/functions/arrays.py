"""Column helpers on arrays: labels, padding, flags."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED_LABEL = -100  # fixed value: positions that a loss skips


def text_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def probability_flag(score: Column, threshold: float = 0.5) -> Column:
    """1 when the sigmoid of the score reaches the threshold."""
    return (1 / (1 + F.exp(-score)) >= threshold).cast("int")


def arg_max(scores: Column) -> Column:
    """0-based place of the largest score, the first one on ties."""
    return F.array_position(scores, F.array_max(scores)) - 1


def multi_hot(labels: Column, catalogue: Sequence[str]) -> Column:
    """One 0/1 per catalogue entry, in catalogue order."""
    return F.array(*[F.array_contains(labels, F.lit(c)).cast("int") for c in catalogue])


def known_labels(labels: Column, catalogue: Sequence[str]) -> Column:
    """The labels that the catalogue holds, in their own order."""
    known = text_array(catalogue)
    return F.filter(labels, lambda label: F.array_contains(known, label))


def next_token_labels(ids: Column) -> Column:
    """Shift left by one; the last position is ignored."""
    shifted = F.concat(F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0))), F.array(F.lit(IGNORED_LABEL)))
    return F.when(F.size(ids) > 0, shifted).otherwise(ids)


def pad_right(values: Column, length: Column, fill: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(fill), F.greatest(length - F.size(values), F.lit(0)).cast("int")))


def padded_length(longest: Column, multiple_of: int = 1) -> Column:
    return (F.ceil(longest / multiple_of) * multiple_of).cast("int")


def masked_prefix(ids: Column, prefix_length: Column) -> Column:
    """Replace the ids before `prefix_length` by the ignored label."""
    return F.transform(ids, lambda x, i: F.when(i < prefix_length, F.lit(IGNORED_LABEL)).otherwise(x))


def running_sums(numbers: Column) -> Column:
    """For each number of an `array<int>` without nulls, the sum of the array up to it, in one pass."""

    @F.arrow_udf(returnType="array<int>")
    def sums(lists: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.append(0, np.cumsum(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)))
        ends = np.cumsum(sizes)
        own = total[1:] - np.repeat(total[ends - sizes], sizes)
        offsets = pa.array(np.append(0, ends).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(own.astype(np.int32)), mask=lists.is_null())

    return sums(numbers)
