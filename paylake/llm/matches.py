"""Places of all matches of a pattern, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(numbers: Column, combine) -> Column:
    """What ``combine`` makes of the numbers up to each place, in log(size) passes.

    ``combine`` is associative, the numbers are whole and 0 leaves the other as it is.
    """

    def add(sums: Column, k: Column) -> Column:
        by = F.pow(F.lit(2), k).cast("int")
        shifted = F.concat(
            F.array_repeat(F.lit(0), F.least(by, F.size(sums))),
            F.slice(sums, F.lit(1), F.greatest(F.size(sums) - by, F.lit(0))),
        )
        return F.zip_with(sums, shifted, combine)

    steps = F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)).cast("double"))).cast("int")
    passes = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(passes, numbers, add)


def prefix_sums(numbers: Column) -> Column:
    """The running sums of an array of whole numbers."""
    return running(numbers, lambda a, b: a + b)


def found(text: Column, pattern: str) -> Column:
    """The matches: an array of ``value, start, end, before, after``.

    Places are in code points, the end exclusive.  ``before`` and ``after`` are the texts
    up to the previous and the next match.  The pattern must not match nothing.
    """

    def located(values: Column) -> Column:
        def with_pieces(pieces: Column) -> Column:
            ends = prefix_sums(F.zip_with(
                F.slice(pieces, F.lit(1), F.size(values)), values, lambda p, v: F.length(p) + F.length(v)
            ))
            return let(ends, lambda to: F.transform(values, lambda v, i: F.struct(
                v.alias("value"),
                (F.get(to, i) - F.length(v)).alias("start"),
                F.get(to, i).alias("end"),
                F.get(pieces, i).alias("before"),
                F.get(pieces, i + 1).alias("after"),
            )))

        return let(F.split(text, pattern, -1), with_pieces)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
