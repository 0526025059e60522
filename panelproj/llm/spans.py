"""Where a pattern matches in a text, with DataFrame functions alone.

Splitting a text by a pattern gives the gaps between its leftmost non-overlapping matches and
extracting gives the matches; running sums of both lengths are the positions, in code points.
Patterns must not match the empty string. Patterns use possessive repeats where a repeat
cannot usefully give back, so very long texts need neither deep stacks nor quadratic time.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once. Inside a lambda, a column that is no lambda variable is computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def running_sums(steps: Column) -> Column:
    """Inclusive running sums of an array: up to the blocks of 4096 and of 64 numbers before, and inside the block."""

    def blocks(numbers: Column, size: int) -> Column:
        """Sums of the whole blocks of so many numbers, and of the rest."""
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(numbers) / size).cast("int")), lambda b: _sum(F.slice(numbers, b * size + 1, size)))

    def before(sums: Column) -> Column:
        """Exclusive running sums, in the square of a short array's length."""
        return F.transform(sums, lambda _, i: _sum(F.slice(sums, F.lit(1), i)))

    def within(numbers: Column, starts: Column, size: int, inclusive: int) -> Column:
        """Running sums of numbers, given those up to each block of so many."""

        def upto(_: Column, i: Column) -> Column:
            b = F.floor(i / size).cast("int")
            return F.get(starts, b) + _sum(F.slice(numbers, b * size + 1, i - b * size + inclusive))

        return F.transform(numbers, upto)

    def nested(numbers: Column) -> Column:
        return bound(
            blocks(numbers, _BLOCK),
            lambda fine: bound(bound(blocks(fine, _BLOCK), before), lambda wide: bound(within(fine, wide, _BLOCK, 0), lambda starts: within(numbers, starts, _BLOCK, 1))),
        )

    return bound(steps, nested)


def matches(text: Column, pattern: str) -> Column:
    """Array of struct(start, end, value) of the matches, in order; ends are exclusive. The text is searched a fixed number of times."""
    # to the start of match i: its gap, and the match before it
    lengths = lambda values: F.transform(values, lambda v: F.char_length(v))
    steps = lambda gaps, sizes: F.transform(F.slice(gaps, F.lit(1), F.size(sizes)), lambda g, i: g + F.when(i > 0, F.get(sizes, i - 1)).otherwise(F.lit(0)))
    placed = lambda values, sizes, starts: F.transform(values, lambda v, i: F.struct(F.get(starts, i).alias("start"), (F.get(starts, i) + F.get(sizes, i)).alias("end"), v.alias("value")))
    found = bound(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda values: bound(
            lengths(values),
            lambda sizes: bound(
                lengths(F.split(text, pattern, -1)),
                lambda gaps: bound(running_sums(steps(gaps, sizes)), lambda starts: placed(values, sizes, starts)),
            ),
        ),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def listed(spans: Column) -> Column:
    """kind:start:end of an array of struct(kind, start, end), comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def as_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def by_start(spans: Column, kinds: list[str]) -> Column:
    """Spans sorted by start, then kind as listed, then end."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def by_kind(spans: Column, kinds: list[str]) -> Column:
    """Spans sorted by kind as listed, then start, then end."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
