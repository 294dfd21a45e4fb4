"""Column helpers for whole texts: values bound once, running totals, pieces of a long text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points of a chunk of a text, and elements of a block of a running total.
CHUNK, BLOCK = 256, 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` has it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column], kind: str = "int") -> Column:
    """Running totals of an array of no nulls: the first element, the first two joined, and so on.

    Appending copies an array, so totals are made block by block: work is about linear in the number of elements.
    """
    empty = F.array().cast(f"array<{kind}>")

    def totals(xs: Column) -> Column:
        return F.aggregate(xs, empty, lambda done, x: F.array_append(done, F.when(F.size(done) == 0, x).otherwise(join(F.try_element_at(done, F.lit(-1)), x))))

    def of_blocks(blocks: Column) -> Column:
        ends = totals(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return let(ends, lambda e: F.flatten(F.transform(
            blocks, lambda b, i: F.when(i == 0, b).otherwise(let(F.get(e, i - 1), lambda before: F.transform(b, lambda x: join(before, x))))
        )))

    def whole(xs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
        return let(F.transform(starts, lambda i: totals(F.slice(xs, i * BLOCK + 1, F.lit(BLOCK)))), of_blocks)

    return let(values, lambda xs: F.when(F.size(xs) == 0, empty).otherwise(whole(xs)))


def chunks(text: Column) -> Column:
    """A text as an array of CHUNK code points each."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{CHUNK}}})"), F.lit(1))


def cut_out(parts: Column, start: Column, length: Column) -> Column:
    """``length`` code points of a text in ``chunks`` from ``start`` (from 0) on, in time that doesn't grow with the place.

    What lies before or after the text is not there.
    """
    first, wanted = F.greatest(start, F.lit(0)), F.greatest(length + F.least(start, F.lit(0)), F.lit(0))
    at = F.floor(first / CHUNK).cast("int")
    n = F.floor((first + wanted) / CHUNK).cast("int") - at + 1
    return F.substring(F.array_join(F.slice(parts, at + 1, n), ""), (first % CHUNK + 1).cast("int"), wanted.cast("int"))


def nested(df: DataFrame, **helpers: Column) -> DataFrame:
    """The rows as one struct ``row`` beside helper columns, so that no helper meets a column of the same name."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *(h.alias(n) for n, h in helpers.items()))
