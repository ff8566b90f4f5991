"""Column expressions that the native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(body: Callable[[Column], Column], **values: Column) -> Column:
    """body over a struct of values, each computed once, also where body uses it for every element of an array."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body)[0]


def running(sizes: Column, part: int = 512) -> Column:
    """Sum of the sizes before each one. Goes by parts: the time grows with the length times `part`."""
    def sums(values: Column, start: Column) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(values, empty, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def by_parts(v: Column) -> Column:
        def one(p: Column) -> Column:
            return sums(p["part"], total(F.slice(v["totals"], 1, p["i"])))

        numbered = F.transform(v["parts"], lambda p, i: F.struct(p.alias("part"), i.alias("i")))
        return F.flatten(F.transform(numbered, one))

    def parted(v: Column) -> Column:
        starts = F.when(F.size(v["sizes"]) > 0, F.sequence(F.lit(0), F.floor((F.size(v["sizes"]) - 1) / part).cast("int"))).otherwise(F.array().cast("array<int>"))
        parts = F.transform(starts, lambda i: F.slice(v["sizes"], i * part + 1, F.lit(part)))
        return let(lambda w: let(by_parts, parts=w["parts"], totals=F.transform(w["parts"], total)), parts=parts)

    return let(parted, sizes=sizes)
