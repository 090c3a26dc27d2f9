"""Feature locations of flat files: nested join, order and complement, and parts that lie in other records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pieces of a location (an operator with its bracket, a closing bracket, a part).
PIECES = r"([A-Za-z-]*\(|\)|[^,()]+)"
_PARTS = "array<struct<start: int, end: int, strand: string, record: string>>"


def _part(piece: Column) -> Column:
    record = F.nullif(F.regexp_extract(piece, r"^([^:]+):", 1), F.lit(""))
    place = F.regexp_replace(piece, r"^[^:]+:", "")
    first, last = F.regexp_extract(place, r"^\D*(\d+)", 1).try_cast("int"), F.regexp_extract(place, r"(\d+)\D*$", 1).try_cast("int")
    return F.struct(first.alias("start"), last.alias("end"), F.lit("+").alias("strand"), record.alias("record"))


def _turned(parts: Column) -> Column:
    """The parts as read on the other strand: last first, strands exchanged."""
    flip = lambda p: F.struct(p["start"], p["end"], F.when(p["strand"] == "-", "+").otherwise("-").alias("strand"), p["record"])
    return F.transform(F.reverse(parts), flip)


def location_parts(location: Column) -> Column:
    """The parts (start, end, strand, record) of a location in reading order; `record` is null in the record itself.

    The location is read from the left; every operator remembers how many parts stood before it, and where a
    `complement` closes, the parts since then are turned. So operators may be nested in any way: what one
    complement turns another one turns back. Signs of incomplete ends are left out, `12^13` is 12 to 13. A closing bracket
    without an opening one is left out, too.
    """
    pieces = F.regexp_extract_all(F.regexp_replace(location, r"\s+", ""), F.lit(PIECES), F.lit(1))

    def step(acc: Column, piece: Column) -> Column:
        out, stack = acc["out"], acc["stack"]
        opened = F.struct(out.alias("out"), F.array_append(stack, F.struct((piece == "complement(").alias("turn"), F.size(out).alias("before"))).alias("stack"))
        top = F.try_element_at(stack, F.lit(-1))
        own = F.slice(out, top["before"] + 1, F.greatest(F.size(out) - top["before"], F.lit(0)))
        closed = F.struct(
            F.when(top["turn"], F.concat(F.slice(out, F.lit(1), top["before"]), _turned(own))).otherwise(out).alias("out"),
            F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0))).alias("stack"),
        )
        read = F.struct(F.array_append(out, _part(piece)).alias("out"), stack.alias("stack"))
        return F.when(F.endswith(piece, F.lit("(")), opened).when((piece == ")") & (F.size(stack) > 0), closed).when(piece == ")", acc).otherwise(read)

    start = F.struct(F.array().cast(_PARTS).alias("out"), F.array().cast("array<struct<turn: boolean, before: int>>").alias("stack"))
    return F.aggregate(pieces, start, step, lambda acc: acc["out"])
