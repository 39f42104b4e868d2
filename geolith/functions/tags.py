"""Tag values: numbers in free text, heights, codes and display formats, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(tag: Column) -> Column:
    """The number at the start of a tag such as '12 m' or '12,5'; null if there is none."""
    plain = F.trim(F.replace(F.replace(F.lower(tag), F.lit("m"), F.lit("")), F.lit(","), F.lit(".")))
    return F.split_part(plain, F.lit(" "), F.lit(1)).try_cast("double")


def height_from_levels(levels: Column, height: Column) -> Column:
    """Three metres a level, else the height, else 3."""
    return F.coalesce(levels * 3.0, height, F.lit(3.0))


def height_first(height: Column, floors: Column) -> Column:
    """The height, else three metres a floor and three for the roof, else 9."""
    return F.coalesce(height, floors * 3.0 + 3.0, F.lit(9.0))


def height_of_floors(floors: Column) -> Column:
    return F.coalesce(floors * 3.0 + 3.0, F.lit(9.0))


def height_from_area(area: Column) -> Column:
    """Half the side of a square of this area, from 6 to 28."""
    return F.least(F.greatest(F.sqrt(area) * 0.5, F.lit(6.0)), F.lit(28.0))


def cell_code(col: Column, row: Column) -> Column:
    return F.format_string("%02d%02d", col, row)


def degrees_minutes(value: Column, width: int, positive: str, negative: str) -> Column:
    """Degrees of `width` digits, then minutes with three decimals, then the hemisphere."""
    size = F.abs(value)
    whole = F.floor(size)
    return F.format_string(f"%0{width}d%06.3f%s", whole, (size - whole) * 60.0, F.when(value < 0, negative).otherwise(positive))


def feet(metres: Column) -> Column:
    """Whole feet; halves go to the even number."""
    return F.rint(metres * 3.28084).cast("int")


def trimmed_decimal(value: Column) -> Column:
    """Three decimals without trailing zeros or dot."""
    return F.regexp_replace(F.format_string("%.3f", value), r"\.?0+$", "")


def ascii_field(text: Column, size: int) -> Column:
    """ASCII characters alone, cut to `size` and filled with '_' for a fixed-width record."""
    return F.rpad(F.regexp_replace(text, r"[^\x00-\x7F]", ""), size, "_")
