"""Helper columns that do not clash with a table's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores appended while the table has such a column, in either case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name that may hold any character, for expressions."""
    return "`" + name.replace("`", "``") + "`"


def with_text(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns `keep`, and `text` if it is not among them."""
    return df.select(*[quoted(name) for name in keep], *([] if "text" in keep else ["text"]))


def hash60(*parts: Column | str) -> Column:
    """A keyed 60-bit number from the text of `parts`."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 15), 16, 10).cast("bigint")
