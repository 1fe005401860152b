"""Several columns as one text, which takes less room in a shuffle than a column each.

Any text, and NULL, comes back as it was. Whole numbers and flags may stand among the texts.
"""

from pyspark.sql import functions as F

# The end of a value among several, what stands for that and for itself, and for NULL.
_END, _ESCAPE = "\x1f", "\x1b"
_NULL = f"{_ESCAPE}n"


def joined(kinds):
    """The columns of ``kinds`` (name -> type) as one text, which is never NULL."""

    def kept(name, kind):
        value = F.col(f"`{name}`")
        if kind == "string":
            marked = F.replace(value, F.lit(_ESCAPE), F.lit(f"{_ESCAPE}e"))
            value = F.replace(marked, F.lit(_END), F.lit(f"{_ESCAPE}s"))
        return F.coalesce(value.cast("string"), F.lit(_NULL))

    return F.concat_ws(_END, *[kept(*one) for one in kinds.items()])


def chained(*texts):
    """What ``joined`` made of some columns and of others, as if made of all; for a NULL give ``absent``."""
    return F.concat_ws(_END, *texts)


def absent(number):
    """That many NULLs joined."""
    return F.lit(_END.join([_NULL] * number))


def parted(text, kinds):
    """Name -> value of the columns that make up a joined column; all are NULL where it is."""

    def one(number, kind):
        value = F.nullif(F.split_part(F.col(text), F.lit(_END), F.lit(number)), F.lit(_NULL))
        if kind == "string":
            value = F.replace(value, F.lit(f"{_ESCAPE}s"), F.lit(_END))
            return F.replace(value, F.lit(f"{_ESCAPE}e"), F.lit(_ESCAPE))
        return value.cast(kind)

    return {name: one(number, kind) for number, (name, kind) in enumerate(kinds.items(), start=1)}
