"""Event ids: strict reading of UUID text, and ids derived from a record's place."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CANONICAL = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"
# Short or over-long groups are legal as long as each fits a signed 64-bit number.
GROUP = r"\+?0*([0-7][0-9a-fA-F]{15}|[0-9a-fA-F]{1,15})"
LOOSE = rf"^{GROUP}(-{GROUP}){{4}}\z"
MAX_LENGTH = 36
# Hex digits in each of the five groups.
GROUP_WIDTHS = (8, 4, 4, 4, 12)


def canonical_uuid(text: Column) -> Column:
    """Lower-case 36-character form, or NULL if the text is no UUID.

    Groups shorter than their width are padded with zeros on the left, and
    longer ones keep their right-most digits.
    """
    # One expression over an array, not one per group: generated code stays small
    # enough for the JVM to compile the method it ends up in.
    padded = F.zip_with(
        F.split(text, "-"),
        F.array(*[F.lit(w) for w in GROUP_WIDTHS]),
        lambda group, width: F.right(
            F.concat(F.lit("0" * max(GROUP_WIDTHS)), F.ltrim(group, F.lit("+"))), width
        ),
    )
    return (
        F.when(text.rlike(CANONICAL), F.lower(text))
        .when((F.length(text) <= MAX_LENGTH) & text.rlike(LOOSE), F.lower(F.array_join(padded, "-")))
    )


def uuid_from_text(text: Column) -> Column:
    """A stable id: the md5 of the text in UUID layout."""
    groups = "".join(f"(.{{{w}}})" for w in GROUP_WIDTHS)
    return F.regexp_replace(F.md5(text), f"^{groups}$", "$1-$2-$3-$4-$5")


def uuid_from_position(topic: Column, partition: Column, offset: Column) -> Column:
    """Id of a record that carries none: the same on every replay and in every query."""
    return uuid_from_text(
        F.concat_ws(":", topic, partition.cast("string"), offset.cast("string"))
    )
