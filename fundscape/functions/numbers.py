"""Text to number, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation. Spark's cast would also take 1d, 1.0f, 0x1p3, inf and nan.
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(col: Column) -> Column:
    """Double, or NULL when the text is no plain decimal number."""
    text = col.cast("string")
    return F.when(text.rlike(DECIMAL), text.try_cast("double"))


def parse_eu_number(col: Column) -> Column:
    """Money text with European or English separators to double.

    With both separators present the later one is the decimal mark; a comma alone
    is a decimal mark; a point alone is one too."""
    text = col.cast("string")
    # translate drops the characters that have no counterpart
    decimal_comma = F.translate(text, ",.€ ", ".")
    plain = F.translate(text, ",€ ", "")
    return to_number(F.when(F.instr(text, ",") > F.instr(text, "."), decimal_comma).otherwise(plain))
