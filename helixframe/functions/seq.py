"""Column functions over DNA sequences."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UMI = re.compile(r"^(\d+)X$")


def reverse_complement(seq: Column) -> Column:
    """A with T and C with G, read backwards; N stays. Other letters fail the query."""
    wrong = F.raise_error(F.concat(F.lit("not a DNA sequence: "), seq)).cast("string")
    return F.when(is_sequence(seq) | seq.isNull(), F.translate(F.reverse(seq), "ACGT", "TGCA")).otherwise(wrong)


def is_sequence(seq: Column) -> Column:
    return seq.rlike("^[ACGTN]*$")


def umi_length(header: str) -> int | None:
    """The length in a random element's column name, such as 10 for 10X."""
    found = _UMI.match(header)
    return int(found[1]) if found else None


def revcomp_text(s: str) -> str:
    if set(s) - set("ACGTN"):
        raise ValueError(f"not a DNA sequence: {s}")
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))
