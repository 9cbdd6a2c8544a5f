"""Delimited text lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUL = "\x00"


def computed_once(df: DataFrame, kept: Sequence[str], *columns: Column) -> DataFrame:
    """``kept`` and the new ``columns``, each evaluated once per row.

    The new columns come out of a generator, through which the optimizer does not
    push filters; a filter on plain computed columns would evaluate them again.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


def without_nul(line: Column) -> Column:
    return F.replace(line, F.lit(_NUL), F.lit(""))


def without_return(line: Column) -> Column:
    """A line without the carriage return at its end."""
    cut = line.substr(F.lit(1), F.length(line) - 1)
    return F.when(line.endswith("\r"), cut).otherwise(line)


def split_fields(line: Column, separator: str) -> Column:
    """Fields of a delimited line without NULs; NULL when its quoting is broken.

    Lines may have any number of fields. A field that starts with a double quote
    runs to the closing quote, with two quotes standing for one; a quote inside
    an unquoted field is an error.
    """
    sep = re.escape(separator)
    quoted = r'[^"]*+(?:""[^"]*+)*+'
    plain = rf'[^"{sep}]*+'
    field = rf'(?:"{quoted}"|{plain})'
    # Lines with quotes get NULs for the separators between their fields.
    well_formed = rf"^{field}(?:{sep}{field})*+\z"
    marked = F.regexp_replace(
        F.concat(F.lit(separator), line), rf'{sep}(?:"({quoted})"|({plain}))', f"{_NUL}$1$2"
    )
    unquoted = F.replace(F.substr(marked, F.lit(2)), F.lit('""'), F.lit('"'))
    return (
        F.when(~F.contains(line, F.lit('"')), F.split(line, sep, -1))
        .when(line.rlike(well_formed), F.split(unquoted, _NUL, -1))
    )
