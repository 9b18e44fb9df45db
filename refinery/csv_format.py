"""The one CSV contract shared by every CSV writer and reader of the package.

Values come back exactly as written: quotes are doubled, blanks and line breaks
stay, an empty text is ``""``, NULL is ``\\N`` and an empty unquoted field, and
timestamps carry six digits.  A text that is itself ``\\N`` would read as NULL,
so the writers raise on it.  The raw landing quotes every value; other writers
quote where a value needs it, and raise on a text with a bare carriage return,
which Spark's writer would leave unquoted (``quote_all`` keeps it).

A value may hold line breaks, so a file is read by one task: writers limit the
rows per file (``ROWS_PER_FILE``), which bounds a reader's task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL = "\\N"
ROWS_PER_FILE = 200_000
_TEXT = {"quote": '"', "escape": '"', "nullValue": NULL, "encoding": "UTF-8",
         "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def writer_options(header: bool, quote_all: bool = False) -> dict[str, str]:
    return {**_TEXT, **_TIMES, "header": str(header).lower(), "quoteAll": str(quote_all).lower(), "lineSep": "\n",
            "maxRecordsPerFile": str(ROWS_PER_FILE)}


def reader_options(header: bool, typed: bool = True, own: bool = True) -> dict[str, str]:
    """``typed``: the schema is given, so timestamps are in the writers' format
    (without one, Spark's inference looks for its own formats).  ``own``: the files
    come from the writers here, so lines end with a line feed and a carriage return
    is part of a value; other files' line ends are detected."""
    return {**_TEXT, **(_TIMES if typed else {}), **({"lineSep": "\n"} if own else {}),
            "header": str(header).lower(), "multiLine": "true"}


def _checked(text: Column, quote_all: bool) -> Column:
    mark = F.raise_error(F.lit(f"a text equals the NULL mark {NULL}")).cast("string")
    out = F.when(text == NULL, mark)
    if not quote_all:
        bare = F.contains(text, F.lit("\r")) & ~text.rlike('[\n,"]')
        out = out.when(bare, F.raise_error(F.lit("a text has a bare carriage return: pass quote_all")).cast("string"))
    return out.otherwise(text)


def writable(df: DataFrame, quote_all: bool = False) -> DataFrame:
    """``df``, raising while it is written if a text would not come back."""
    return df.select(*[
        _checked(F.col(f"`{f.name}`"), quote_all).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])
