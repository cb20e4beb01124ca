"""Reversible encoding of field names, for strings in columns and for column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusmill.functions.basics import literal_map
from locusmill.vocabulary import NAME_BAD_LEADING, NAME_ESCAPE, NAME_ESCAPES


def encode_name(name: Column, dot: str | None = None) -> Column:
    """Escape the characters a field name cannot hold.

    ``dot`` replaces every ``.`` first; unlike the escapes that cannot be undone.
    """
    if dot is not None:
        name = F.replace(name, F.lit("."), F.lit(dot))
    escapes = literal_map({NAME_ESCAPE: NAME_ESCAPE * 2, **NAME_ESCAPES})
    letters = F.split(name, "")
    escaped = F.array_join(F.transform(letters, lambda c: F.coalesce(escapes[c], c)), "")
    return F.when(F.left(escaped, F.lit(1)).isin(NAME_BAD_LEADING), F.concat(F.lit(NAME_ESCAPE), escaped)).otherwise(
        escaped
    )


def decode_name(name: Column) -> Column:
    """Undo :func:`encode_name`, reading from the left: ``$$`` first, then the escapes."""
    body = F.when(F.startswith(name, F.lit(NAME_ESCAPE)), F.substring(name, 2, 2**31 - 1)).otherwise(name)
    words = "|".join(escape.strip("_").strip("$") for escape in NAME_ESCAPES.values())
    # the last alternative takes any other character, so the tokens cover the whole text
    tokens = F.regexp_extract_all(body, F.lit(rf"(?s)(\$\$|_\$(?:{words})\$_|.)"), F.lit(1))
    plain = literal_map({NAME_ESCAPE * 2: NAME_ESCAPE, **{v: k for k, v in NAME_ESCAPES.items()}})
    return F.when(
        name.isNotNull(), F.array_join(F.transform(tokens, lambda t: F.coalesce(plain[t], t)), "")
    )


def encoded_column_name(name: str, dot: str | None = "_") -> str:
    """The same encoding for one column name of a schema, used when documents are written."""
    escapes = {NAME_ESCAPE: NAME_ESCAPE * 2, **NAME_ESCAPES}
    if dot is not None:
        name = name.replace(".", dot)
    escaped = name.translate(str.maketrans(escapes))
    return NAME_ESCAPE + escaped if escaped[:1] in NAME_BAD_LEADING else escaped
