"""Deterministic keys and JSON canonicalisation (native expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NULL placeholder and separator of the public dbt_utils
# ``generate_surrogate_key`` macro, so digests equal the ones a warehouse
# build of the same models produces.
NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 hex of the fields cast to string, NULLs replaced, joined by '-'.

    NULL and '' hash differently; ('a-b','c') and ('a','b-c') collide, as
    in the macro this mirrors.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def canonical_json(v) -> Column:
    """Canonical text of a VARIANT: keys sorted, no whitespace.

    Two objects that differ only in key order or spacing give one text,
    so they get one key.  A JSON ``null`` gives the text 'null'.
    """
    return F.to_json(_col(v))


def email_domain(user_id) -> Column:
    """Lower-cased second '@'-part when the id contains '@', else NULL.

    ``a@`` gives '' and ``a@x@y`` gives 'x'.
    """
    u = _col(user_id)
    return F.when(u.isNotNull() & u.contains("@"),
                  F.lower(F.split_part(u, F.lit("@"), F.lit(2))))
