"""Column functions."""

from __future__ import annotations


def register(spark) -> None:
    """Makes the Arrow functions known to SQL: jaro_winkler, metaphone_codes, fold_ascii, to_itrans."""
    from ..sources.shipping import ship
    from . import similarity, text

    ship(spark)
    for name, f in (("jaro_winkler", similarity.jaro_winkler), ("metaphone_codes", similarity.metaphone_codes), ("fold_ascii", text._fold), ("to_itrans", text._itrans)):
        spark.udf.register(name, f)
