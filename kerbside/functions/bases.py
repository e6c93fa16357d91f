"""Dispatching-base ids: a prefix chosen by divisibility, then the number in hexadecimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_base(base_num: Column) -> Column:
    """Encode a base number such as ``B02884``; NULL when the tail is not a number.

    A number is one of 64 bits, but the least, which has no opposite.
    """
    number = F.substring(base_num, 2, 2_147_483_647).try_cast("bigint")
    prefix = F.when(number % 7 == 0, "s/").when(number % 3 == 0, "a/").otherwise("e/")
    # At least three characters; a sign takes one of them.
    opposite = F.try_subtract(F.lit(0).cast("bigint"), number)
    digits = F.when(number < 0, F.format_string("-%02x", opposite)).otherwise(
        F.format_string("%03x", number)
    )
    return F.when(opposite.isNotNull(), F.concat(prefix, digits))


def encode_base_pandas():
    """The same encoding as an Arrow-batched UDF, for users who plug in their own rule."""
    import numpy as np
    import pandas as pd

    # Defined here, not at module level, so that it travels to the executors by value.
    def encode(batch: pd.Series) -> pd.Series:
        # White space around the number and any number of 64 bits, as a cast takes them.
        tails = batch.str[1:].str.strip()
        texts = tails[tails.str.fullmatch(r"[+-]?[0-9]+", na=False)]
        exact = np.array([*map(int, texts)], dtype=object)
        fits = (exact > -(2**63)) & (exact < 2**63)
        numbers = exact[fits.astype(bool)].astype("int64")
        prefix = np.select([numbers % 7 == 0, numbers % 3 == 0], ["s/", "a/"], "e/")
        digits = np.char.mod("%03x", numbers.astype(object)) if len(numbers) else prefix
        encoded = pd.Series(np.char.add(prefix, digits), index=texts.index[fits.astype(bool)], dtype=object)
        return encoded.reindex(batch.index)

    encode.__annotations__ = {"batch": pd.Series, "return": pd.Series}
    return F.pandas_udf(encode, "string")
