"""One masked view of all texts: what a model or an index reads is written once, without the raw text, and nothing else may be read.

The view is a table of its own, so no plan over it can reach the text behind the masks. Items that still show a sign after
masking are held back, each by itself: a failure costs that item, never the others' privacy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.operators.privacy import EMAIL, IBAN, OLD_ACCOUNT, REGISTER_FORM, mask_accounts, mask_context, mask_email
from civicframe.sources.versions import publish

Mask = Callable[[Column], Column]

#: Masks in their order; those of names need lists and are given by the caller.
MASKS: tuple[Mask, ...] = (mask_context, mask_email, mask_accounts)
#: Signs that no masked text may show.
SIGNS = (EMAIL, IBAN, OLD_ACCOUNT, REGISTER_FORM)


def masked_texts(items: DataFrame, key: str, columns: list[str], masks: tuple[Mask, ...] = MASKS, signs: tuple[str, ...] = SIGNS) -> DataFrame:
    """Rows (key, columns, held): each column masked; ``held`` where a mask would still change a text, or a sign is left.

    The columns of held rows are null. Nulls stay null. No column but the key and the masked ones is taken along.
    """
    mask = lambda c: reduce(lambda t, m: m(t), masks, c)
    once = items.select(key, *(mask(F.col(c)).alias(c) for c in columns))
    still = lambda c: F.coalesce(~mask(F.col(c)).eqNullSafe(F.col(c)) | reduce(lambda a, b: a | b, (F.col(c).rlike(s) for s in signs)), F.lit(False))
    held = once.withColumn("held", reduce(lambda a, b: a | b, (still(c) for c in columns)))
    return held.select(key, *(F.when(~F.col("held"), F.col(c)).alias(c) for c in columns), "held")


def publish_masked(items: DataFrame, root: str, key: str, columns: list[str], masks: tuple[Mask, ...] = MASKS) -> int:
    """Write the masked view of ``items`` as the next version at ``root``; held items keep their row with null texts."""
    return publish(masked_texts(items, key, columns, masks), root)


def assert_masked(df: DataFrame, raw: list[str]) -> DataFrame:
    """``df``, if none of the files it reads lies below one of the ``raw`` paths; else ValueError.

    Asked of the plan of whatever goes to a model or an index: however a text was joined, cut or renamed on its way,
    its source is among the files.
    """
    plain = lambda p: p.removeprefix("file://").removeprefix("file:").replace("//", "/").rstrip("/")
    below = [plain(p) for p in raw]
    if bad := [f for f in df.inputFiles() if any(plain(f) == r or plain(f).startswith(r + "/") for r in below)]:
        raise ValueError(f"reads around the masked view: {bad[0]}")
    return df
