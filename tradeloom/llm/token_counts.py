"""Token counts by the whole-token shortcut.

A vocabulary string that encodes alone as one token is worth one wherever it is
a pre-token. This is proved for every string of the vocabulary, by encoding it,
before the first text; merging is left for the other pre-tokens.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.bytebpe import PRETOKENS, SAME_CLASSES, Units, added_tokens, pretoken_encoder, tokenizer
from tradeloom.llm.runtime import ship

TOKENIZER = "byte_bpe_50k.json"


@functools.lru_cache(maxsize=2)
def unit_counts(name: str) -> Units:
    """Tokens of each unit: one for each pre-token proved to be a token, the others' by merging."""
    t, added = tokenizer(name), added_tokens(name)
    whole, merged = pretoken_encoder(name)

    def count(unit: str) -> int:
        if unit in whole:
            return 1
        if not SAME_CLASSES.fullmatch(unit) or any(a in unit for a in added):
            return len(t.encode(unit, add_special_tokens=False).ids)
        return sum(1 if p in whole else len(merged(p)) for p in PRETOKENS.findall(unit))

    return Units(count, added)


def count_tokens(docs: DataFrame, limit: int = 1024, tokenizer_name: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens and whether these are more than ``limit``.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null; repeated rows are counted each for
    itself. Other columns, whatever their names, are not read. An empty table gives an empty result.
    One pass, no shuffle: the work of a row depends on its text alone.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        units = unit_counts(tokenizer_name)
        for batch in texts:
            yield pd.Series([sum(units.parts(t)) if t else 0 for t in batch], dtype="int64")

    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), tokens(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
