"""Names resolved by a table of aliases of any size: exact alias, else the longest alias a text contains.

Every stretch of a text that is as long as some alias is a possible alias. Stretches meet the table by equality, so work
follows the texts' lengths and the number of different alias lengths, not the number of aliases. Texts are made
distinct first: many records share few spellings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.session import stage


def longest_aliases(texts: DataFrame, aliases: DataFrame, text: str = "text", alias: str = "alias", canonical: str = "canonical") -> DataFrame:
    """One row per distinct text that is or contains an alias: text, alias, canonical.

    The whole text counts as its longest stretch, so an exact alias wins. Of aliases of one length the first in the
    text wins; of several rows of one alias the smallest canonical name. Null and empty texts and aliases meet nothing.
    """
    known = stage(
        aliases.filter(F.col(alias).isNotNull() & (F.col(alias) != "")).groupBy(F.col(alias).alias("__alias")).agg(F.min(canonical).alias("__canonical")), "aliases"
    )
    # Few numbers, however many aliases there are.
    lengths = sorted(r[0] for r in known.select(F.length("__alias").alias("n")).distinct().collect())
    if not lengths:
        return texts.sparkSession.createDataFrame([], f"`{text}` string, alias string, canonical string")
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(text))
    one = texts.select(text).filter(F.col(text).isNotNull()).distinct().select(text, F.explode(sizes).alias("__n"))
    each = one.select(text, "__n", F.explode(F.sequence(F.lit(1), F.length(text) - F.col("__n") + 1)).alias("__at"))
    met = each.withColumn("__alias", F.substring(text, F.col("__at"), F.col("__n"))).join(known, "__alias")
    best = met.groupBy(text).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col("__at").alias("at"), "__alias", "__canonical")).alias("b"))
    return best.select(text, F.col("b.__alias").alias("alias"), F.col("b.__canonical").alias("canonical"))
