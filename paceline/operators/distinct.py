"""Distinct counts that can be added to: exact bitmaps per label, kept and merged.

A distinct count over new results would have to read all results again. Bitmaps are kept instead, one for
each label and range of 32,768 ids: the same ids set the same bits, so bitmaps of any files merge by "or"
and their bits are the distinct ids, of any sign and size. A bitmap has 4 KB, so it suits ids that are dense.
A null id counts nothing but keeps its label. No task gets more than one label's bitmaps of one range.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, label: str, id: str) -> DataFrame:
    """(label, bucket, bits): the ids that each label has."""
    return df.groupBy(label, F.bitmap_bucket_number(id).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id)).alias("bits"))


def merged(label: str, *bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several parts as those of the whole."""
    every = reduce(DataFrame.unionByName, bitmaps)
    return every.groupBy(label, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, label: str, out: str) -> DataFrame:
    """How many distinct ids each label has."""
    counts = F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0))
    return bitmaps.groupBy(label).agg(counts.alias(out))
