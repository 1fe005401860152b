"""Histograms of numeric columns."""

from pyspark.sql import functions as F


def equal_width(df, column, bins=20, lines=None):
    """At most ``bins`` equal bins between the smallest and largest value of any numeric column.

    One pass finds the bounds, one counts: the bin of a line is computed before the
    partial aggregation, so a task hands on at most ``bins`` rows, however many distinct
    values there are. ``lines`` names a column that says how many lines a row stands for.
    """
    value = F.col(column).cast("double")
    ends = df.select(F.struct(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))).scalar()
    low, spread = F.col("_ends.low"), F.col("_ends.high") - F.col("_ends.low")
    # The largest value closes the last bin; a single value makes a single bin.
    slot = F.floor(F.try_divide((value - low) * bins, spread))
    number = F.least(F.coalesce(slot, F.lit(0)) + 1, F.lit(bins)).cast("int")
    rows = df.dropna(subset=[column]).withColumn("_ends", ends)
    many = F.sum(lines) if lines else F.count("*")
    counted = rows.groupBy(number.alias("bin")).agg(many.alias("nb_lines")).withColumn("_ends", ends)
    return counted.select(
        "bin",
        (low + spread / bins * (F.col("bin") - 1)).alias("bin_from"),
        (low + spread / bins * F.col("bin")).alias("bin_to"),
        "nb_lines",
    ).orderBy("bin")
