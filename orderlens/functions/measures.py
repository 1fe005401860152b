"""Aggregates and derived measures used by marts and exploration queries.

Two families of rates exist on purpose. Marts keep lines without a status in the
denominator and round; exploration ignores unknown flags and does not round.
"""

from functools import reduce

from pyspark.sql import functions as F


def kept():
    """Lines that were not cancelled; an unknown status counts as kept."""
    return ~F.coalesce(F.col("is_canceled"), F.lit(False))


def total(column):
    """Exact decimal sum, handed out as a double."""
    return F.sum(column).cast("double")


def round_to(value, digits):
    """Round a double half away from zero on the scaled value."""
    scale = 10.0**digits
    return F.round(value * scale) / scale


def safe_ratio(numerator, denominator):
    """NULL where the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_of(numerator, denominator):
    return safe_ratio(100.0 * numerator.cast("double"), denominator)


def mean_of_decimal(column):
    """Mean from the exact sum, so partitioning cannot change the last digit."""
    return safe_ratio(F.sum(column), F.count(column))


# --- mart definitions ----------------------------------------------------------


def mart_late_rate():
    return round_to(percent_of(F.count_if("is_late"), F.count_if(kept())), 1)


def mart_on_time_rate():
    return round_to(percent_of(F.count_if("is_on_time"), F.count_if(kept())), 1)


# --- exploration definitions ---------------------------------------------------


def flag_rate(flag):
    """Share of a flag among kept lines, in percent; NULL without any known flag."""
    return F.avg(F.when(kept(), F.col(flag).cast("int"))) * 100.0


def count_names(flag):
    return f"_{flag}", f"_{flag}_known"


def flag_counts(flag):
    """Kept lines with a flag, and those for which it is known: counts that add up."""
    hits, known = count_names(flag)
    return F.count_if(kept() & F.col(flag)).alias(hits), F.count(F.when(kept(), F.col(flag))).alias(known)


def rate_of_counts(flag):
    """``flag_rate`` from the counts of ``flag_counts``."""
    hits, known = count_names(flag)
    return safe_ratio(F.col(hits), F.col(known)) * 100.0


def overall_late_rate():
    """Late share in percent, 0 when every line was cancelled."""
    return F.when(F.count_if(kept()) == 0, 0.0).otherwise(flag_rate("is_late"))


def margin(profit, sales):
    return safe_ratio(profit, sales) * 100.0


def identified_sales():
    """Sales of the lines whose order is known, the numerator of the mean basket."""
    return F.sum(F.when(F.col("order_id").isNotNull(), F.col("sales")))


# --- bands ---------------------------------------------------------------------


def band(steps, default):
    """First label whose condition holds; ``steps`` is a list of (condition, label)."""
    first, *others = steps
    chain = reduce(lambda c, step: c.when(*step), others, F.when(*first))
    return chain.otherwise(default)


# Cut points of the traffic-light bands.
TARGET_TOLERANCE = 15
DELAY_LIMIT = 0.5
MARGIN_GOAL = 10
CATEGORY_MARGIN_FLOOR = 5
LATE_RATE_CUTS = (50, 20)
SCORE_CUTS = (99, 90)


def late_target_tone(rate, target):
    steps = [(rate <= target, "good"), (rate <= target + TARGET_TOLERANCE, "warn")]
    return band(steps, "bad")


def delay_tone(days):
    return band([(days > DELAY_LIMIT, "bad")], "good")


def margin_tone(value):
    return band([(value >= MARGIN_GOAL, "good")], "warn")


def category_tone(value):
    return band([(value < CATEGORY_MARGIN_FLOOR, "bad")], "good")


def late_rate_tone(rate):
    bad, warn = LATE_RATE_CUTS
    return band([(rate > bad, "bad"), (rate > warn, "warn")], "good")


def score_tone(score):
    good, warn = SCORE_CUTS
    return band([(score >= good, "good"), (score >= warn, "warn")], "bad")


def failure_tone(failed):
    return band([(failed > 0, "bad")], "good")
