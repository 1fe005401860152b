"""Top-k, both ends of a ranking and quantile cuts over grouped rows.

Nothing here sorts or gathers all groups in one task: ends are top-k selections, totals
single values, and a quantile is found by counting values in bins, again and again within
the bin where it lies.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderlens.sources.tables import written_aside

#: Bins per counting pass: at most so many rows reach the driver.
BINS = 1 << 16


def top_k(grouped, measure, key, k):
    """The k largest by ``measure``, smallest first; ties go by key."""
    best = grouped.orderBy(F.col(measure).desc(), F.col(key)).limit(k)
    return best.sortWithinPartitions(F.col(measure).asc(), F.col(key).desc())


@dataclass(frozen=True)
class Grouped:
    """Grouped rows, written once, with the count and bounds of their measure."""

    rows: DataFrame
    measure: str
    n: int
    low: float | None
    high: float | None

    def quantiles(self, quantiles):
        """Interpolated quantiles of the measure, exactly; None where no row has a value.

        NULL measures are left out, and those that are not finite.
        """
        ranks = [q * (self.n - 1) for q in quantiles]
        wanted = sorted({int(r) + d for r in ranks for d in (0, 1) if 0 <= int(r) + d < self.n})
        values = dict(zip(wanted, ranked_values(self.rows, self.measure, wanted, self.low, self.high)))
        out = []
        for rank in ranks:
            low = values.get(int(rank)) if self.n else None
            high = values.get(int(rank) + 1, low)
            out.append(None if low is None else low + (rank - int(rank)) * (high - low))
        return out

    def above_quantile(self, q):
        """Rows strictly above the interpolated quantile of the measure."""
        (cut,) = self.quantiles([q])
        return self.rows.where(F.col(self.measure) > F.lit(cut).cast("double"))


def _finite(measure):
    value = F.col(measure).cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def above_quantile(grouped, measure, q):
    """Groups strictly above the interpolated quantile of the grouped measure."""
    return grouped_aside(grouped, measure).above_quantile(q)


def grouped_aside(grouped, measure):
    """Write grouped rows once for all that is read from them; what bounds a quantile is noted meanwhile."""
    seen = Observation()
    value = _finite(measure)
    bounds = [F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")]
    rows = written_aside(grouped.observe(seen, *bounds))
    return Grouped(rows, measure, **seen.get)


def ranked_values(rows, measure, ranks, low, high):
    """The values at ascending ranks (from 0) among the non-NULL values of a column.

    Every pass counts the values of each span that still holds a rank, in ``BINS`` equal
    bins by partial aggregation, with the least and largest value of each bin; the bins
    that hold the ranks are the spans of the next. Bounds are values that occur, so a
    span always divides; spread as values may be, each pass leaves one bin of 2**16. A
    span of one value is done. No value is gathered, and nothing is approximate.
    """
    value = _finite(measure)
    found, spans = {}, [(low, high, 0, list(ranks))]  # least, largest, rows below, ranks inside
    while spans:
        for least, largest, below, inside in [s for s in spans if s[0] == s[1]]:
            found |= dict.fromkeys(inside, least)
        spans = [s for s in spans if s[0] != s[1]]
        if not spans:
            break
        tests = [value.between(least, largest) for least, largest, _, _ in spans]
        bins = [_bin(value, least, largest) for least, largest, _, _ in spans]
        span = reduce(lambda c, i: c.when(tests[i], i), range(1, len(spans)), F.when(tests[0], 0))
        place = reduce(lambda c, i: c.when(tests[i], bins[i]), range(1, len(spans)), F.when(tests[0], bins[0]))
        grouped = rows.where(reduce(lambda a, b: a | b, tests)).groupBy(span.alias("span"), place.alias("bin"))
        counted = grouped.agg(F.count("*"), F.min(value), F.max(value)).collect()
        spans = _narrowed(spans, counted)
    return [found[r] for r in ranks]


def _bin(value, least, largest):
    # The spread of two very large values is beyond a double, that of their halves is not.
    part = 1.0 if largest - least < float("inf") else 0.5
    share = (value * part - least * part) / (largest * part - least * part)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1))


def _narrowed(spans, counted):
    """The bins that hold ranks, as spans."""
    out = []
    for number, (_, _, below, inside) in enumerate(spans):
        for _, _, n, least, largest in sorted((r for r in counted if r[0] == number), key=lambda r: r[1]):
            here = [r for r in inside if below <= r < below + n]
            if here:
                out.append((least, largest, below, here))
            below += n
    return out


def both_ends(grouped, measure, key, k):
    """The k lowest and the k highest groups, with their position from the lowest.

    Reads ``grouped`` three times: hand it in written (``grouped_aside``) where it is costly.

    Two top-k selections; their k rows each are numbered in place. A group that
    belongs to both ends comes out twice, as a UNION ALL of the two cuts would give.
    """
    columns = grouped.columns
    rank = F.struct(F.col(measure).isNull(), F.col(measure), F.col(key), F.struct(*columns).alias("row"))
    n = grouped.select(F.count("*")).scalar()
    sides = {
        "flop": ([F.col(measure).asc_nulls_last(), F.col(key).asc()], F.col("at") + 1),
        "top": ([F.col(measure).desc_nulls_first(), F.col(key).desc()], n - F.size("all") + F.col("at") + 1),
    }
    ends = []
    for side, (order, position) in sides.items():
        listed = grouped.orderBy(*order).limit(k).agg(F.array_sort(F.collect_list(rank)).alias("all"))
        numbered = listed.select("all", F.posexplode("all").alias("at", "one"))
        ends.append(numbered.select("one.row.*", position.cast("int").alias("position"), F.lit(side).alias("side")))
    return reduce(DataFrame.unionByName, ends).select(*columns, "position", "side")


def share_of_total(grouped, measure, name):
    total = grouped.select(F.sum(measure)).scalar()
    return grouped.withColumn(name, 100.0 * F.col(measure) / total)
