"""Scalar functions on places, dates, shares and probabilities."""

from __future__ import annotations

from math import comb

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Points by place, as (last place, points).
POINTS = ((1, 5), (2, 4), (4, 3), (8, 2), (16, 1))
#: Fixed value: games from which a win rate is trusted.
TRUSTED_GAMES = 150


def rounded(x: Column | str, digits: int = 2) -> Column:
    """Rounded half to even on the scaled binary value, as column arithmetic in doubles does."""
    x = F.col(x) if isinstance(x, str) else x
    return F.rint(x * 10.0**digits) / 10.0**digits


def steady(x: Column | str, digits: int = 2) -> Column:
    """As `rounded`, for sums of fractions: what the order of adding leaves in the last bits (beyond nine more digits) doesn't
    decide which way an exact half goes."""
    x = F.col(x) if isinstance(x, str) else x
    return F.rint(F.round(x * 10.0**digits, 9)) / 10.0**digits


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """100 part / whole."""
    value = part / whole * 100.0
    return value if digits is None else rounded(value, digits)


def league_points(place: Column | str) -> Column:
    """Points of a finish; none beyond the sixteenth place or without a number."""
    at = F.floor((F.col(place) if isinstance(place, str) else place).cast("string").try_cast("double"))
    out = F.lit(0)
    for last, points in reversed(POINTS):
        out = F.when(at.between(1, last), points).otherwise(out)
    return out


def premier_points(place: Column | str) -> Column:
    """A premier event counts twice."""
    return league_points(place) * 2


def season(day: Column | str) -> Column:
    """The season of a date as a struct (label, start, end); winter runs from December to February and has both years."""
    day = F.col(day) if isinstance(day, str) else day
    month, year = F.month(day), F.year(day)
    first = F.when(month < 3, year - 1).otherwise(year)
    made = lambda y, m: F.make_date(y, F.lit(m), F.lit(1))
    name = lambda word: F.concat(F.lit(word + " "), year.cast("string"))
    winter = F.concat(F.lit("Winter "), first.cast("string"), F.lit("/"), F.lpad((F.pmod(first + 1, F.lit(100))).cast("string"), 2, "0"))
    label = F.when(month.between(3, 5), name("Spring")).when(month.between(6, 8), name("Summer")).when(month.between(9, 11), name("Autumn")).otherwise(winter)
    start = F.when(month.between(3, 5), made(year, 3)).when(month.between(6, 8), made(year, 6)).when(month.between(9, 11), made(year, 9)).otherwise(made(first, 12))
    return F.struct(label.alias("label"), start.alias("start"), F.last_day(F.add_months(start, 2)).alias("end"))


def season_slug(label: Column | str) -> Column:
    """A season's label as part of a file name."""
    label = F.col(label) if isinstance(label, str) else label
    return F.replace(F.replace(label, F.lit("/"), F.lit("-")), F.lit(" "), F.lit("_"))


def latest_sunday(day: Column | str) -> Column:
    """The last Sunday up to a date."""
    day = F.col(day) if isinstance(day, str) else day
    return F.date_sub(day, F.dayofweek(day) - 1)


def windows(end: Column, count: int, days: int) -> Column:
    """`count` windows (start, end) of `days` days, one week apart, the newest first."""
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.struct(F.date_sub(end, 7 * i + (days - 1)).alias("start"), F.date_sub(end, 7 * i).alias("end")))


def months_between(start: Column, end: Column) -> Column:
    """First days of all months that a range touches."""
    return F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))


def week_folder(start: Column, end: Column) -> Column:
    """`2026/03/W11_2026-03-02_to_2026-03-15`, by the ISO week of the end."""
    text = lambda d: F.date_format(d, "yyyy-MM-dd")
    return F.concat(F.date_format(end, "yyyy/MM/"), F.format_string("W%02d_", F.weekofyear(end)), text(start), F.lit("_to_"), text(end))


def week_of_path(path: Column) -> Column:
    """(week_start, week_end) of a path that has such a folder in it, else nulls."""
    part = lambda i: F.try_to_date(F.regexp_extract(path, r"W\d{2,}_(\d{4}-\d{2}-\d{2})_to_(\d{4}-\d{2}-\d{2})", i))
    return F.struct(part(1).alias("week_start"), part(2).alias("week_end"))


def next_anchor(latest_end: Column, today: Column) -> Column:
    """A week after the first Sunday from the end of the latest run on; without a run, or more than a week ahead, the last Sunday."""
    due = F.date_add(F.next_day(F.date_sub(latest_end, 1), "Sun"), 7)
    return F.when(due <= F.date_add(today, 7), due).otherwise(latest_sunday(today))


def trend_label(now: Column, past: Column, threshold: float = 1.0) -> Column:
    """Rising, Falling or Stable, as the difference is beyond the threshold."""
    return F.when(now - past > threshold, "Rising").when(now - past < -threshold, "Falling").otherwise("Stable")


def prep_priority(quartile: Column | str) -> Column:
    """Q4 to Q1 as Very High to Low."""
    q = F.col(quartile) if isinstance(quartile, str) else quartile
    return F.when(q == "Q4", "Very High").when(q == "Q3", "High").when(q == "Q2", "Medium").otherwise("Low")


def trust_label(games: Column | str) -> Column:
    """Whether a win rate rests on enough games."""
    g = F.col(games) if isinstance(games, str) else games
    return F.when(g >= TRUSTED_GAMES, "Trusted").otherwise("Sample")


def record_probabilities(rate: Column, rounds: int) -> Column:
    """Chances of 0 to `rounds` wins, the rate cut to 0..1."""
    p = F.least(F.greatest(rate, F.lit(0.0)), F.lit(1.0))

    def chance(wins: Column) -> Column:
        ways = F.aggregate(F.sequence(F.lit(1), F.greatest(wins, F.lit(1))), F.lit(1.0), lambda a, i: a * (rounds - i + 1) / i)
        return F.when(wins == 0, F.lit(1.0)).otherwise(ways) * F.pow(p, wins) * F.pow(1 - p, rounds - wins)

    return F.transform(F.sequence(F.lit(0), F.lit(rounds)), chance)


def copies(share: Column, population: int) -> Column:
    """Copies of a deck in the population, from its share in percent, rounded half to even."""
    return F.rint(share * population / 100).cast("int")


def hits_at_least_one(own: Column, population: int, draws: int, *, none: float = 1.0) -> Column:
    """Hypergeometric chance of meeting one of `own` copies in `draws`; `none` is the value for no copies at all."""
    miss = F.aggregate(F.sequence(F.lit(0), F.lit(draws - 1)), F.lit(1.0), lambda a, i: a * (population - own - i) / (population - i)) if draws else F.lit(1.0)
    return F.when(own <= 0, F.lit(none)).otherwise(1 - F.greatest(miss, F.lit(0.0)))


def hits_at_least(own: Column, population: int, draws: int, least: int = 1) -> Column:
    """Hypergeometric chance of meeting `least` of `own` copies or more in `draws` of the population.

    As many as can be met are enough, so that without copies the chance is 1. Copies count as the whole population at most.
    Nothing drawn, nobody there or nothing asked for is 0.
    """
    if population <= 0 or draws <= 0 or least <= 0:
        return F.lit(0.0)
    draws = min(draws, population)
    own = F.least(F.greatest(own, F.lit(0)), F.lit(population))
    most = F.least(own, F.lit(draws))
    ways = F.array(*(F.lit(float(comb(draws, k))) for k in range(draws + 1)))

    def chance(k: Column) -> Column:  # each order of the draws is as likely: first the hits, then the others
        part = lambda i: F.when(i < k, own - i).otherwise(F.lit(population) - own - (i - k)) / (F.lit(float(population)) - i)
        return F.get(ways, k) * F.aggregate(F.sequence(F.lit(0), F.lit(draws - 1)), F.lit(1.0), lambda a, i: a * part(i))

    counts = F.sequence(F.least(F.lit(least), most), most)
    return F.aggregate(F.transform(counts, chance), F.lit(0.0), lambda a, b: a + b)


def reachable_score(score: Column, rounds: Column) -> Column:
    """Whether a Swiss score is 3 w + d with w + d at most the rounds."""
    return F.when((rounds > 0) & (score >= 0), F.exists(F.sequence(F.lit(0), F.greatest(rounds, F.lit(0))), lambda w: (score - 3 * w).between(0, rounds - w))).otherwise(score == 0)
