"""First-match banding rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest delay, in days, of each delivery band, and the band beyond them.
DELAY_BANDS = [
    (-5, "5+ days early"),
    (-1, "Early"),
    (0, "On time"),
    (5, "1-5 days late"),
]
LATEST_BAND = "5+ days late"

# Score ranges (recency, frequency, monetary) of each customer segment. The ranges
# overlap; the first rule that fits decides.
LOW, ANY = (1, 2), (1, 5)
SEGMENTS = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal", (3, 5), (3, 5), ANY),
    ("New / Promising", (4, 5), LOW, ANY),
    ("Big Spenders", (3, 5), ANY, (4, 5)),
    ("At Risk", LOW, (3, 5), ANY),
    ("Can't Lose Them", LOW, ANY, (4, 5)),
    ("Lost", LOW, LOW, ANY),
]
SEGMENT_OTHERWISE = "Needs Attention"
SEGMENT_UNKNOWN = "Unknown"


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first rule that holds."""
    (condition, label), *rest = rules
    chain = reduce(lambda acc, rule: acc.when(*rule), rest, F.when(condition, label))
    return chain.otherwise(otherwise)


def delay_band(delay_days: Column) -> Column:
    return first_match([(delay_days <= top, label) for top, label in DELAY_BANDS], LATEST_BAND)


def customer_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Segment of a customer from its three scores (1 to 5)."""
    scores = (recency, frequency, monetary)
    rules = [
        (reduce(and_, [score.between(*limits) for score, limits in zip(scores, ranges) if limits != ANY]), label)
        for label, *ranges in SEGMENTS
    ]
    return first_match(rules, SEGMENT_OTHERWISE)
