"""Customer segments and label rules, kept as tables and applied first match first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label, then the inclusive ranges of the recency, frequency and monetary scores.
SEGMENTS_8 = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (3, 5), (3, 5), (1, 2)),
    ("At Risk", (1, 2), (4, 5), (1, 5)),
    ("Can't Lose Them", (1, 2), (1, 2), (3, 5)),
    ("Lost Customers", (1, 2), (1, 2), (1, 5)),
]
SEGMENTS_8_DEFAULT = "Others"

SEGMENTS_12 = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("Potential Loyalists", (4, 5), (2, 4), (1, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("Promising", (3, 5), (1, 2), (1, 5)),
    ("Need Attention", (2, 3), (2, 3), (1, 5)),
    ("About to Sleep", (1, 3), (1, 3), (1, 3)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("Cant Lose Them", (1, 2), (1, 5), (4, 5)),
    ("Hibernating", (1, 2), (1, 2), (1, 5)),
    ("Lost", (1, 1), (1, 5), (1, 5)),
]
SEGMENTS_12_DEFAULT = "Other"

SEGMENTS_6 = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (4, 5), (1, 5)),
    ("Lost", (1, 2), (1, 2), (1, 5)),
]
SEGMENTS_6_DEFAULT = "Others"

PRIORITIES = [
    (1, (4, 5), (4, 5), (4, 5)),
    (2, (1, 2), (1, 5), (4, 5)),
    (3, (1, 2), (3, 5), (1, 5)),
    (4, (3, 5), (3, 5), (3, 5)),
    (5, (4, 5), (1, 2), (1, 5)),
]
PRIORITY_DEFAULT = 6

ACTIONS = [
    (["Champions"], "VIP - Priority support"),
    (["Loyal Customers", "Potential Loyalist"], "High Value - Retention focus"),
    (["New Customers"], "Nurture - Welcome program"),
    (["At Risk", "About to Sleep"], "Win Back - Re-engagement"),
]
ACTION_DEFAULT = "Standard"

HEALTH_BANDS = [(5, "Excellent"), (2, "Good"), (1, "Average")]
HEALTH_DEFAULT = "Needs Improvement"

# Labels the at-risk report looks for, in both spellings in use.
AT_RISK_SEGMENTS = ["At Risk", "Cant Lose Them", "Can't Lose Them"]


def _first_match(branches: list[tuple[Column, object]], default: object) -> Column:
    """The value of the first branch that holds."""
    return F.coalesce(*[F.when(test, F.lit(value)) for test, value in branches], F.lit(default))


def _score_rules(rules: list, default: object, scores: tuple[Column, Column, Column]) -> Column:
    branches = [
        (reduce(Column.__and__, [score.between(*span) for score, span in zip(scores, spans)]), value)
        for value, *spans in rules
    ]
    return _first_match(branches, default)


def segment_8(r: Column, f: Column, m: Column) -> Column:
    return _score_rules(SEGMENTS_8, SEGMENTS_8_DEFAULT, (r, f, m))


def segment_12(r: Column, f: Column, m: Column) -> Column:
    return _score_rules(SEGMENTS_12, SEGMENTS_12_DEFAULT, (r, f, m))


def segment_6(r: Column, f: Column, m: Column) -> Column:
    return _score_rules(SEGMENTS_6, SEGMENTS_6_DEFAULT, (r, f, m))


def segment_priority(r: Column, f: Column, m: Column) -> Column:
    return _score_rules(PRIORITIES, PRIORITY_DEFAULT, (r, f, m))


def action_recommendation(segment: Column) -> Column:
    return _first_match([(segment.isin(labels), action) for labels, action in ACTIONS], ACTION_DEFAULT)


def funnel_health(conversion: Column) -> Column:
    return _first_match([(conversion >= low, label) for low, label in HEALTH_BANDS], HEALTH_DEFAULT)
