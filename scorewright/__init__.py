"""scorewright: a declarative points-scorecard engine on Spark.

A scorecard is data (knock-out rules, sentinels, imputations, caps, derived
flags, lookup weights, linear models, scaling and bands).  ``score`` compiles
it into a handful of narrow ``select`` layers plus one broadcast lookup, so a
whole population is scored in a single stage with no Python UDFs.
"""

from scorewright.operators.score import score, score_append, working_frame
from scorewright.models.two_card import two_card

__all__ = ["score", "score_append", "working_frame", "two_card"]
