"""Engine evaluations written in move comments."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from plyforge.schemas import LOGISTIC_SCALING, MATE_CENTIPAWNS

# Fixed value: a pawn score with decimals, or a mate distance.
EVAL_PATTERN = r"\[%eval (?:([+-]?\d+\.\d+)|#([+-]?\d+))\]"


LEAST_INT, MOST_INT = -2.0**31, 2.0**31 - 1


def has_eval(comment: Column) -> Column:
    return F.coalesce(comment.rlike(EVAL_PATTERN), F.lit(False))


def extract_eval(comment: Column) -> Column:
    """First evaluation in the comment, in centipawns; null without one.

    The product is a double and the cast cuts toward zero, so "0.29" is 28. A score beyond the range of an integer is
    the nearest end of the range.
    """
    pawns = F.regexp_extract(comment, EVAL_PATTERN, 1)
    mate = F.regexp_extract(comment, EVAL_PATTERN, 2)
    return (
        F.when(pawns != "", F.least(F.greatest(pawns.cast("double") * 100, F.lit(LEAST_INT)), F.lit(MOST_INT)).cast("int"))
        .when(mate.startswith("-"), F.lit(-MATE_CENTIPAWNS))
        .when(mate != "", F.lit(MATE_CENTIPAWNS))
    )


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def win_probability(eval_cp: Column, scaling: float = LOGISTIC_SCALING) -> Column:
    return sigmoid(eval_cp / F.lit(scaling))


def sigmoid_cross_entropy(logit: Column, label: Column) -> Column:
    """Binary cross-entropy of a logit against a soft label, in the form that does not overflow."""
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))
