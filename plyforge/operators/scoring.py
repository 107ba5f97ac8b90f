"""Scoring encoded boards with a model the user brings."""

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from plyforge.functions.evals import sigmoid
from plyforge.schemas import SQUARES


def score_boards(
    boards: DataFrame, make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]], batch_rows: int = 8192
) -> DataFrame:
    """Adds `logit` and `probability`.

    `make_predict_fn` runs once per Python worker and returns a function from a (batch, 64) array of tokens to
    one logit per board.
    """
    score = predict_batch_udf(
        make_predict_fn, return_type=DoubleType(), batch_size=batch_rows, input_tensor_shapes=[[SQUARES]])
    return boards.withColumn("logit", score("features")).withColumn("probability", sigmoid(F.col("logit")))
