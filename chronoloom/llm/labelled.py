"""Labelled rows for fitting: which may be used, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.sources.shared import materialize


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows kept for testing: crc32 of the id as text leaves 2 when divided by 4. Null ids aren't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], list[int], float | None]:
    """Up to ``rows`` texts of each class, none held out, none over ``max_bytes``, and the share of label 1 among all such.

    Chosen and given in the order of a hash of the id.

    At most 2 * rows * max_bytes bytes come to the driver, whatever the tables'
    size. Rows with a null label, id or text are left out, and ids with both
    labels; of several texts of an id the first in order is used.
    """
    known = labels.select(F.col(id_col).alias("k"), F.col(label).cast("int").alias("y")).filter("y in (0, 1) and k is not null")
    known = known.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("hi")).filter("y = hi").drop("hi")
    known = known.filter(~held_out("k"))
    short = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).filter(F.octet_length("t") <= max_bytes)
    # Choose among ids first; texts are fetched for the chosen alone.
    sized = materialize(known.join(short.select("k").distinct(), "k", "left_semi").withColumn("h", F.xxhash64("k")), "labelled")
    chosen = [r for y in (0, 1) for r in sized.filter(F.col("y") == y).orderBy("h", "k").limit(rows).collect()]
    if not chosen:
        return [], [], None
    picked = docs.sparkSession.createDataFrame([(r["k"], r["y"]) for r in chosen], known.select("k", "y").schema)
    got = {r["k"]: (r["t"], r["y"]) for r in short.join(F.broadcast(picked), "k").groupBy("k", "y").agg(F.min("t").alias("t")).collect()}
    order = [r["k"] for r in sorted(chosen, key=lambda r: (r["h"], r["k"]))]
    share = sized.agg(F.avg("y")).first()[0]
    return [got[k][0] for k in order], [got[k][1] for k in order], share if 0 < share < 1 else None


def logistic(x, y, rounds: int = 60, ridge: float = 1e-3):
    """Weights (the intercept last) of a ridge logistic regression by Newton's method, in numpy."""
    import numpy as np

    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
