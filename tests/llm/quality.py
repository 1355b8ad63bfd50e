"""Held-out quality of the models of problems 2 and 4: python tests/llm/quality.py DIRECTORY_OF_TABLES"""

import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from corpusmill.llm import reading_level as rl, subjects as sj  # noqa: E402
from corpusmill.session import materialise, session, table  # noqa: E402


def levels(spark, d: str) -> dict[str, float]:
    """Share of labelled strands whose level, by trees and vocabulary that never saw its source's labels, is the judges'."""
    rated, labels = materialise(rl._rated(table(spark, d, "strands")), "rated"), table(spark, d, "strand_labels")
    t = rl.labelled(rated, labels)
    model = rl.train(rated, labels)
    own = model.level(model.grade(model.held_out))
    want = np.rint(t["grade"].to_numpy(float))
    agreed = (t["judges"] >= 2) & (t["grade"] == want)
    return {"labelled": len(t), "right": float((own == want).mean()), "right where two judges agree": float((own == want)[agreed].mean())}


def areas(spark, d: str) -> dict[str, float]:
    """Precision and recall of the subjects of the labelled strands that the calibrating model never saw."""
    texts = materialise(sj.encoded(sj._rated(table(spark, d, "strands"))), "bags")
    model = sj.train(texts, *(table(spark, d, t) for t in ("strand_labels", "subjects", "stats")))
    p, y = model.held_out
    got, want = np.zeros_like(y), y >= 0.5
    text, c = model.pick(p)
    got[text, c] = 1
    return {"held out": len(y), "precision": float((got * want).sum() / got.sum()), "recall": float((got * want).sum() / want.sum())}


if __name__ == "__main__":
    spark = session(master="local[8]", partitions=8)
    for f in (levels, areas):
        print(f.__name__, {k: round(v, 4) for k, v in f(spark, sys.argv[1]).items()})
    spark.stop()
