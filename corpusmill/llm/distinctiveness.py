"""Problem 6: how characteristic a keyword is of its file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusmill.llm._terms import file_count, file_terms
from corpusmill.session import materialise

SALTS = 256


def term_scores(keywords: DataFrame, alpha: float = 0.75, presence: bool = False, hot_share: float = 1 / 20) -> DataFrame:
    """file_path, keyword, f, n, ppmi, weight of each keyword (plain form) of each file, f its occurrences and n the files that hold it.

    ppmi = max(0, ln(p(t,d) / (p(t) p_alpha(d)))): the positive pointwise mutual information of term and file, from the
    joint counts and their margins by term and by file; the file's share is that of its margin raised to alpha. Joint
    counts are occurrences, or with `presence` 1 for each file that holds the term. With presence and alpha 0 all files
    weigh the same and the information is ln(N/n) of N files. weight = f * ppmi.

    Null and blank keywords and rows without file_path are left out, a null frequency counts as 1, exact duplicate rows
    count once; N counts files without a keyword too. An empty table gives no rows.

    The one join whose key can be hot is that of a term with its counts. Terms in more than `hot_share` of the files
    number at most (mean terms of a file)/hot_share, so their counts are broadcast; all others join by shuffle.
    """
    pairs = materialise(file_terms(keywords), "file-terms")
    n_files = file_count(keywords)
    joint = F.lit(1).cast("bigint") if presence else F.col("f")
    term = pairs.groupBy("term").agg(F.count("*").alias("n"), F.sum(joint).alias("of_term"))
    context = F.pow(F.col("of_file").cast("double"), F.lit(float(alpha)))
    files = pairs.groupBy("file_path").agg(F.sum(joint).alias("of_file")) if alpha else None
    # Files without any keyword have no margin; only an exponent of 0 gives them a share.
    contexts = float(files.agg(F.sum(context)).first()[0] or 0) if alpha else float(n_files)
    hot = term.where(F.col("n") > F.lit(hot_share * n_files)).select("term", F.col("n").alias("hot_n"), F.col("of_term").alias("hot_of"))
    cold = term.where(F.col("n") <= F.lit(hot_share * n_files)).select(F.col("term").alias("key"), "n", "of_term")
    rows = pairs.join(F.broadcast(hot), "term", "left")
    # Rows already served get keys that match nothing, spread over many partitions.
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("file_path"), F.lit(SALTS)).cast("string"))
    rows = rows.withColumn("key", F.when(F.col("hot_n").isNull(), F.col("term")).otherwise(spread))
    rows = rows.join(cold, "key", "left").select("file_path", "term", "f", F.coalesce("hot_n", "n").alias("n"), F.coalesce("hot_of", "of_term").alias("of_term"))
    own = F.lit(1.0)
    if alpha:
        rows, own = rows.join(files, "file_path"), context
    # Total and joint count cancel: p(t,d)/p(t) is joint/margin of the term.
    pmi = F.log((joint * F.lit(contexts)) / (F.col("of_term") * own))
    ppmi = F.greatest(F.lit(0.0), pmi)
    return rows.select("file_path", F.col("term").alias("keyword"), "f", "n", ppmi.alias("ppmi"), (F.col("f") * ppmi).alias("weight"))


def top_keyword(scores: DataFrame, by: str = "weight") -> DataFrame:
    """file_path, keyword: of each file the keyword with the greatest score; of equal ones the first in binary order."""
    best = scores.groupBy("file_path").agg(F.min_by("keyword", F.struct((-F.col(by)).alias("s"), F.col("keyword").alias("k"))).alias("keyword"))
    return best.select("file_path", "keyword")
