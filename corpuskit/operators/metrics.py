"""Scores of predictions: classification, extraction, overlap and ranking.

Everything reduces to counts that are summed in part before the shuffle; the tables that remain are as small as the
class list or the cutoff list.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corpuskit.functions import stems
from corpuskit.session import cut_lineage


SMALL = 1e-6  # fixed value: added to the denominators of extraction scores


def _f1(p: Column, r: Column) -> Column:
    return F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))


def class_counts(df: DataFrame, gold: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Per class seen in gold or prediction: right, predicted and gold rows."""
    confusion = df.groupBy(*by, F.col(gold).alias("__g"), F.col(pred).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    right = F.when(F.col("__g") == F.col("__p"), F.col("__n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("__g").alias("class"), right.alias("right"), none.alias("predicted"), F.col("__n").alias("support")),
        F.struct(F.col("__p").alias("class"), none.alias("right"), F.col("__n").alias("predicted"), none.alias("support")),
    )
    stacked = confusion.select(*by, F.explode(sides).alias("s")).select(*by, "s.*").where(F.col("class").isNotNull())
    sums = [F.sum(c).alias(c) for c in ("right", "predicted", "support")]
    return stacked.groupBy(*by, "class").agg(*sums)


def class_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class; 0 where there is nothing to divide by."""
    p = F.coalesce(F.try_divide("right", "predicted"), F.lit(0.0))
    r = F.coalesce(F.try_divide("right", "support"), F.lit(0.0))
    return counts.withColumn("precision", p).withColumn("recall", r).withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def classification_report(df: DataFrame, gold: str, pred: str, average: str = "macro", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy with macro or support-weighted precision, recall and F1, per value of `by`."""
    scored = class_scores(class_counts(df, gold, pred, by))
    weight = {"macro": F.lit(1.0), "weighted": F.col("support").cast("double")}[average]
    means = [
        F.coalesce(F.try_divide(F.sum(F.col(c) * weight), F.sum(weight)), F.lit(0.0)).alias(c)
        for c in ("precision", "recall", "f1")
    ]
    return scored.groupBy(*by).agg(
        F.try_divide(F.sum("right"), F.sum("support")).alias("accuracy"), *means, F.sum("support").alias("support")
    )


def binary_report(df: DataFrame, gold: str, pred: str, positive: int = 1) -> DataFrame:
    g, p = F.col(gold) == positive, F.col(pred) == positive
    right = F.count_if(g & p)
    f1 = F.try_divide(2 * right, F.count_if(g) + F.count_if(p))
    same = F.count_if(F.col(gold) == F.col(pred))
    return df.agg(F.try_divide(same, F.count(F.lit(1))).alias("accuracy"), F.coalesce(f1, F.lit(0.0)).alias("f1"))


def extraction_report(df: DataFrame, gold: str, predicted: str, classes: Sequence[str]) -> DataFrame:
    """Per class precision, recall and F1 over entity sets; rows without a readable prediction are counted as errors only.

    `gold` and `predicted` map a class to its entities.
    """
    readable = F.col(predicted).isNotNull()

    def members(c: str, name: str) -> Column:
        return F.array_distinct(F.coalesce(F.element_at(F.col(c), F.lit(name)), F.array().cast("array<string>")))

    sums = [F.count_if(~readable).alias("errors")]
    for i, name in enumerate(classes):
        g, p = members(gold, name), members(predicted, name)
        for part, size in (("right", F.size(F.array_intersect(g, p))), ("predicted", F.size(p)), ("gold", F.size(g))):
            sums.append(F.coalesce(F.sum(F.when(readable, size)), F.lit(0)).alias(f"{part}_{i}"))
    one_row = df.agg(*sums)
    per_class = F.array(
        *[
            F.struct(F.lit(name).alias("class"), *[F.col(f"{part}_{i}").alias(part) for part in ("right", "predicted", "gold")])
            for i, name in enumerate(classes)
        ]
    )
    counts = one_row.select("errors", F.explode(per_class).alias("c")).select("errors", "c.*")
    scored = counts.withColumn("precision", F.col("right") / (F.col("predicted") + SMALL)).withColumn(
        "recall", F.col("right") / (F.col("gold") + SMALL)
    )
    return scored.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def multi_label_report(df: DataFrame, gold: str, pred: str, classes: int) -> DataFrame:
    """Rows (metric, value): exact-row accuracy, F1 per class place, macro F1. Inputs are 0/1 arrays."""
    sums = [F.avg((F.col(gold) == F.col(pred)).cast("double")).alias("accuracy")]
    for i in range(classes):
        g, p = F.col(gold)[i] == 1, F.col(pred)[i] == 1
        sums.append(F.coalesce(F.try_divide(2 * F.count_if(g & p), F.count_if(g) + F.count_if(p)), F.lit(0.0)).alias(f"f1_class_{i}"))
    names = [f"f1_class_{i}" for i in range(classes)]
    macro = sum((F.col(n) for n in names), F.lit(0.0)) / classes
    wide = df.agg(*sums).withColumn("f1", macro)
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in ("accuracy", "f1", *names)])
    return wide.select(F.explode(entries).alias("e")).select("e.*")


def rouge_tokens(c: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"), 1)


def _grams(tokens: Column, n: int) -> Column:
    last = F.size(tokens) - n
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    ).otherwise(F.array().cast("array<string>"))


def rouge_table(df: DataFrame, keys: Sequence[str], pred: str, ref: str, stem: bool = False) -> DataFrame:
    """(keys, pred, ref): the tokens of both texts, with `stem` cut to their stems if longer than three letters. `keys` tell rows apart.

    Each distinct token is stemmed once, and texts get the stems back by a join.
    """
    tokens = df.select(*keys, rouge_tokens(F.col(pred)).alias("pred"), rouge_tokens(F.col(ref)).alias("ref"))
    tokens = tokens.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("pred", "ref")})
    if not stem:
        return tokens
    row = F.struct(*keys).alias("__row")
    held = cut_lineage(tokens.select(row, "pred", "ref"), "tokens")
    each = held.select("__row", F.explode(F.array_distinct(F.concat("pred", "ref"))).alias("token"))
    cut = stems.stemmed(each.select("token").distinct(), longer_than=3).where("stem <> token")
    named = each.join(cut, "token").groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("token", "stem"))).alias("__stems"))
    both = held.join(named, "__row", "left")
    short = lambda c: F.transform(c, lambda t: F.coalesce(F.try_element_at("__stems", t), t)).alias(c)
    return both.select("__row.*", short("pred"), short("ref"))


def rouge_n_tokens(tokenised: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """(keys, score) for rows (keys, pred, ref) of tokens: F1 of shared n-grams, each counted as often as both texts have it."""
    tagged = F.concat(
        F.transform(_grams(F.col("pred"), n), lambda g: F.struct(g.alias("g"), F.lit(1).alias("p"), F.lit(0).alias("r"))),
        F.transform(_grams(F.col("ref"), n), lambda g: F.struct(g.alias("g"), F.lit(0).alias("p"), F.lit(1).alias("r"))),
    )
    grams = tokenised.select(*keys, F.explode_outer(tagged).alias("t")).select(*keys, "t.*")
    counted = grams.groupBy(*keys, "g").agg(F.sum("p").alias("p"), F.sum("r").alias("r"))
    totals = counted.groupBy(*keys).agg(
        F.coalesce(F.sum(F.least("p", "r")), F.lit(0)).alias("m"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("p"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("r"),
    )
    return totals.select(*keys, F.coalesce(F.try_divide(2 * F.col("m"), F.col("p") + F.col("r")), F.lit(0.0)).alias("score"))


def rouge_n(df: DataFrame, keys: Sequence[str], pred: str, ref: str, n: int, stem: bool = False) -> DataFrame:
    """(keys, score): F1 of shared n-grams, each counted as often as both texts have it."""
    return rouge_n_tokens(rouge_table(df, keys, pred, ref, stem), keys, n)


def shared_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with the bits of one integer standing for the places in `a`."""
    places: dict[str, int] = {}
    for i, token in enumerate(a):
        places[token] = places.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for token in b:
        hits = row & places.get(token, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(a) - row.bit_count()


def rouge_l(pred: Column, ref: Column) -> Column:
    """F1 of the longest common subsequence of two arrays of tokens; whole texts, one Arrow batch at a time."""

    @pandas_udf("double")
    def run(p: pd.Series, r: pd.Series) -> pd.Series:
        def score(a: list[str], b: list[str]) -> float:
            return 2.0 * shared_subsequence(a, b) / (len(a) + len(b)) if len(a) and len(b) else 0.0

        return pd.Series([score(x, y) for x, y in zip(p, r, strict=True)])

    return run(pred, ref)


def generation_report(df: DataFrame, keys: Sequence[str], pred: str, ref: str, stem: bool = True) -> DataFrame:
    """One row: mean ROUGE-1, ROUGE-2 and ROUGE-L over stems, and the share of equal texts after stripping, to four digits."""
    from corpuskit.functions.text import strip

    tokens = cut_lineage(rouge_table(df, keys, pred, ref, stem), "tokens")
    one, two = (rouge_n_tokens(tokens, keys, n).agg(F.avg("score").alias("s")).scalar() for n in (1, 2))
    longest = tokens.agg(F.avg(rouge_l(F.col("pred"), F.col("ref"))).alias("s")).scalar()
    exact = F.avg((strip(F.col(pred)) == strip(F.col(ref))).cast("double"))
    base = df.agg(exact.alias("__acc"))
    return base.select(
        F.round(one, 4).alias("rouge1"), F.round(two, 4).alias("rouge2"), F.round(longest, 4).alias("rougeL"), F.round("__acc", 4).alias("acc")
    )


def mark_hits(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """Add `hit` to (query, id, rank, ...) from a truth table (query, id)."""
    known = truth.select("query", "id").distinct().withColumn("__t", F.lit(1))
    return ranked.join(known, ["query", "id"], "left").withColumn("hit", F.coalesce("__t", F.lit(0))).drop("__t")


def ranking_report(ranked: DataFrame, queries: DataFrame, cutoffs: Sequence[int]) -> DataFrame:
    """Rows (metric, k, value) of means over all queries, for recall in both forms, MRR and nDCG.

    `ranked` has (query, rank, hit) and `queries` (query, truths): all queries count, also those without any result. The
    ideal of nDCG is the retrieved list itself with its hits in front; equal scores are ranked by id.
    """
    hit = F.col("hit") == 1
    sums = [F.count_if(hit).alias("__hits"), F.min(F.when(hit, F.col("rank"))).alias("__first")]
    for k in cutoffs:
        inside = hit & (F.col("rank") <= k)
        sums.append(F.count_if(inside).alias(f"__hits_{k}"))
        sums.append(F.sum(F.when(inside, 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias(f"__dcg_{k}"))
    per_query = queries.join(ranked.groupBy("query").agg(*sums), "query", "left")
    entries = []
    for k in cutoffs:
        hits = F.coalesce(F.col(f"__hits_{k}"), F.lit(0))
        reachable = F.greatest(F.least(F.lit(k), F.col("truths")), F.lit(1))
        best = F.least(F.lit(k), F.coalesce("__hits", F.lit(0))).cast("int")
        ideal = F.aggregate(
            F.when(best > 0, F.sequence(F.lit(1), best)).otherwise(F.array().cast("array<int>")),
            F.lit(0.0),
            lambda acc, i: acc + 1 / F.log2(i + 1),
        )
        values = {
            "recall_hit": F.least(hits, F.lit(1)) / reachable,
            "recall_set": hits / reachable,
            "mrr": F.when(F.col("__first") <= k, 1 / F.col("__first")).otherwise(0.0),
            "ndcg": F.coalesce(F.try_divide(F.col(f"__dcg_{k}"), ideal), F.lit(0.0)),
        }
        entries += [(name, k, F.avg(value)) for name, value in values.items()]
    wide = per_query.agg(*[value.alias(f"{name}_{k}") for name, k, value in entries])
    stacked = F.array(
        *[F.struct(F.lit(name).alias("metric"), F.lit(k).alias("k"), F.col(f"{name}_{k}").alias("value")) for name, k, _ in entries]
    )
    return wide.select(F.explode(stacked).alias("e")).select("e.*")


