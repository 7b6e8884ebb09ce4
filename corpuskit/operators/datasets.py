"""Training and evaluation sets: negatives, groups, splits and records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.arrays import IGNORED_LABEL
from corpuskit.functions.hashing import draw_hex, draw_int
from corpuskit.functions.prompts import render, replace_keyword
from corpuskit.operators import lookups, rows, tokens


def class_records(df: DataFrame, text: str, label: Column, categories: Sequence[str], system: str, human: str) -> DataFrame:
    """Instruction records of a classification task; the instruction lists the categories."""
    listed = "\n".join(f'"{c}"' for c in categories)
    return df.select(
        *[c for c in df.columns if c != text],
        render(system, {"categories": listed}).alias("instruction"),
        render(human, {"input": F.col(text)}).alias("input"),
        label.alias("output"),
    )


def keyword_records(df: DataFrame, text: str, label: str, template: str, keyword: str) -> DataFrame:
    """Instruction records whose instruction is the template with the text in place of a keyword."""
    return df.select(
        *[c for c in df.columns if c not in (text, label)],
        replace_keyword(template, keyword, F.col(text)).alias("instruction"),
        F.lit("").alias("input"),
        F.col(label).alias("output"),
    )


def negative_ids(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """`n` other rows for each row as (key, j, neg): distinct, never the row itself; all others when there are too few.

    The rows get positions in a seeded shuffle. The other positions, counted from a row's own, are cut into `n` equal stretches, and each
    negative is a draw of its own from one stretch: distinct, and independent of what neighbours draw. The candidates come from one
    equi-join on the position, each position being asked for about `n` times.
    """
    places = rows.index_by_draw(df.select(key), seed, key, name="__p")
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    others = F.greatest(total - 1, F.lit(0))
    first, end = F.floor(F.col("j") * others / n), F.floor((F.col("j") + 1) * others / n)
    drawn = first + draw_int(f"{seed}-gap", key, "j") % F.greatest(end - first, F.lit(1))
    gap = 1 + F.when(others >= n, drawn).otherwise(F.col("j"))
    step = places.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("__gap", gap)
    wanted = step.where(F.col("__gap") < total).withColumn("__p", (F.col("__p") + F.col("__gap")) % total)
    return wanted.join(places.withColumnRenamed(key, "neg"), "__p").select(key, "j", "neg")


def random_negatives(df: DataFrame, key: str, pos: str, n: int, seed: str) -> DataFrame:
    """(key, j, neg, text): one random positive text of each of `n` other rows; null where that row has none."""
    ids = negative_ids(df, key, n, seed)
    donors = df.select(F.col(key).alias("neg"), F.col(pos).alias("__pos"))
    pick = draw_int(f"{seed}-pos", key, "j") % F.greatest(F.size("__pos"), F.lit(1)) + 1
    return ids.join(donors, "neg").select(key, "j", "neg", F.try_element_at("__pos", pick.cast("int")).alias("text"))


def class_triples(df: DataFrame, key: str, label: str, n: int, seed: str) -> DataFrame:
    """(key, class, j, other, is_pos): one row of the own class (it may be the row itself), `n` of each other class.

    A class with fewer than `n` rows gives all of them; rows without a class are no class. Members are numbered inside their class and asked for by number.
    """
    df = df.where(F.col(label).isNotNull())
    members = rows.index_by_draw(df.select(key, label), seed, key, by=[label], name="__i")
    sizes = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("__n"))
    classes = df.select(F.col(label).alias("class")).distinct()
    asked = lookups.each_with(df.select(key, label), classes, "class").join(sizes, "class")
    own = F.col("class") == F.col(label)
    count = F.when(own, F.lit(1)).otherwise(F.least(F.lit(n), F.col("__n"))).cast("int")
    picks = asked.withColumn("j", F.explode(F.sequence(F.lit(0), count - 1)))
    # As many equal stretches of the class as it gives rows, and a draw of its own from each.
    first, end = F.floor(F.col("j") * F.col("__n") / count), F.floor((F.col("j") + 1) * F.col("__n") / count)
    drawn = first + draw_int(f"{seed}-start", key, "class", "j") % (end - first)
    numbered = picks.withColumn("__i", drawn).withColumn("is_pos", own.cast("int"))
    others = members.select(F.col(label).alias("class"), "__i", F.col(key).alias("other"))
    return numbered.join(others, ["class", "__i"]).select(key, "class", "j", "other", "is_pos")


def training_group(key: Column, pos: Column, neg: Column, size: int, seed: str) -> Column:
    """One positive, then `size - 1` negatives; a short list of negatives is repeated as often as needed."""
    wanted = size - 1
    one = F.try_element_at(pos, (draw_int(f"{seed}-pos", key) % F.greatest(F.size(pos), F.lit(1)) + 1).cast("int"))
    times = F.ceil(F.lit(wanted) / F.greatest(F.size(neg), F.lit(1))).cast("int")
    repeated = F.flatten(F.array_repeat(neg, times))
    drawn = F.transform(repeated, lambda t, i: F.struct(draw_hex(seed, key, i).alias("d"), i.alias("i"), t.alias("t")))
    chosen = F.transform(F.slice(F.array_sort(drawn), 1, wanted), lambda e: e["t"])
    return F.concat(F.array(one), chosen)


def pretraining_text(parts: Sequence[Column], end_mark: str) -> Column:
    """The parts in one run of text and the end mark after them."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts], F.lit(end_mark))


def question_answer_pairs(df: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, turn, question, answer): each user turn with the assistant turn right after it."""
    asked = df.where(F.col("role") == "user").select(conv, turn, F.col("text").alias("question"))
    answered = df.where(F.col("role") == "assistant").select(
        conv, (F.col(turn) - 1).alias(turn), F.col("text").alias("answer")
    )
    return asked.join(answered, [conv, turn])


def tuning_rows(df: DataFrame, keys: Sequence[str], prompt: Column, answer: Column, vocab: DataFrame, end_id: int) -> DataFrame:
    """Token ids of prompt, answer and end mark, with labels that skip the prompt.

    `vocab` has the columns (token, id). Ids are looked up one token per row, then put back in order; a row is as long
    as its own text. The end id must differ from the pad id, or padding would hide the label of the end mark.
    """
    counted = df.select(*keys, prompt.alias("__prompt"), answer.alias("__answer"))
    both = F.concat("__prompt", "__answer")
    looked_up = tokens.token_ids(counted, keys, both, vocab)
    ordered = F.sort_array(F.collect_list(F.struct("pos", "id")))
    gathered = looked_up.groupBy(*keys).agg(F.transform(ordered, lambda e: e["id"]).alias("__ids"))
    sized = counted.select(*keys, F.size("__prompt").alias("__skip")).join(gathered, list(keys), "left")
    ids = F.concat(F.coalesce("__ids", F.array().cast("array<bigint>")), F.array(F.lit(end_id).cast("bigint")))
    full = sized.select(*keys, "__skip", ids.alias("input_ids"))
    labels = F.transform("input_ids", lambda x, i: F.when(i < F.col("__skip"), F.lit(IGNORED_LABEL)).otherwise(x))
    return full.select(*keys, "input_ids", labels.alias("labels"))


def evaluation_set(df: DataFrame, key: str, query: Column, pos: Column, prompt: str) -> DataFrame:
    """(id, query, pos, prompt) with running string ids."""
    return rows.string_ids(df, key).select("id", query.alias("query"), pos.alias("pos"), F.lit(prompt).alias("prompt"))


def corpus(df: DataFrame, key: str, pos: Column) -> DataFrame:
    """All positive texts, one per row, repeats kept."""
    return df.select(key, F.explode(pos).alias("text"))


def arithmetic(df: DataFrame, key: str, operators: int, seed: str, largest: int = 100) -> DataFrame:
    """An expression per key with `operators` signs and its value; `x` multiplies and binds first."""
    # The signs an expression is drawn from.
    signs = F.array(F.lit("+"), F.lit("-"), F.lit("x"))
    number = [(1 + draw_int(f"{seed}-n{i}", key) % largest).cast("bigint") for i in range(operators + 1)]
    sign = [F.element_at(signs, (draw_int(f"{seed}-s{i}", key) % 3 + 1).cast("int")) for i in range(operators)]
    steps = F.array(*[F.struct(s.alias("s"), v.alias("v")) for s, v in zip(sign, number[1:], strict=True)])
    # `done` is the sum of finished products, `open` the product still growing.
    zero = F.struct(F.lit(0).cast("bigint").alias("done"), number[0].alias("open"))

    def advance(acc: Column, e: Column) -> Column:
        times = e["s"] == "x"
        fresh = F.when(e["s"] == "-", -e["v"]).otherwise(e["v"])
        return F.struct(
            F.when(times, acc["done"]).otherwise(acc["done"] + acc["open"]).alias("done"),
            F.when(times, acc["open"] * e["v"]).otherwise(fresh).alias("open"),
        )

    result = F.aggregate(steps, zero, advance, lambda acc: acc["done"] + acc["open"])
    text = F.concat_ws(" ", number[0].cast("string"), *[c for s, v in zip(sign, number[1:], strict=True) for c in (s, v.cast("string"))])
    return df.select(key, text.alias("expression"), result.alias("result"))
