"""Filter interaction audit: what each filter removes after each choice of earlier filters.

Every filter has a table of the ids that fail it. What comes before a step is a set of filters, so that all orders together need only the
sets: a set's survivors are the ids without a match among the set's tables (left-anti join), a filter's removals after a set are its own ids
without such a match (left-anti), and its redundancies those with one (left-semi). Losses are the same joins over a filter's ids that are
labelled (left-semi joined with the label's ids). Sets are numbers with a bit per filter, and one join serves all sets: each side is
shuffled once by id, and the set is a condition of the join. Ids that fail no filter are counted and never shuffled.

Ids are made here, one per row, so null and repeated keys are rows of their own; null keys have no label. A label counts once for a
key, however many rows give it. A null part is the empty string. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.session import cut_lineage, scratch_path

BLANKS = r"[ \t\n\x0B\f\r]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def identified(df: DataFrame, key: str, part: str, tests: dict[str, Column], body: Column) -> DataFrame:
    """(id, key, part, digest, and a column per test): a slim table of all rows, written once."""
    flags = [test.alias(name) for name, test in tests.items()]
    slim = df.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(body, 256)).alias("digest"), *flags)
    return cut_lineage(slim.withColumn("id", F.monotonically_increasing_id()), "identified")


def later_copies(rows: DataFrame) -> DataFrame:
    """(id, part, key) of rows whose digest a smaller key has too."""
    first = rows.groupBy("digest").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most")
    held = cut_lineage(first.select("digest", "least"), "first")
    return rows.join(held, "digest").filter(F.col("key") > F.col("least")).select("id", "part", "key")


def failing_tables(rows: DataFrame, tests: list[str], copies: str | None = None) -> dict[str, DataFrame]:
    """A written table (id, part, key) per filter: the rows whose test holds, and the later copies under the name `copies`."""
    spark, folder, out = rows.sparkSession, scratch_path(rows.sparkSession, "failing"), {}
    made = {name: rows.filter(F.col(name)).select("id", "part", "key") for name in tests}
    if copies:
        made[copies] = later_copies(rows)
    for name, table in made.items():
        table.write.parquet(f"{folder}/{name}")
        out[name] = spark.read.schema(table.schema).parquet(f"{folder}/{name}")
    return out


def _union(tables: dict[str, DataFrame]) -> DataFrame:
    """(id, part, filter): filter is the number of the table."""
    parts = [t.withColumn("filter", F.lit(i).cast("int")) for i, t in enumerate(tables.values())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _after(ids: DataFrame, failures: DataFrame, sets: Column, how: str) -> DataFrame:
    """The rows (id, set) of `ids` with or without a match among the tables of each of their sets. Rows are dealt out before they multiply."""
    left = ids.repartition("id").withColumn("set", F.explode(sets)).alias("l")
    within = F.expr("(shiftright(l.set, r.filter) & 1) = 1")
    return left.join(failures.select("id", "filter").alias("r"), (F.col("l.id") == F.col("r.id")) & within, how)


def interactions(rows: DataFrame, tables: dict[str, DataFrame], labels: dict[str, DataFrame]) -> DataFrame:
    """(part, totals, kept, removed, redundant, lost_<label>...): counts by set for each part.

    `kept` is a map of sets to survivors; the others are maps of (filter << 16) + set. What is missing in a map is zero. `labels` are
    tables of keys.
    """
    n = len(tables)
    failures = cut_lineage(_union(tables), "failures")
    every = F.sequence(F.lit(0), F.lit((1 << n) - 1))
    others = F.filter(every, lambda s: s.bitwiseAND(F.expr("shiftleft(1, filter)")) == 0)
    code = F.expr("shiftleft(filter, 16) + set").alias("code")

    def counted(df: DataFrame, kind: str, by: Column) -> DataFrame:
        return df.groupBy("part", by).agg(F.count("*").alias("count")).select("part", F.lit(kind).alias("kind"), "code", "count")

    failing = failures.groupBy("id").agg(F.min("part").alias("part"))
    found = [
        counted(_after(failing, failures, every, "left_anti"), "kept", F.col("set").alias("code")),
        counted(_after(failures, failures, others, "left_anti"), "removed", code),
        counted(_after(failures, failures, others, "left_semi"), "redundant", code),
        # All rows, and those that fail nothing: they survive every set.
        rows.groupBy("part").agg(F.count("*").alias("count")).select("part", F.lit("all").alias("kind"), F.lit(0).alias("code"), "count"),
        counted(failing.withColumn("code", F.lit(0)), "failing", F.col("code")),
    ]
    for name, keys in labels.items():
        labelled = failures.join(keys.select("key"), "key", "left_semi")
        found.append(counted(_after(labelled, failures, others, "left_anti"), name, code))
    both = found[0]
    for f in found[1:]:
        both = both.unionByName(f)
    held = cut_lineage(both, "interactions")
    kinds = ["kept", "removed", "redundant", *labels]
    entry = F.struct("code", "count")
    maps = [F.map_from_entries(F.collect_list(F.when(F.col("kind") == k, entry))).alias(k) for k in kinds]
    total, some = (F.coalesce(F.max(F.when(F.col("kind") == k, F.col("count"))), F.lit(0)) for k in ("all", "failing"))
    return held.groupBy("part").agg((total - some).alias("sound"), *maps)


def steps(counts: DataFrame, names: str, losses: dict[str, str]) -> DataFrame:
    """A row per part, order of the filters and step, from the counts of `interactions`.

    `names` has a letter per filter; `losses` names the output column of each label. `shapley` weighs what a filter removes after each set
    by the number of orders in which exactly that set comes before it.
    """
    n, full = len(names), (1 << len(names)) - 1
    plan = []
    for order in permutations(range(n)):
        before = 0
        for at, f in enumerate(order):
            plan.append(F.struct(F.lit("".join(names[i] for i in order)).alias("filter_order"), F.lit(at + 1).alias("step"), F.lit(f).alias("filter"), F.lit(before).alias("before")))
            before |= 1 << f

    def at(kind: str, code: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col(kind), code), F.lit(0)).cast("bigint")

    one, first = F.expr("shiftleft(1, s.filter)"), F.expr("shiftleft(s.filter, 16)")
    code = first + F.col("s.before")
    value = []
    for f in range(n):
        befores = [s for s in range(full + 1) if not s >> f & 1]
        terms = [at("removed", F.lit((f << 16) + s)) * (factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())) for s in befores]
        value.append(sum(terms[1:], terms[0]))
    each = counts.withColumn("values", F.array(*value)).withColumn("s", F.explode(F.array(*plan)))
    return each.select(
        "part",
        "s.filter_order",
        "s.step",
        (F.col("sound") + at("kept", F.col("s.before") + one)).alias("kept"),
        at("removed", code).alias("removed"),
        at("redundant", code).alias("redundant"),
        at("removed", first + F.lit(full) - one).alias("unique_fails"),
        *[at(label, code).alias(column) for label, column in losses.items()],
        F.element_at("values", F.col("s.filter") + 1).alias("shapley"),
    )
