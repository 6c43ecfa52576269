"""Edge budgets and heavy-tailed expansion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.operators.components import ensure_checkpoint_dir
from evgraph.schema import DEFAULT_DEGREE, DEGREE_RULES


def degree(from_label: Column, to_label: Column, rules: list | None = None, default: float = DEFAULT_DEGREE) -> Column:
    out = None
    for labels, value in rules if rules is not None else DEGREE_RULES:
        if len(labels) == 2 and labels[0] == labels[1]:
            cond = (from_label == labels[0]) & (to_label == labels[0])
        else:
            cond = from_label.isin(*labels) | to_label.isin(*labels)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return (out.otherwise(F.lit(default)) if out is not None else F.lit(default)).cast("double")


def allocate(rel_specs: DataFrame, nodes: DataFrame, edges: DataFrame, budget: int, rules: list | None = None) -> DataFrame:
    """(type, from_label, to_label, planned, target, existing, need) of each pair that has sources and targets. edges: with labels."""
    counts = nodes.groupBy("entity_type").agg(F.count("*").alias("n"))
    have = edges.groupBy(F.col("_type").alias("type"), "from_label", "to_label").agg(F.count("*").alias("existing"))
    total = edges.agg(F.count("*").alias("_edges"))
    rows = rel_specs.select("type", "from_label", "to_label").distinct()
    rows = rows.join(counts.select(F.col("entity_type").alias("from_label"), F.col("n").alias("sources")), "from_label").join(counts.select(F.col("entity_type").alias("to_label")), "to_label")
    rows = rows.withColumn("planned", F.floor(F.col("sources") * degree(F.col("from_label"), F.col("to_label"), rules))).crossJoin(total)  # a single row
    nominal = F.sum("planned").over(W.partitionBy(F.lit(1)))  # a row for each pair of the schema
    factor = F.coalesce(F.least(F.lit(1.0), F.try_divide(F.greatest(F.lit(0), F.lit(budget) - F.col("_edges")).cast("double"), nominal.cast("double"))), F.lit(0.0))
    rows = rows.withColumn("target", F.greatest(F.lit(1), F.floor(F.col("planned") * factor)))
    rows = rows.join(have, ["type", "from_label", "to_label"], "left").withColumn("existing", F.coalesce("existing", F.lit(0)))
    return rows.select("type", "from_label", "to_label", F.col("planned").cast("long").alias("planned"), F.col("target").cast("long").alias("target"), "existing", F.greatest(F.lit(0), F.col("target") - F.col("existing")).cast("long").alias("need"))


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds `i`, a row's place (from 0) within its group: rows are range-partitioned, counted by partition, and numbered within it, so no
    group is sorted in one task."""
    ensure_checkpoint_dir(rows.sparkSession)
    dealt = rows.repartitionByRange(group, *order).withColumn("_p", F.spark_partition_id()).checkpoint()
    counts = dealt.groupBy(group, "_p").agg(F.count("*").alias("_n"))
    before = counts.select(group, "_p", (F.sum("_n").over(W.partitionBy(group).orderBy("_p")) - F.col("_n")).alias("_before"))  # a row for each partition
    own = F.row_number().over(W.partitionBy(group, "_p").orderBy(*order)) - 1
    return dealt.withColumn("_own", own).join(before, [group, "_p"]).withColumn("i", F.col("_before") + F.col("_own")).drop("_p", "_own", "_before")


def expand(needs: DataFrame, nodes: DataFrame, edges: DataFrame, seed: int = 42, rounds: int = 8) -> DataFrame:
    """New edges (_type, _from, _to): uniform sources, targets biased to the head of their label's order, no self-loops, no
    duplicates, `need` for each pair. The same seed gives the same edges: draws are hashes of a row's number. Draws are repeated, twice as many each
    time, until each pair has what it needs or all its edges; a pair that `rounds` don't fill (its last free edges are unlikely draws) raises an error."""
    ranked = numbered(nodes.select("entity_type", "uid"), "entity_type", "uid").checkpoint()
    counts = {r["entity_type"]: r["n"] for r in nodes.groupBy("entity_type").agg(F.count("*").alias("n")).collect()}  # a row for each label
    have = {(r["_type"], r["from_label"], r["to_label"]): r["n"] for r in edges.where("_from <> _to").select("_type", "_from", "_to", "from_label", "to_label").distinct().groupBy("_type", "from_label", "to_label").agg(F.count("*").alias("n")).collect()}
    want: dict[tuple, int] = {}  # a row for each pair of the schema
    for r in needs.where("need > 0").select("type", "from_label", "to_label", "need").collect():
        key = (r["type"], r["from_label"], r["to_label"])
        sources, goals = counts.get(key[1], 0), counts.get(key[2], 0)
        want[key] = min(r["need"], sources * goals - (sources if key[1] == key[2] else 0) - have.get(key, 0))
    taken = edges.select("_type", "_from", "_to")
    spark, made, drawn = nodes.sparkSession, None, dict.fromkeys(want, 0)
    open_ = {k: n for k, n in want.items() if n > 0}
    for _ in range(rounds):
        if not open_:
            break
        parts = []
        for key, n in open_.items():
            more = 2 * n + 2 * drawn[key]
            sizes = [F.lit(counts[x]).cast("long") for x in key[1:]]
            draws = spark.range(drawn[key], drawn[key] + more).withColumnRenamed("id", "k")
            unit = lambda salt, key=key: (F.pmod(F.xxhash64(*[F.lit(x) for x in key], "k", F.lit(seed), F.lit(salt)), F.lit(1 << 40)) + 0.5) / (1 << 40)
            gauss = F.sqrt(-2 * F.log(unit(2))) * F.cos(2 * 3.141592653589793 * unit(3))
            parts.append(draws.select("k", *[F.lit(x).alias(c) for x, c in zip(key, ("_type", "from_label", "to_label"), strict=True)], F.floor(unit(1) * sizes[0]).alias("si"), F.least(sizes[1] - 1, F.floor(F.abs(gauss) * sizes[1] / 3.2)).alias("ti")))
            drawn[key] += more
        rows = reduce(DataFrame.unionByName, parts)
        rows = rows.join(ranked.select(F.col("entity_type").alias("from_label"), F.col("i").alias("si"), F.col("uid").alias("_from")), ["from_label", "si"])
        rows = rows.join(ranked.select(F.col("entity_type").alias("to_label"), F.col("i").alias("ti"), F.col("uid").alias("_to")), ["to_label", "ti"])
        rows = rows.where("_from <> _to").groupBy("_type", "from_label", "to_label", "_from", "_to").agg(F.min("k").alias("k"))
        rows = rows.join(taken if made is None else taken.unionByName(made.select("_type", "_from", "_to")), ["_type", "_from", "_to"], "left_anti")
        made = (rows if made is None else made.unionByName(rows)).checkpoint()
        found = {(r["_type"], r["from_label"], r["to_label"]): r["n"] for r in made.groupBy("_type", "from_label", "to_label").agg(F.count("*").alias("n")).collect()}
        open_ = {k: n - found.get(k, 0) for k, n in want.items() if n > found.get(k, 0)}
    if open_:
        raise RuntimeError(f"{rounds} rounds of draws left edges open: {open_}")
    columns = ["_type", "_from", "_to", "from_label", "to_label"]
    if made is None:
        return edges.select(*columns).limit(0)
    pair = F.concat_ws("|", "_type", "from_label", "to_label")
    need = F.create_map(*[F.lit(x) for key, n in want.items() for x in ("|".join(key), n)])
    return numbered(made.withColumn("_pair", pair), "_pair", "k", "_from", "_to").where(F.col("i") < need[F.col("_pair")]).select(*columns)
