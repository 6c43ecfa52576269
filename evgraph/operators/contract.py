"""Stamping, hashing and validation of nodes and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evgraph.schema import EDGE_REQUIRED, NODE_REQUIRED, SYNTHESIS_METHODS


def uid(label: Column, canonical_id: Column) -> Column:
    return F.concat_ws(":", label, canonical_id)


def edge_id(source: Column, kind: Column, target: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", source, kind, target), 256), 1, 32)


def record_hash(*columns: str) -> Column:
    """SHA-256 of the named properties as JSON, in name order; lifecycle fields aren't among them."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def lifecycle(now: Column, created: Column | None = None) -> dict[str, Column]:
    start = F.coalesce(created, now) if created is not None else now
    return {"created_at": start, "updated_at": now, "ingested_at": now, "valid_from": start, "valid_to": F.lit(None).cast("timestamp")}


def provenance(source: Column, priority: Column, synthetic: Column, method: Column, url: Column | None = None, ids: Column | None = None, retrieved: Column | None = None) -> dict[str, Column]:
    """`ids` are the record's ids at its source; where there are none, the source itself stands for them."""
    given = F.coalesce(ids, F.array().cast("array<string>")) if ids is not None else F.array().cast("array<string>")
    return {
        "source": source, "source_priority": priority.cast("long"), "source_ids": F.when(F.size(given) > 0, given).otherwise(F.array(source)), "is_synthetic": synthetic, "synthesis_method": method,
        "source_url": url if url is not None else F.lit(None).cast("string"), "source_retrieved_at": retrieved if retrieved is not None else F.lit(None).cast("timestamp"),
    }


def derived(method: str, parent: Column) -> dict[str, Column]:
    """A child keeps its source and becomes synthetic."""
    return {"is_synthetic": F.lit(True), "synthesis_method": F.lit(method), "synthesis_seed_uid": parent}


def own_ids(rows: DataFrame, prov: dict[str, Column]) -> dict[str, Column]:
    """prov, but ids that a row has itself go first."""
    if "source_ids" not in rows.columns:
        return prov
    return prov | {"source_ids": F.when(F.size("source_ids") > 0, F.col("source_ids")).otherwise(prov["source_ids"])}


def stamp_nodes(rows: DataFrame, label: Column, now: Column, prov: dict[str, Column], own: list[str], layer: str = "core", versions: tuple[int, int, int] = (1, 1, 2), created: Column | None = None) -> DataFrame:
    """Adds identity, provenance, lifecycle, versions and hash to rows that have canonical_id; `own` names their own properties."""
    arrays = {c: F.coalesce(F.col(c), F.array().cast("array<string>")) if c in rows.columns else F.array().cast("array<string>") for c in ("synonyms", "ontology_refs")}
    seed = {} if "synthesis_seed_uid" in rows.columns else {"synthesis_seed_uid": F.lit(None).cast("string")}
    out = rows.withColumns({"entity_type": label, **arrays, **seed, **own_ids(rows, prov), **lifecycle(now, created)})
    return out.withColumns({
        "uid": uid(F.col("entity_type"), F.col("canonical_id")), "Dv_created": F.lit(versions[0]).cast("long"), "Tv_created": F.lit(versions[1]).cast("long"),
        "schema_version": F.lit(versions[2]).cast("long"), "record_hash": record_hash(*own), "layer": F.lit(layer),
    })


def stamp_edges(rows: DataFrame, now: Column, prov: dict[str, Column], own: list[str], layer: str = "core", versions: tuple[int, int, int] = (1, 1, 2), created: Column | None = None) -> DataFrame:
    """The same for rows that have _from, _type and _to; the id follows from these."""
    datasets = F.coalesce(F.col("dataset_ids"), F.array().cast("array<string>")) if "dataset_ids" in rows.columns else F.array().cast("array<string>")
    return rows.withColumns({
        "edge_id": edge_id(F.col("_from"), F.col("_type"), F.col("_to")), "dataset_ids": datasets, **own_ids(rows, prov), **lifecycle(now, created),
        "Dv_created": F.lit(versions[0]).cast("long"), "Tv_created": F.lit(versions[1]).cast("long"), "schema_version": F.lit(versions[2]).cast("long"),
        "record_hash": record_hash(*own), "layer": F.lit(layer),
    })


def _problems(checks: list[tuple[Column, Column | str]]) -> Column:
    found = [F.when(F.coalesce(cond, F.lit(False)), m if isinstance(m, Column) else F.lit(m)) for cond, m in checks]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def absent(rows: DataFrame, field: str) -> Column:
    """A field is missing where it is null, or where the table has no such column."""
    return F.col(field).isNull() if field in rows.columns else F.lit(True)


def with_columns(rows: DataFrame, fields: list[str]) -> DataFrame:
    return rows.withColumns({x: F.lit(None).cast("string") for x in fields if x not in rows.columns})


def unknown_fields(rows: DataFrame) -> Column:
    """Problems of type fields that a label requires and the table has no column for."""
    lost = F.array_except("required", F.array(*[F.lit(x) for x in rows.columns]).cast("array<string>"))
    return F.coalesce(F.transform(lost, lambda x: F.concat(F.lit("missing type field "), x)), F.array().cast("array<string>"))


def provenance_checks() -> list[tuple[Column, str]]:
    c = F.col
    return [
        (~c("source_priority").isin(1, 2), "source_priority must be 1 or 2"),
        (c("is_synthetic") & c("synthesis_method").isNull(), "synthetic without method"),
        (~c("is_synthetic") & c("synthesis_method").isNotNull(), "method without synthetic"),
        (c("synthesis_method").isNotNull() & ~c("synthesis_method").isin(*SYNTHESIS_METHODS), "unknown synthesis method"),
        (c("source").isNull() | (F.trim("source") == ""), "empty source"),
    ]


def provenance_violations(rows: DataFrame, key: str = "uid") -> DataFrame:
    return rows.select(key, F.explode(_problems(provenance_checks())).alias("problem"))


def node_violations(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(uid, problem) of each broken rule. labels: (label, layer, species_agnostic, required ARRAY<STRING>), a few rows."""
    spec = F.broadcast(labels.select(F.col("label").alias("entity_type"), F.col("layer").alias("_layer"), "species_agnostic", "required"))
    rows = with_columns(nodes, [*NODE_REQUIRED, "synthesis_method"]).join(spec, "entity_type", "left")
    c = F.col
    known, has_method = c("_layer").isNotNull(), F.coalesce(c("synthesis_method") != "", F.lit(False))  # an empty method is none
    own = [x for x in nodes.columns if x not in NODE_REQUIRED]
    missing = [(known & F.array_contains("required", x) & c(x).isNull(), f"missing type field {x}") for x in own]
    checks = [
        *[(absent(nodes, x), f"missing {x}") for x in NODE_REQUIRED],
        (~known, F.concat(F.lit("unknown label "), F.coalesce("entity_type", F.lit("null")))),  # such a node has no rules beyond the required fields
        (known & ~c("uid").eqNullSafe(uid(c("entity_type"), c("canonical_id"))), "uid mismatch"),
        (known & ~c("layer").eqNullSafe(c("_layer")), "layer mismatch"),
        (known & (c("updated_at") < c("created_at")), "updated before created"),
        (known & ~c("species_agnostic") & absent(nodes, "species"), "missing species"),
        (known & c("is_synthetic") & ~has_method, "synthetic without method"),
        (known & ~c("is_synthetic") & has_method, "method without synthetic"),
        *missing,
    ]
    return rows.select("uid", F.explode(F.concat(_problems(checks), unknown_fields(nodes))).alias("problem"))


def judged_nodes(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds reasons (empty if valid) before stamping: unknown label, empty id, missing type field or species. The specs are broadcast: nodes
    shuffled by their label would all land in as many tasks as there are labels."""
    spec = F.broadcast(labels.select(F.col("label").alias("entity_type"), "species_agnostic", "required"))
    c = F.col
    known = c("required").isNotNull()
    checks = [
        (~known, "unknown label"),
        (c("canonical_id").isNull() | (F.trim("canonical_id") == ""), "empty canonical id"),
        (known & ~c("species_agnostic") & absent(rows, "species"), "missing species"),
        *[(known & F.array_contains("required", x) & c(x).isNull(), f"missing type field {x}") for x in rows.columns if x not in ("entity_type", "canonical_id")],
    ]
    return rows.join(spec, "entity_type", "left").withColumn("reasons", F.concat(_problems(checks), unknown_fields(rows))).select(*rows.columns, "reasons")


def split_nodes(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with reasons) of `judged_nodes`."""
    judged = judged_nodes(rows, labels)
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)


def edge_reasons(rows: DataFrame, required: list[str] | None = None) -> Column:
    """Why an edge is rejected (empty if valid): self-loops and missing fields; a field without a column is missing everywhere."""
    return _problems([(F.col("_from") == F.col("_to"), "self-loop"), *[(absent(rows, x), f"missing {x}") for x in required or EDGE_REQUIRED]])


def split_edges(rows: DataFrame, required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with reasons) by `edge_reasons`."""
    judged = rows.withColumn("reasons", edge_reasons(rows, required))
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)


def gate(duplicates: DataFrame, violations: DataFrame) -> None:
    """Fails the job if any uniqueness or contract rule is broken; shows the first 10 and 20."""
    for name, rows, n in (("uniqueness", duplicates, 10), ("contract", violations, 20)):
        shown = rows.limit(n).collect()
        if shown:
            raise ValueError(f"{name} violations: {[r.asDict() for r in shown]}")


def labelled(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds from_label and to_label by the nodes (null for a missing end)."""
    n = nodes.select("uid", "entity_type")
    out = edges.drop("from_label", "to_label")
    out = out.join(n.select(F.col("uid").alias("_from"), F.col("entity_type").alias("from_label")), "_from", "left")
    return out.join(n.select(F.col("uid").alias("_to"), F.col("entity_type").alias("to_label")), "_to", "left")


def nonconforming(edges: DataFrame, rel_specs: DataFrame) -> DataFrame:
    """Edges (with labels) whose triple isn't an allowed one."""
    allowed = rel_specs.select(F.col("type").alias("_type"), "from_label", "to_label")
    return edges.join(allowed, ["_type", "from_label", "to_label"], "left_anti")


def coverage(edges: DataFrame, rel_specs: DataFrame) -> DataFrame:
    """One row: pairs declared, built, and the list of those not built."""
    built = edges.select(F.col("_type").alias("type"), "from_label", "to_label").distinct().withColumn("built", F.lit(1))
    both = rel_specs.select("type", "from_label", "to_label").join(built, ["type", "from_label", "to_label"], "left")
    name = F.concat_ws("|", "type", "from_label", "to_label")
    return both.agg(F.count("*").alias("declared"), F.count("built").alias("built"), F.array_sort(F.collect_list(F.when(F.col("built").isNull(), name))).alias("unbuilt"))
