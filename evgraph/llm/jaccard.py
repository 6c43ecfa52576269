"""N-gram Jaccard join by MinHash banding.

1. Each text's word n-grams get a MinHash signature; bands and rows follow from the threshold and the target recall. Texts of
   equal words are one class from here on, with its size as weight, so copies never meet as pairs.
2. Signatures are shuffled by band hash. A bucket links each class to its least class only (a star), and components
   of these stars hold all candidate pairs.
3. Each component's full n-gram sets are compared exactly, as products of incidence matrices. A component of more than
   `block` classes is split by set length (length classes of which only neighbours can reach the threshold), a length class of more than
   `block` members by hash into blocks, and pairs of blocks are tasks of their own. Tasks give a count of links and a root for each class, never pairs.
4. Verified links are closed to classes; each document gets its class and its number of links.

The result has a row for each document: `id, class_id` (the least id of the class), `n_links` (documents at the
threshold or above, copies included). A null or empty text, or one without any letter or digit, has no n-grams: such texts equal each
other and nothing else. A text of
fewer words than n has one n-gram of all its words. A null id counts as larger than any and gives a null class_id if no
other member has one. Rows that repeat count as copies. Columns other than id and text aren't read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.llm.bpe import slices
from evgraph.llm.common import NO_ID, keyed, lean, mix, range_hashes, row_key, with_checkpoint_dir
from evgraph.llm.words import shingles, word_hashes
from evgraph.operators.components import connected_components

SLICE = 1 << 20
MOST_HASHES = 144


def choose_bands(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands for which pairs at the threshold still share one with the target recall."""
    best = (1, 1)
    for rows in range(1, most + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else max(1, int(np.ceil(np.log(1 - recall) / np.log1p(-hit))))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return x[:n] | np.uint64(1), x[n:]


def signatures(grams: np.ndarray, begin: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of each text that has n-grams (others keep zeros)."""
    out = np.zeros((len(begin) - 1, bands), dtype=np.uint64)
    full = np.flatnonzero(begin[1:] > begin[:-1])
    if not full.size:
        return out
    a, b = multipliers(bands * rows)
    held = np.zeros((len(full), bands), dtype=np.uint64)
    for j in range(bands * rows):
        x = grams * a[j]
        x += b[j]
        x >>= np.uint64(32)
        least = np.minimum.reduceat(x.astype(np.uint32), begin[full])
        band = held[:, j // rows]
        band *= np.uint64(0xC2B2AE3D27D4EB4F)
        band += least.astype(np.uint64) + np.uint64(1)
    out[full] = mix(held)
    return out


def length_classes(counts: np.ndarray, threshold: float) -> np.ndarray:
    """Length class of each set size: two sets that reach the threshold are of one class or of neighbouring ones."""
    counts = np.maximum(1, counts)
    return (np.log(counts) / np.log(1 / threshold) + 1e-9).astype(np.int64) if threshold < 1 else counts


def sign(docs: DataFrame, ngram: int, bands: int, rows: int, threshold: float) -> DataFrame:
    """id, no_id, key, two hashes of the text's words, its set's length class, and its band hashes (null without n-grams)."""

    def run(batches):
        for batch in batches:
            column = batch.column(3)
            for lo, hi in slices(column, SLICE):
                hashes, first = word_hashes([t or "" for t in column.slice(lo, hi - lo).to_pylist()])
                grams, begin = shingles(hashes, first, ngram)
                sig = signatures(grams, begin, bands, rows)
                s = [range_hashes(hashes, first[:-1], first[1:], k).view(np.int64) for k in range(2)]
                none = begin[1:] == begin[:-1]
                n = np.array([len(np.unique(grams[a:b])) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)], dtype=np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(sig.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))
                lists = pa.compute.if_else(pa.array(none), pa.scalar(None, pa.list_(pa.int64())), lists)
                yield pa.record_batch([*[batch.column(i).slice(lo, hi - lo) for i in range(3)], pa.array(s[0]), pa.array(s[1]), pa.array(length_classes(n, threshold)), lists], names=["id", "no_id", "key", "s1", "s2", "p", "bands"])

    return docs.select("id", "no_id", "key", "text").mapInArrow(lean(run), "id long, no_id boolean, key long, s1 long, s2 long, p long, bands array<long>")


def linked(n: np.ndarray, m: np.ndarray, overlap: np.ndarray, threshold: float) -> np.ndarray:
    union = n[:, None] + m[None, :] - overlap
    return overlap >= threshold * union - 1e-9


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as products of incidence matrices in steps of columns."""
    sets = left if right is None else left + right
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[column] > 1
    rows, column = rows[keep], column[keep]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    new = np.concatenate(([True], column[1:] != column[:-1])) if len(column) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    out = np.zeros((len(left), len(sets) - (0 if right is None else len(left))), dtype=np.float32)
    step = max(64, (1 << 22) // len(sets))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        x = np.zeros((len(sets), min(step, int(column[-1]) + 1 - lo)), dtype=np.float32)
        x[rows[a:b], column[a:b] - lo] = 1
        out += x[: len(left)] @ (x if right is None else x[len(left) :]).T
    return out


def compare(unit: pa.Table, threshold: float) -> pa.Table:
    """Links and roots of a unit's classes. Sides: 0 and 1 meet each other, 2 meet among themselves."""
    comp, side = unit.column("comp").to_numpy(), unit.column("side").to_numpy()
    node, weight = unit.column("node").to_numpy(), unit.column("size").to_numpy()
    order = np.lexsort((node, side, comp))
    order = order[np.concatenate(([True], (node[order[1:]] != node[order[:-1]]) | (side[order[1:]] != side[order[:-1]]) | (comp[order[1:]] != comp[order[:-1]])))] if len(order) else order
    values = unit.column("grams")
    out: tuple[list, list, list] = ([], [], [])
    cut = np.flatnonzero(np.concatenate(([True], comp[order[1:]] != comp[order[:-1]]))) if len(order) else np.zeros(0, np.int64)
    for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(order)], strict=True) if len(order) else []:
        at = order[lo:hi]
        sets = [np.frombuffer(values[int(i)].as_py(), dtype=np.uint64) for i in at]
        n = np.array([len(s) for s in sets], dtype=np.float64)
        split = int(np.searchsorted(side[at], 1)) if side[at[0]] < 2 else 0
        if side[at[0]] < 2:
            if not 0 < split < len(at):
                continue
            hit = linked(n[:split], n[split:], overlaps(sets[:split], sets[split:]), threshold)
            links = np.concatenate((hit @ weight[at[split:]], hit.T @ weight[at[:split]]))
            whole = np.zeros((len(at), len(at)), dtype=bool)
            whole[:split, split:], whole[split:, :split] = hit, hit.T
        else:
            whole = linked(n, n, overlaps(sets, None), threshold)
            np.fill_diagonal(whole, False)
            links = whole @ weight[at]
        root = np.arange(len(at))
        while True:  # least label among neighbours, with a jump to the label's own
            near = np.where(whole, root[None, :], len(at)).min(1)
            new = np.minimum(root, near)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = links > 0
        out[0].append(node[at[some]])
        out[1].append(links[some])
        out[2].append(node[at[root[some]]])
    return pa.table([pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for x in out], names=["node", "links", "root"])


def with_neighbours(members: DataFrame, block: int) -> DataFrame:
    """Adds to members (node, comp, m, p, ...) of components of more than `block` how many there are in their length class and in the
    ones below and above it; nothing (0) to the others, which aren't split."""
    sizes = members.where(F.col("m") > block).groupBy("comp", "p").agg(F.count("*").alias("n"))
    seen = sizes.select("comp", "n", F.explode(F.array(*[F.struct((F.col("p") + d).alias("p"), F.lit(d).alias("d")) for d in (-1, 0, 1)])).alias("x"))
    counts = [F.max(F.when(F.col("x.d") == d, F.col("n"))).alias(c) for c, d in (("below", 1), ("own", 0), ("above", -1))]
    seen = seen.groupBy("comp", F.col("x.p").alias("p")).agg(*counts)
    return members.join(seen, ["comp", "p"], "left").na.fill(0, ["below", "own", "above"])


def units_of(node: int, comp: int, m: int, p: int, beside: tuple[int, int, int], size: int, value: bytes, buckets: int, block: int) -> list[tuple]:
    """The tasks that a set takes part in: its component's, or where that has more than `block` classes, one for each
    pair of a block of its own length class (p) and one of that class or of those beside it (of which there are `beside` members: below, own, above)."""
    if m <= block:
        return [(f"s{comp % buckets}", 2, node, comp, size, value)]
    below, own, above = (-(-n // block) for n in beside)
    out = []
    mine = int(mix(np.array([node], dtype=np.uint64))[0] % np.uint64(own))
    for x in range(own):
        a, b = min(mine, x), max(mine, x)
        out.append((f"{comp}:{p}:{p}:{a}:{b}", 2 if a == b else int(mine == b), node, comp, size, value))
    out += [(f"{comp}:{p}:{p + 1}:{mine}:{x}", 0, node, comp, size, value) for x in range(above)]
    out += [(f"{comp}:{p - 1}:{p}:{x}:{mine}", 1, node, comp, size, value) for x in range(below)]
    return out


UNITS = "unit string, side int, node long, comp long, size long, grams binary"


def unit_batch(out: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=[x.split()[0] for x in UNITS.split(", ")])


def candidates(stars: DataFrame) -> tuple[DataFrame, int]:
    """(node, comp, m) of all nodes that a candidate edge touches, with their component and its size; and how many tasks of small components."""
    groups = connected_components(stars).withColumnRenamed("component", "comp").checkpoint()
    counts = groups.groupBy("comp").agg(F.count("*").alias("m"))
    return groups.join(counts, "comp"), max(8, -(-groups.count() // 1000))


def verified(units: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (node, component) from the units' exact comparison."""
    found = units.groupBy("unit").applyInArrow(lambda t: compare(t, threshold), "node long, links long, root long").checkpoint()
    return found.groupBy("node").agg(F.sum("links").alias("links")), connected_components(found.where("node <> root"), "node", "root")


def join(docs: DataFrame, threshold: float = 0.8, ngram: int = 5, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text", block: int = 1500) -> DataFrame:
    """`id, key, class_id, class_key, n_links` of each document (key: hash of the row; the class's least row has class_key)."""
    with_checkpoint_dir(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall)
    docs = keyed(docs, id_col, text_col)
    signed = sign(docs, ngram, bands, rows, threshold).checkpoint()
    classes = signed.groupBy("s1", "s2").agg(F.min(F.struct("id", "key")).alias("first"), F.count("*").alias("size"), F.max("p").alias("p"), F.max("bands").alias("bands"))
    classes = classes.withColumn("node", F.monotonically_increasing_id()).checkpoint()  # numbers hold once they are written
    each = classes.where("bands is not null").select("node", F.posexplode("bands").alias("band", "h"))
    # written first, so that both sides of the join are plain exchanges and a hot band can be split
    hubs = each.groupBy("band", "h").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("band", "h", "hub").checkpoint()
    stars = each.join(hubs, ["band", "h"]).where("node <> hub").select(F.col("node").alias("src"), F.col("hub").alias("dst")).distinct()
    members, buckets = candidates(stars)
    members = with_neighbours(members.join(classes.select("node", "p", "size"), "node"), block)
    # written first, so that the rows of a representative that repeats can be split in the join below
    members = members.join(classes.select("node", F.col("first.id").alias("id"), F.col("first.key").alias("key")), "node").checkpoint()

    def sets(batches):
        met: set[int] = set()  # nodes that this task has sent: a representative's copies meet here, and one set is enough
        for batch in batches:
            nodes = batch.column(0).to_pylist()
            new = [i for i, node in enumerate(nodes) if node not in met and not met.add(node)]
            batch = batch.take(pa.array(new, pa.int64())) if len(new) < len(nodes) else batch
            column = batch.column(8)
            for lo, hi in slices(column, SLICE):
                hashes, first = word_hashes(column.slice(lo, hi - lo).to_pylist())
                grams, begin = shingles(hashes, first, ngram)
                rows_ = zip(*[batch.column(c).slice(lo, hi - lo).to_pylist() for c in range(8)], strict=True)
                own = (np.unique(grams[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))
                yield unit_batch([u for (node, comp, m, p, *beside, size), x in zip(rows_, own, strict=True) for u in units_of(node, comp, m, p, beside, size, x.tobytes(), buckets, block)])

    texts = docs.select("id", "key", "text").join(members, ["id", "key"]).select("node", "comp", "m", "p", "below", "own", "above", "size", "text")
    links, closed = verified(texts.mapInArrow(lean(sets), UNITS), threshold)
    named = classes.select("s1", "s2", "node", "first", "size").join(links, "node", "left").join(closed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.where("links is not null").groupBy("component").agg(F.min("first").alias("least"))
    named = named.join(least, "component", "left").select("s1", "s2", F.coalesce("least", "first").alias("least"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")).checkpoint()
    out = signed.select("id", "no_id", "key", "s1", "s2").join(named, ["s1", "s2"])
    real = lambda c: F.when(F.col(c) != int(NO_ID), F.col(c))
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias("id"), "key", F.col("least.id").alias("least_id"), F.col("least.key").alias("class_key"), "n_links").withColumn("class_id", real("least_id")).drop("least_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are the least of their class, each once, with all their columns. Of rows of equal id and text the one stays
    whose other columns are least as JSON. A document without an id stays unless its class has another; columns may have any names."""
    found = join(docs, id_col=id_col, text_col=text_col, **options)
    mark = "x" * (1 + max(map(len, docs.columns)))  # names of its own are longer than those of all columns
    key, own_id, place = (f"{mark}{c}" for c in ("key", "id", "place"))
    first = found.where(F.col("key") == F.col("class_key")).select(F.col("key").alias(key), F.coalesce("id", F.lit(int(NO_ID))).alias(own_id)).distinct()
    own = docs.withColumns({key: row_key(F.col(id_col), F.col(text_col)), own_id: F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID)))}).join(first, [own_id, key])
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    tie = [F.col(id_col).isNull(), F.col(text_col).isNull(), *([F.to_json(F.struct(*others))] if others else [])]
    once = own.withColumn(place, F.row_number().over(W.partitionBy(own_id, key).orderBy(*tie)))
    return once.where(F.col(place) == 1).select(*docs.columns)
