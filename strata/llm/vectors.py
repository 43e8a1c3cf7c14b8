"""Embedding near-duplicates by NN-descent.

Equal vectors fold into one node. Random groups and sign-of-projection leaves, in as many tables as
RECALL asks for, give each node a first neighbour list; then neighbours of neighbours are compared,
node by node, until the lists hardly change. Wherever nodes are compared, the links that connect them
are kept beside the lists, however full these are, and nodes of a leaf too large for one comparison
are compared across its parts if they are in different components. An audit of some nodes against all
repeats the search until RECALL is met. Then links are counted: in a component, nodes within half
the link angle of the component's first node are all linked to each other (triangle inequality), and
the other nodes are compared with the component in blocks. Links are pairs at or above the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stored
from strata.llm.components import components

#: Cosine from which two vectors link; share of links to be found.
THRESHOLD, RECALL = 0.9, 0.98
#: Entries of a neighbour list; nodes of a leaf (about) and at most (about), and of a random group.
LIST, LEAF, LEAF_MOST, RANDOM = 10, 256, 512, 32
#: Leaf tables compared at a time; nodes of a part of a crowded leaf; nodes audited.
STEP, PART, ASKED = 4, 2048, 512
#: Most rounds, and the share of changed entries at which rounds end.
ROUNDS, STILL = 8, 0.001
#: Rows of a block in which nodes are compared with their component.
BLOCK = 512
NODE = "node long, weight long, unit array<double>"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, unit): unit vectors; rows that link with nothing are left out."""
    for batch in batches:
        rows, units = [], []
        for row, v in zip(batch.column("_row").to_pylist(), batch.column("_vector")):
            v = v.as_py()
            if not v or any(x is None for x in v):
                continue
            x = np.array(v, float)
            most = np.abs(x).max()
            if not np.isfinite(most) or most == 0:
                continue
            x = x / most
            rows.append(row)
            units.append(x / math.sqrt(float(x @ x)))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(units, pa.list_(pa.float64()))],
                                         names=["_row", "unit"])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows that come sorted by ``keys``; a group may span batches."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held:
            table = pa.concat_tables([*held, table])
        codes = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(table.num_rows - 1, bool)
        for c in codes:
            change |= c[1:] != c[:-1]
        bounds = np.concatenate([[0], np.flatnonzero(change) + 1])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield table.slice(a, b - a)
        held = [table.slice(int(bounds[-1]))]
    if held:
        yield held[0]


def _leaves(bits: int, tables: range):
    """Each node once a table, with the signs of its projections on that table's planes."""
    planes: dict[int, np.ndarray] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("unit").value_lengths().to_numpy()
            for dim in np.unique(size).tolist():
                part = batch.filter(pa.array(size == dim))
                if dim not in planes:
                    planes[dim] = np.concatenate(
                        [np.random.default_rng([17, dim, t]).normal(size=(bits, dim)) for t in tables])
                signs = (_matrix(part.column("unit")) @ planes[dim].T > 0).reshape(-1, len(tables), bits)
                leaf = (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2) * 65536 + dim
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(leaf.tolist(), pa.list_(pa.int64()))], names=["node", "leaves"])
    return run


def _forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (two places each) that connect what the symmetric matrix ``hit`` connects, without rings."""
    left = hit.any(axis=1)
    a, b = [], []
    for start in np.flatnonzero(left).tolist():
        if not left[start]:
            continue
        left[start] = False
        ahead = [start]
        while ahead:
            at = ahead.pop()
            new = np.flatnonzero(hit[at] & left)
            left[new] = False
            a.append(np.full(len(new), at))
            b.append(new)
            ahead.extend(new.tolist())
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def _pairs(keys: list[str], most: int):
    """Compares the nodes of each group: (a, b, cosine, link) of the best ``most`` of each node, whatever
    their cosine, and (``link``, both ways round) pairs that connect all of the group that links connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for group in _groups(batches, keys):
            node = group.column("node").to_numpy()
            if len(node) > 1:
                x = _matrix(group.column("unit").combine_chunks())
                s = x @ x.T
                np.fill_diagonal(s, -2)
                i, j = _forest(s >= THRESHOLD)
                out.append((np.concatenate([node[i], node[j]]), np.concatenate([node[j], node[i]]),
                            np.tile(s[i, j], 2), np.ones(2 * len(i), bool)))
                if most and len(node) > most + 1:
                    s[s < np.partition(s, -most, axis=1)[:, -most][:, None]] = -2
                i, j = np.nonzero(s > -2) if most else (np.empty(0, int), np.empty(0, int))
                out.append((node[i], node[j], s[i, j], np.zeros(len(i), bool)))
            if len(out) > 400:
                yield _entries(out)
                out = []
        if out:
            yield _entries(out)
    return run


PAIRS = "a long, b long, cosine double, link boolean"


def _entries(parts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)],
                                      names=["a", "b", "cosine", "link"])


def _best(pairs: DataFrame, most: int) -> DataFrame:
    """Neighbour lists: the best ``most`` entries of each node, and all links. A group gives each of its
    nodes that node's best, so no entry has to be turned round."""
    pairs = pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.max("link").alias("link"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    return pairs.withColumn("_rank", rank).where((F.col("_rank") <= most) | F.col("link")).drop("_rank")


def leaf_bits(count: int) -> tuple[int, int]:
    """Bits of a leaf and tables, so that two nodes at the link angle share a leaf of some table with
    probability RECALL."""
    bits = max(1, min(40, math.ceil(math.log2(max(2, count) / LEAF))))
    meet = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - meet))


def _places(nodes: DataFrame, bits: int, tables: range) -> DataFrame:
    """(table, leaf, node, _n): the nodes of each leaf, with their number."""
    places = stored(map_arrow(nodes, _leaves(bits, tables), "node long, leaves array<long>")
                    .select("node", F.posexplode("leaves").alias("table", "leaf"))
                    .withColumn("table", F.col("table") + tables.start), "vector-leaves")
    size = places.groupBy("table", "leaf").agg(F.count(F.lit(1)).alias("_n"))
    return places.join(size, ["table", "leaf"]).where("_n > 1")


def _meet(nodes: DataFrame, dealt: DataFrame, most: int) -> DataFrame:
    """_pairs of the groups (table, leaf, salt) that ``dealt`` puts nodes in."""
    keys = ["table", "leaf", "salt"]
    return map_arrow(dealt.select(*keys, "node").join(nodes, "node").repartition(*keys).sortWithinPartitions(*keys),
                     _pairs(keys, most), PAIRS)


def _split(places: DataFrame) -> DataFrame:
    # a large leaf is split by a hash that differs from table to table
    return places.withColumn("salt", F.pmod(F.xxhash64("node", "table"), F.ceil(F.col("_n") / LEAF_MOST)))


def neighbour_lists(nodes: DataFrame, places: list[DataFrame], count: int, most: int = LIST) -> DataFrame:
    """(a, b, cosine, link): approximate best neighbours of each node, by NN-descent, and the links that
    connect what any comparison on the way has found connected."""
    # random neighbours connect the lists
    groups = max(1, count // RANDOM)
    chance = nodes.select("node", F.lit(-1).alias("table"), F.size("unit").cast("long").alias("leaf"),
                          F.pmod(F.xxhash64("node", F.lit(5)), F.lit(groups)).alias("salt"))
    lists = stored(_best(_meet(nodes, chance, most), most), "vector-lists")
    for some in places:
        lists = stored(_best(lists.unionByName(_meet(nodes, _split(some), most)), most), "vector-lists")
    for _ in range(ROUNDS):
        around = lists.select(F.col("a").alias("pivot"), F.col("b").alias("node")) \
            .unionByName(lists.select(F.col("b").alias("pivot"), F.col("a").alias("node"))).distinct()
        # at most twice the list: a pivot's own entries and as many that point at it
        rank = F.row_number().over(Window.partitionBy("pivot").orderBy(F.xxhash64("node", "pivot")))
        around = around.withColumn("_rank", rank).where(F.col("_rank") <= 2 * most).drop("_rank")
        found = map_arrow(around.join(nodes, "node").repartition("pivot").sortWithinPartitions("pivot"),
                          _pairs(["pivot"], most), PAIRS)
        better = stored(_best(lists.unionByName(found), most), "vector-lists")
        changed = better.join(lists, ["a", "b"], "left_anti").count()
        lists = better
        if changed <= STILL * max(1, lists.count()):
            break
    return lists


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares two parts of a leaf: (a, b), one link for each two components that links connect."""
    for group in _groups(batches, ["table", "leaf", "one", "two"]):
        part, two = group.column("part").to_numpy(), group.column("two")[0].as_py()
        one = group.column("one")[0].as_py()
        x, node = _matrix(group.column("unit").combine_chunks()), group.column("node").to_numpy()
        component = group.column("component").to_numpy()
        left, right = np.flatnonzero(part == one), np.flatnonzero(part == two)
        seen: dict[tuple[int, int], tuple[int, int]] = {}
        for lo in range(0, len(left), 512):
            rows = left[lo:lo + 512]
            hit = (x[rows] @ x[right].T >= THRESHOLD) & (component[rows][:, None] != component[right][None, :])
            i, j = np.nonzero(hit)
            pair = np.stack([component[rows][i], component[right][j]])
            _, first = np.unique(pair, axis=1, return_index=True)
            for k in first.tolist():
                seen.setdefault((int(pair[0, k]), int(pair[1, k])), (int(node[rows[i[k]]]), int(node[right[j[k]]])))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in seen.values()], pa.int64()) for k in (0, 1)],
                                             names=["a", "b"])


def crowded_links(nodes: DataFrame, places: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b): links between components inside the leaves that were split, all their nodes compared."""
    rows = places.where(F.col("_n") > LEAF_MOST).join(found, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    several = rows.groupBy("table", "leaf").agg(F.min("component").alias("_x"), F.max("component").alias("_y")) \
        .where("_x != _y").select("table", "leaf")
    parts = F.ceil(F.col("_n") / PART).cast("int")
    rows = rows.join(several, ["table", "leaf"]).withColumn("_parts", parts) \
        .withColumn("part", F.pmod(F.xxhash64("node", F.lit(3)), F.col("_parts")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    rows = rows.select("table", "leaf", F.least("part", "_other").alias("one"), F.greatest("part", "_other").alias("two"),
                       "part", "component", "node")
    keys = ["table", "leaf", "one", "two"]
    return map_arrow(rows.join(nodes.select("node", "unit"), "node").repartition(*keys).sortWithinPartitions(*keys),
                     _across, "a long, b long")


def _missed(asked: list, step: int = 512):
    """Links of the ``asked`` (node, component, unit) rows with all nodes: (a, b, there); ``there`` counts
    a's links, and b is NULL or a node of another component that a links with."""
    ids, own = np.array([r["node"] for r in asked]), np.array([r["component"] for r in asked])
    by_size: dict[int, np.ndarray] = {}
    for k, r in enumerate(asked):
        by_size.setdefault(len(r["unit"]), []).append(k)
    by_size = {d: (np.array(k), np.array([asked[i]["unit"] for i in k])) for d, k in by_size.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("unit").value_lengths().to_numpy()
            for dim in [d for d in np.unique(size).tolist() if d in by_size]:
                part = batch.filter(pa.array(size == dim))
                at, x = by_size[dim]
                node, component = part.column("node").to_numpy(), part.column("component").to_numpy()
                hit = (x @ _matrix(part.column("unit")).T >= THRESHOLD) & (ids[at][:, None] != node[None, :])
                there = hit.sum(axis=1)
                i, j = np.nonzero(hit & (own[at][:, None] != component[None, :]))
                a = np.concatenate([ids[at][there > 0], ids[at][i]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array([None] * int((there > 0).sum()) + node[j].tolist(), pa.int64()),
                     pa.array(np.concatenate([there[there > 0], np.zeros(len(i), np.int64)]))], names=["a", "b", "there"])
    return run


def vector_components(nodes: DataFrame, most: int = LIST) -> DataFrame:
    """(node, component) of the nodes with links.

    Besides the lists, nodes of a leaf that was split are compared across the parts. Then ASKED nodes
    are compared with all others: while more than 1 - RECALL of their links lead to other components,
    nodes meet in as many new tables again, and other nodes are asked.
    """
    count = nodes.count()
    bits, tables = leaf_bits(count)
    steps = lambda first: [_places(nodes, bits, range(t, min(t + STEP, first + tables)))
                           for t in range(first, first + tables, STEP)]
    places = steps(0)
    links = neighbour_lists(nodes, places, count, most).where(F.col("cosine") >= THRESHOLD).select("a", "b")
    done = tables
    while True:
        found = components(links, "vector-components")
        crowded = [crowded_links(nodes, some, found) for some in places]
        for more in crowded:
            links = links.unionByName(stored(more, "vector-crowded"))
        found = stored(components(links, "vector-components"), "vector-found")
        rows = nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "unit")
        # other nodes at each round: the links of those asked before are in by now
        asked = rows.orderBy(F.xxhash64("node", F.lit(11 + done)), "node").limit(ASKED).collect()
        if not asked:
            return found
        seen = stored(map_arrow(rows, _missed(asked), "a long, b long, there long"), "vector-asked")
        there, missed = seen.agg(F.sum("there"), F.count("b")).first()
        if missed:
            links = links.unionByName(seen.where("b is not null").select("a", "b"))
        if missed <= (1 - RECALL) * (there or 0):
            return components(links, "vector-components") if missed else found
        places = steps(done)
        for some in places:
            links = links.unionByName(stored(_meet(nodes, _split(some), 0), "vector-links").select("a", "b"))
        done += tables


def _near_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component, weight, unit, outer): whether a node is beyond half the link angle of the first."""
    half = (math.acos(THRESHOLD) - 1e-6) / 2
    for batch in batches:
        dot = [float(np.dot(x.values.to_numpy(), y.values.to_numpy()))
               for x, y in zip(batch.column("unit"), batch.column("_first"))]
        outer = np.arccos(np.clip(dot, -1, 1)) > half
        yield batch.drop_columns(["_first"]).append_column("outer", pa.array(outer, pa.bool_()))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of outer nodes against parts of their component: (node, links) summed by weight. A link
    between an outer node and a node that is not gives to both."""
    nodes, links = [], []
    for group in _groups(batches, ["component", "block", "part"]):
        probe = group.column("probe").to_numpy(zero_copy_only=False)
        left, right = group.filter(pa.array(probe)), group.filter(pa.array(~probe))
        if not len(left) or not len(right):
            continue
        s = _matrix(left.column("unit").combine_chunks()) @ _matrix(right.column("unit").combine_chunks()).T
        a, b = left.column("node").to_numpy(), right.column("node").to_numpy()
        hit = (s >= THRESHOLD) & (a[:, None] != b[None, :])
        nodes.append(a)
        links.append(hit @ right.column("weight").to_numpy())
        inner = ~right.column("outer").to_numpy(zero_copy_only=False)
        nodes.append(b[inner])
        links.append(left.column("weight").to_numpy() @ hit[:, inner])
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(links))],
                                         names=["node", "links"])


def component_links(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """(node, component, links): other vectors linked with each node of ``found`` in its component."""
    members = found.join(nodes, "node")
    first = members.where("node = component").select("component", F.col("unit").alias("_first"))
    members = stored(map_arrow(members.join(first, "component").select("node", "component", "weight", "unit", "_first"),
                               _near_first, f"node long, component long, {NODE.split(', ', 1)[1]}, outer boolean"),
                     "vector-members")
    sizes = members.groupBy("component").agg(
        F.ceil(F.count(F.when(F.col("outer"), 1)) / BLOCK).cast("int").alias("_blocks"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_parts"),
        F.coalesce(F.sum(F.when(~F.col("outer"), F.col("weight"))), F.lit(0)).alias("_inner"))
    rows = members.join(sizes, "component")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    spot = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    open_rows = rows.where("_blocks > 0")
    columns = ["component", "block", "part", "probe", "node", "weight", "unit", "outer"]
    probes = open_rows.where("outer").withColumn("block", spot("_blocks", 1)).withColumn("part", each("_parts")) \
        .withColumn("probe", F.lit(True)).select(*columns)
    others = open_rows.withColumn("part", spot("_parts", 2)).withColumn("block", each("_blocks")) \
        .withColumn("probe", F.lit(False)).select(*columns)
    keys = ["component", "block", "part"]
    counted = map_arrow(probes.unionByName(others).repartition(*keys).sortWithinPartitions(*keys), _count,
                        "node long, links long").groupBy("node").agg(F.sum("links").alias("_links"))
    inner = F.when(F.col("outer"), F.lit(0)).otherwise(F.col("_inner") - F.col("weight"))
    return rows.join(counted, "node", "left").select(
        "node", "component", (inner + F.coalesce("_links", F.lit(0))).alias("links"))


def near_vectors(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    NULL, empty and zero vectors and those with NULL or non-finite components link with nothing;
    vectors of different lengths do not link; equal vectors always link. NULL ids are linked like
    others (a component of NULL ids alone has a NULL id and is not kept); repeated rows are vectors of
    their own; an empty table gives no rows; other columns are not read.
    """
    rows = stored(vectors.select(F.monotonically_increasing_id().alias("_row"), F.col(ident).cast("long").alias("_id"),
                                 F.col(vector).cast("array<double>").alias("_vector")), "vector-rows")
    units = stored(map_arrow(rows.select("_row", "_vector"), _units, "_row long, unit array<double>"), "vector-units")
    keyed = units.withColumns({"_k1": F.xxhash64("unit"), "_k2": F.xxhash64(F.lit(1), "unit")})
    classes = keyed.groupBy("_k1", "_k2").agg(F.min("_row").alias("node"), F.count(F.lit(1)).alias("weight"))
    member = stored(keyed.select("_row", "_k1", "_k2").join(classes, ["_k1", "_k2"]).select("_row", "node", "weight"),
                    "vector-classes")
    nodes = stored(member.where("_row = node").join(units, "_row").select("node", "weight", "unit"), "vector-nodes")
    linked = component_links(nodes, vector_components(nodes))
    table = stored(rows.select("_row", "_id").join(member, "_row", "left").join(linked, "node", "left").select(
        "_id", F.coalesce("component", "node", -1 - F.col("_row")).alias("_component"),
        F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links")), "vector-table")
    least = table.groupBy("_component").agg(F.min("_id").alias("component_id"))
    return table.join(least, "_component").select(
        F.col("_id").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def audit_recall(vectors: DataFrame, every: int = 50) -> tuple[int, int]:
    """(links found, links there) of the vectors whose id is divisible by ``every``, at most 4096 of
    them, each compared with all vectors. Checks an index; no query calls it."""
    asked = vectors.where(F.col("vec_id") % every == 0).orderBy("vec_id").limit(4096) \
        .select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in asked])
    x = np.array([r["embedding"] for r in asked], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column("embedding")).astype(float)
            y /= np.linalg.norm(y, axis=1, keepdims=True)
            hits = ((x @ y.T >= THRESHOLD) & (ids[:, None] != batch.column("vec_id").to_numpy()[None, :])).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(hits)], names=["vec_id", "hits"])

    there = map_arrow(vectors.select("vec_id", "embedding"), run, "vec_id long, hits long") \
        .groupBy("vec_id").agg(F.sum("hits").alias("hits"))
    got = near_vectors(vectors).join(there, "vec_id").agg(F.sum("n_links"), F.sum("hits")).first()
    return int(got[0] or 0), int(got[1] or 0)


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all embeddings."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
