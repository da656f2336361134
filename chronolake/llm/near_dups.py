"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles; two are linked from a Jaccard similarity of 0.8.

1. Every set gets a sketch of minhash tokens; documents of equal sets become one node with a count.
2. Chosen paths: each of RUNS runs splits the nodes on one sampled token of their sketches. A bucket of at
   most LEAF nodes is compared by brute force (on sketches). In a larger one, nodes close to one of its
   hubs leave it, tied to the hub, and the others are split again on two more sampled tokens. Before the runs, nodes
   very close to the hub of a large bucket follow it: they leave all runs, and it stands for them. A linked pair shares a
   token with a probability of 0.8 or more, so one split misses it with 0.2 ** RUNS (4e-9), and DEPTH
   splits with less than 0.28 ** RUNS (3e-7): of two tokens, both fail with (0.24 + 0.76 * m) ** 2 = m at
   most, as tokens that were split on don't come again. Sketches that agree in less than CANDIDATE although the pair is linked come on top (README).
3. The candidate edges are a spanning forest of each bucket, linear in its size; their components hold every
   link. Within each component all pairs are then compared exactly, on whole shingle sets and in blocks:
   tasks give sums and spanning edges of the links, never the pairs.

A near-copy group of a third of all rows is dealt to many tasks by blocks; its exact link counts take work
that grows with the square of its number of different texts, its classes don't.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.llm.components import components
from chronolake.llm.text import packed
from chronolake.llm.words import mix, shingles
from chronolake.session import stored

SHINGLE = 5
TOKENS = 64  # of a sketch
RUNS = 12
LEAF = 512  # nodes of a bucket that is compared by brute force
BLOCK = 128  # nodes of a block; a task compares two
DEPTH = 8  # splits before a bucket is dealt in blocks of pairs
# Similarities estimated from sketches (deviation 0.05 at 0.8). A node is done in a bucket if it is so close
# to the hub (CLOSE) that all its links are in reach of the hub, too (FAR: CLOSE less 0.2 and errors).
CANDIDATE, CLOSE, FAR = 0.6, 0.75, 0.35
# A node this close to the hub of a large first bucket takes part in no run: the hub leads it and stands for it
# in all of them. Its links are at 0.6 or more to the leader, which they miss in all runs with 0.4 ** RUNS.
FOLLOW = 0.8
HUBS = 4  # of a large bucket
SALTS = 32  # copies of a hub's sketch

_MULTIPLY = np.random.default_rng(5).integers(1, 2**31, TOKENS, dtype=np.uint32) * 2 + 1
_ADD = np.random.default_rng(6).integers(0, 2**32, TOKENS, dtype=np.uint32)


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        s1, s2, n, mins = [], [], [], []
        for text in batch["text"]:
            own = shingles(text, SHINGLE)
            a, b = _signature(own)
            s1.append(a)
            s2.append(b)
            n.append(len(own))
            mins.append(_tokens(own))
        yield pd.DataFrame({"row": batch["row"], "key": batch["key"], "s1": s1, "s2": s2, "n": n, "mins": mins})


def _signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    whole = mix(own)
    return (
        int(np.add.reduce(whole, dtype=np.uint64).astype(np.int64)),
        int(np.bitwise_xor.reduce(mix(whole + np.uint64(len(own)))).astype(np.int64)) if len(own) else 0,
    )


def _tokens(own: np.ndarray) -> np.ndarray:
    least = np.full(TOKENS, 2**32 - 1, dtype=np.uint32)
    short = (own >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 4096):
        least = np.minimum(least, (short[i : i + 4096, None] * _MULTIPLY + _ADD).min(0))
    return least.view(np.int32)


def _node(s1: Column, s2: Column) -> Column:
    return F.xxhash64(s1, s2)


# --- candidate edges ------------------------------------------------------------------------------


def _groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a sorted stream; only one group and one batch are held."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(rows):
            continue
        keys = rows[by].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist()]
        for start, end in zip(cuts[:-1], cuts[1:]):
            yield rows.iloc[start:end]
        rest = rows.iloc[cuts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Spanning edges (first, other) of a symmetric link matrix: a star for each component."""
    open_, edges = np.ones(len(linked), dtype=bool), []
    for start in range(len(linked)):
        if not open_[start]:
            continue
        open_[start] = False
        front = [start]
        while front:
            row = linked[front.pop()] & open_
            found = np.flatnonzero(row)
            open_[found] = False
            front += found.tolist()
            edges += [(start, int(x)) for x in found]
    return edges


def _leaf_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a, b = [], []
    for group in _groups(batches, ["path", "i", "j"]):
        if len(group) < 2:
            continue
        sketch, nodes = np.stack(group["mins"].to_numpy()), group["node"].to_numpy()
        like = np.zeros((len(nodes), len(nodes)), dtype=np.uint8)
        for t in range(sketch.shape[1]):
            like += sketch[:, t, None] == sketch[None, :, t]
        leads = group["leads"].to_numpy(dtype=bool)
        least = np.where(leads[:, None] | leads[None, :], FAR, CANDIDATE) * sketch.shape[1]
        for x, y in _forest(like >= least):
            a.append(nodes[x])
            b.append(nodes[y])
        if len(a) > 50_000:
            yield pd.DataFrame({"a": a, "b": b}, dtype="int64")
            a, b = [], []
    yield pd.DataFrame({"a": a, "b": b}, dtype="int64")


def _dealt(rows: DataFrame, size: Column, node: Column, most: int) -> DataFrame:
    """Add (i, j): groups of more than ``most`` rows are cut into blocks, and every two blocks meet."""
    blocks = F.when(size > most, F.ceil(size / BLOCK)).otherwise(1).cast("int")
    own = F.pmod(F.xxhash64(node, F.lit(7)), blocks).cast("int")
    rows = rows.withColumns({"_own": own, "_other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    rows = rows.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other")})
    return rows.withColumn("block", F.col("_own")).drop("_own", "_other")


def _children(path: Column, used: Column, mins: Column) -> Column:
    """(path, used) of two different sampled tokens: with fewer, pairs would be lost with the depth of the splits.

    Tokens that all nodes of the path have in common, as it is ``used`` up to here, split nothing and are left out.
    """
    free = F.array_except(F.sequence(F.lit(1), F.lit(TOKENS)), used)
    first = F.pmod(F.xxhash64(path, F.lit(1)), F.size(free).cast("long")).cast("int")
    step = F.pmod(F.xxhash64(path, F.lit(2)), F.size(free).cast("long") - 1).cast("int")
    second = F.pmod(first + 1 + step, F.size(free))
    tokens = F.array(F.element_at(free, first + 1), F.element_at(free, second + 1))
    return F.transform(
        tokens,
        lambda t: F.struct(F.xxhash64(path, t, F.element_at(mins, t)).alias("path"), F.array_append(used, t).alias("used")),
    )


def _buckets(level: DataFrame, label: str) -> DataFrame:
    """Buckets of two nodes or more: size, checksum of the nodes, and their hubs.

    Each hub is the node of the least of some hash, leaders first, so that buckets of like nodes tend to have
    the same hubs.
    """
    hubs = [
        F.min(F.struct(~F.col("leads"), F.xxhash64("node", F.lit(i)).alias("order"), "node"))["node"] for i in range(HUBS)
    ]
    sizes = level.groupBy(F.col("path").alias("p")).agg(
        F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("mark"),
        F.array_distinct(F.array(*hubs)).alias("hubs"),
    )
    return stored(sizes.where("size > 1"), label)


def _beside_hubs(level: DataFrame, buckets: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (node, path, hubs) of large buckets; their nodes with sketches; pairs (node, hub) with their likeness.

    A node meets each hub once, however many buckets have it. A hub may meet most nodes: its sketch is copied
    SALTS times, and its nodes are dealt to the copies.
    """
    large = buckets.where(F.col("size") > LEAF).select("p", "hubs")
    inside = level.join(large.hint("merge"), F.col("path") == F.col("p")).select("node", "path", "used", "hubs", "leads")
    inside = stored(inside, "large-rows")
    # At most RUNS * 2 ** depth buckets hold a node.
    beside = inside.groupBy("node").agg(
        F.any_value("leads").alias("leads"), F.array_distinct(F.flatten(F.collect_set("hubs"))).alias("hubs")
    )
    beside = beside.join(own.hint("merge"), F.col("node") == F.col("s_node")).select("node", "leads", "hubs", "mins")
    beside = stored(beside, "large-nodes")
    pairs = beside.select("node", "mins", _salt().alias("salt"), F.explode("hubs").alias("hub"))
    hubs = large.select(F.explode("hubs").alias("h")).distinct()
    hubs = hubs.join(own.withColumnsRenamed({"s_node": "h_node", "mins": "hm"}).hint("merge"), F.col("h") == F.col("h_node"))
    hubs = hubs.select("h", "hm", _salts().alias("h_salt"))
    equal = F.aggregate(
        F.zip_with("mins", "hm", lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x
    )
    met = pairs.join(hubs.hint("merge"), (F.col("hub") == F.col("h")) & (F.col("salt") == F.col("h_salt")))
    met = met.select("node", "hub", "salt", (equal / TOKENS).alias("like")).where(F.col("like") >= FAR)
    return inside, beside, stored(met, "hub-likeness")


def _salt() -> Column:
    return F.pmod(F.xxhash64("node", F.lit(3)), F.lit(SALTS).cast("long"))


def _salts() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))


def _tied(met: DataFrame) -> DataFrame:
    """Edges to hubs: from CANDIDATE, or from FAR if a close node may have left with the hub, links and all."""
    others = met.where(F.col("node") != F.col("hub"))
    strong = others.where(F.col("like") >= CANDIDATE).select("hub", "node")
    left_with = others.where(F.col("like") >= CLOSE).select(F.col("hub").alias("h")).distinct()
    left_with = left_with.select("h", _salts().alias("h_salt"))
    weak = others.where(F.col("like") < CANDIDATE)
    weak = weak.join(left_with.hint("merge"), (F.col("hub") == F.col("h")) & (F.col("salt") == F.col("h_salt")))
    return strong.unionByName(weak.select("hub", "node"))


def _first_paths(sketches: DataFrame, runs: range) -> DataFrame:
    tokens = {run: run * (TOKENS // RUNS) + 1 for run in runs}
    first = [
        F.struct(F.xxhash64(F.lit(run), F.element_at("mins", t)).alias("path"), F.array(F.lit(t)).alias("used"))
        for run, t in tokens.items()
    ]
    return sketches.select("node", "leads", F.inline(F.array(*first)))


def _candidate_edges(nodes: DataFrame) -> DataFrame:
    """Edges whose components hold every link, from chosen paths over the nodes (node, mins)."""
    own = nodes.select(F.col("node").alias("s_node"), "mins")
    sketches = nodes.select("node", "mins", F.lit(False).alias("leads"))
    edges, levels, leaves = [], [], []
    # Large groups of near copies leave before the runs, by the buckets of one of them.
    level = _first_paths(sketches, range(1))
    buckets = _buckets(level, "first-buckets")
    if not buckets.where(F.col("size") > LEAF).isEmpty():
        _, _, met = _beside_hubs(level, buckets, own)
        edges.append(_tied(met))
        follows = met.where((F.col("like") >= FOLLOW) & (F.col("node") != F.col("hub")))
        leaders = follows.select(F.col("hub").alias("f_node"), F.lit(True).alias("f_leads"))
        follows = leaders.distinct().unionByName(follows.select(F.col("node").alias("f_node"), F.lit(False).alias("f_leads")))
        follows = follows.groupBy("f_node").agg(F.max("f_leads").alias("f_leads"))
        sketches = sketches.join(follows.hint("merge"), F.col("node") == F.col("f_node"), "left")
        sketches = sketches.where(F.coalesce("f_leads", F.lit(True)))
        sketches = stored(sketches.select("node", "mins", F.coalesce("f_leads", F.lit(False)).alias("leads")), "remaining")
    level = _first_paths(sketches, range(RUNS))
    for depth in range(DEPTH + 1):
        buckets = _buckets(level, "bucket-sizes")
        levels.append(level)
        leaves.append(buckets if depth == DEPTH else buckets.where(F.col("size") <= LEAF))
        if depth == DEPTH or buckets.where(F.col("size") > LEAF).isEmpty():
            break
        inside, beside, met = _beside_hubs(level, buckets, own)
        edges.append(_tied(met))
        close = met.where(F.col("like") >= CLOSE).groupBy(F.col("node").alias("c_node"))
        close = close.agg(F.collect_set("hub").alias("close"))
        beside = beside.join(close.hint("merge"), F.col("node") == F.col("c_node"), "left")
        beside = beside.select(F.col("node").alias("t_node"), "mins", F.coalesce("close", F.array().cast("array<long>")).alias("close"))
        level = inside.join(beside.hint("merge"), F.col("node") == F.col("t_node"))
        leads_on = F.col("leads") & ~F.array_contains("hubs", F.col("node"))
        level = level.where(leads_on | ~F.arrays_overlap("hubs", "close"))
        level = level.select("node", "leads", F.inline(_children(F.col("path"), F.col("used"), F.col("mins"))))
        level = stored(level, "paths")
    # Leaves of the same nodes (equal count and checksum) are compared once, whatever their run and depth.
    once = functools.reduce(DataFrame.unionByName, leaves).groupBy("size", "mark").agg(F.min("p").alias("p"))
    rows = functools.reduce(DataFrame.unionByName, levels).join(once.hint("merge"), F.col("path") == F.col("p"))
    rows = rows.join(own.hint("merge"), F.col("node") == F.col("s_node")).select("node", "leads", "path", "size", "mins")
    rows = _dealt(rows, F.col("size"), F.col("node"), LEAF).select("path", "i", "j", "node", "leads", "mins")
    rows = rows.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")
    compared = rows.mapInPandas(_leaf_edges, "a long, b long")
    tied = [e.select(F.col("hub").alias("a"), F.col("node").alias("b")) for e in edges]
    return functools.reduce(DataFrame.unionByName, tied, compared)


# --- exact comparison within components -----------------------------------------------------------


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        own = [shingles(t, SHINGLE).tobytes() for t in batch["text"]]
        yield batch.drop(columns="text").assign(shingles=own)


def _shared(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections of up to two blocks of sets, in slices of the shingles that two share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    index = np.cumsum(fresh) - 1
    common = np.bincount(index) > 1
    keep = common[index]
    index, owner = (np.cumsum(common) - 1)[index[keep]], owner[keep]
    total = np.zeros((len(sets), len(sets)))
    n = int(common.sum())
    for start in range(0, n, columns):
        low, high = np.searchsorted(index, [start, start + columns])
        part = np.zeros((len(sets), min(columns, n - start)), dtype=np.float32)
        part[owner[low:high], index[low:high] - start] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for group in _groups(batches, ["root", "i", "j"]):
        nodes, block = group["node"].to_numpy(), group["block"].to_numpy()
        copies = group["copies"].to_numpy()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
        n = np.array([len(s) for s in sets])
        both = _shared(sets)
        linked = 5 * both >= 4 * (n[:, None] + n[None, :] - both)
        np.fill_diagonal(linked, False)
        if group["i"].iloc[0] != group["j"].iloc[0]:  # pairs within a block are counted where it meets itself
            linked &= block[:, None] != block[None, :]
        count = linked @ copies
        edges = _forest(linked)
        yield pd.DataFrame(
            {
                "a": np.concatenate([nodes, nodes[[x for x, _ in edges]]]),
                "b": pd.array([*[None] * len(nodes), *nodes[[y for _, y in edges]].tolist()], dtype="Int64"),
                "links": np.concatenate([count, np.zeros(len(edges), dtype=np.int64)]),
            }
        )


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Classes of near duplicates: connected components of the links of similarity 0.8 or more.

    Returns one row for each row of ``docs``: ``key``, ``class_id`` (the smallest id of the class),
    ``n_links`` (other documents at similarity 0.8 or more, copies included), ``n_copies`` (documents of
    the same shingle set, itself included) and ``n_shingles``, all long.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text of one to four words is one
    shingle. Null and empty texts, and texts of white space, have no shingles: each is a class of its own
    without links. Rows without an id take part; a class of such rows only has no id. Repeated rows count
    as copies. An empty table gives an empty result, other columns are ignored whatever their names.
    """
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    found = _classes(_numbered(texts, "texts"))
    return found.select(F.col("key").alias(key), "class_id", "n_links", "n_copies", "n_shingles")


def _numbered(rows: DataFrame, label: str) -> DataFrame:
    """Add ``row``, a stored number: ids may be null or repeated, and name no row."""
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), label)


def _place() -> Column:
    """Order of rows: by id, null ids last, then by row."""
    return F.struct(F.col("key").isNull().alias("none"), "key", "row")


def _classes(texts: DataFrame) -> DataFrame:
    """near_duplicates() for stored rows (row, key, text), with ``row`` and the row that stays of its class."""
    kind = texts.schema["key"].dataType.simpleString()
    sketched = texts.select("row", "key", "text")
    sketched = sketched.mapInPandas(_sketched, f"row long, key {kind}, s1 long, s2 long, n long, mins array<int>")
    sketched = stored(sketched.withColumn("node", _node(F.col("s1"), F.col("s2"))), "sketches")
    nodes = sketched.where("n > 0").groupBy("s1", "s2", "node").agg(
        F.min("row").alias("first_row"),
        F.min(_place()).alias("lead"),
        F.count(F.lit(1)).alias("copies"),
        F.any_value("mins").alias("mins"),
    )
    nodes = stored(nodes, "nodes")
    candidate = stored(components(_candidate_edges(nodes)).withColumnsRenamed({"node": "c_node"}), "components")
    sizes = stored(candidate.groupBy(F.col("root").alias("s_root")).agg(F.count(F.lit(1)).alias("size")), "comp-sizes")
    placed = candidate.join(sizes.hint("merge"), F.col("root") == F.col("s_root")).drop("s_root")
    inside = nodes.drop("mins").join(placed.hint("merge"), F.col("node") == F.col("c_node"))
    inside = inside.select("node", "first_row", "copies", "root", "size")
    # One text for each node.
    whole = texts.select("row", "text").join(inside.hint("merge"), F.col("row") == F.col("first_row"))
    whole = whole.select("text", "node", "copies", "root", "size")
    whole = whole.mapInPandas(_sets, "node long, copies long, root long, size long, shingles binary")
    dealt = _dealt(whole, F.col("size"), F.col("node"), 2 * BLOCK)
    dealt = dealt.select("root", "i", "j", "block", "node", "copies", "shingles")
    dealt = dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "node")
    compared = stored(dealt.mapInPandas(_links, "a long, b long, links long"), "links")
    links = compared.where("b IS NULL").groupBy(F.col("a").alias("l_node")).agg(F.sum("links").alias("links"))
    roots = components(compared.where("b IS NOT NULL").select("a", "b"))
    roots = roots.withColumnsRenamed({"node": "r_node", "root": "r_root"})
    known = nodes.select("s1", "s2", "node", "lead", "copies")
    known = known.join(links, F.col("node") == F.col("l_node"), "left")
    known = known.join(roots, F.col("node") == F.col("r_node"), "left")
    known = known.withColumn("root", F.coalesce("r_root", "node"))
    known = stored(known.select("s1", "s2", "lead", "copies", "links", "root"), "known")
    names = stored(known.groupBy(F.col("root").alias("n_root")).agg(F.min("lead").alias("lead")), "names")
    known = known.drop("lead").join(names, F.col("root") == F.col("n_root"))
    known = known.select(
        F.col("s1").alias("k1"),
        F.col("s2").alias("k2"),
        F.col("lead.key").alias("class_id"),
        F.col("lead.row").alias("first_row"),
        "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    known = stored(known, "known")
    found = sketched.drop("mins").join(known.hint("merge"), (F.col("s1") == F.col("k1")) & (F.col("s2") == F.col("k2")) & (F.col("n") > 0), "left")
    return found.select(
        "row",
        "key",
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.col("n").alias("n_shingles"),
        F.coalesce("first_row", "row").alias("first_row"),
    )


def without_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Of each class of near duplicates, the row with the smallest id, with all its columns.

    Each row is judged itself: of rows of a class that share the smallest id, the first one stays, and of a
    class without ids, too. Rows without shingles stay.
    """
    rows = _numbered(docs.select(packed(docs).alias("whole")), "near-rows")
    texts = rows.select("row", F.col(f"whole.`{key}`").alias("key"), F.col(f"whole.`{text}`").cast("string").alias("text"))
    found = _classes(texts)
    # At most one row of a class stays; classes are told apart by their first row.
    keep = found.where("row = first_row").select(F.col("row").alias("k_row"))
    return rows.join(keep.hint("merge"), F.col("row") == F.col("k_row"), "left_semi").select("whole.*")
