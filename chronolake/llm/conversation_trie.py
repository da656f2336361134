"""Prefix trie of conversations by burst tries.

1. A turn becomes an id (128 bits of a digest of role and text) and a count of words; texts go no further.
   Conversations are rebuilt and cut into pieces of ``PIECE`` turns. Equal pieces under one head are one
   sequence with a count, so copies of a conversation are folded before anything is compared.
2. All sequences start in one container under the root. A container of more than ``CONTAINER`` different
   sequences bursts: its node becomes part of the trie head, and its sequences move, by their next turn id,
   into containers one turn deeper. Containers are shards of their own; none grows with the table.
3. Each remaining container is sorted by turn ids and swept once into its nodes. The nodes of the head are
   summed up from the containers below them, level by level.
4. Sequences that fill their piece go on under the node they reached, as a trie of its own with that node as
   head. One that goes on alone needs no trie: its turns are a chain of nodes. So a conversation of any
   length is dealt in pieces, and rounds are only as many as the pieces that different conversations share.

The ids of the conversations that end at a node are hashed as a stream in their order: a sorted range is cut
into blocks of ids, and a node's blocks meet in one task that holds one block.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.llm.ranks import numbered
from chronolake.llm.text import text_of, word_count
from chronolake.session import stored

PIECE = 1024  # turns of a piece
CONTAINER = 512  # sequences of a container
BLOCK = 4096  # ids of a block that is hashed
HEADS = 3  # turns that a conversation may take from another one at most

ID = 16  # bytes of a turn id
NOTHING = hashlib.sha256(b"").hexdigest()

_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_SWEPT = f"cont binary, parent binary, head binary, top int, {_NODE}"
_NODE_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]


def _id_of(data: Column) -> Column:
    return F.unhex(F.left(F.sha2(data, 256), F.lit(2 * ID)))


# --- rebuilt conversations ------------------------------------------------------------------------


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (conv, pos, tid, words): turns numbered from 0 within their conversation."""
    role_, text_ = text_of(F.col(f"`{role}`")), text_of(F.col(f"`{text}`"))
    whole = F.concat(F.char_length(role_).cast("string"), F.lit(":"), role_, text_).cast("binary")
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        _id_of(whole).alias("tid"),
        word_count(text_).alias("words"),
        F.monotonically_increasing_id().alias("row"),  # cuts equal rows of a hot conversation apart
    )
    ranked = numbered(rows, "conv", "turn", "tid", "row")
    return stored(ranked.select("conv", (F.col("rank") - 1).alias("pos"), "tid", "words"), "turns")


def _rebuilt(turns: DataFrame, piece: int) -> DataFrame:
    """Pieces (conv, k, key, words, last) of the rebuilt conversations: ``key`` holds the turn ids."""
    head = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEADS + 1)).cast("int")
    lead = turns.where(F.col("pos") < HEADS).groupBy(F.col("conv").alias("b_conv"))
    lead = lead.agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "words"))).alias("lead"))
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumn("h", head)
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % 20)
    taken = F.slice("lead", F.lit(1), F.col("h"))
    none = F.array().cast("array<struct<pos:bigint,tid:binary,words:bigint>>")
    convs = convs.join(lead, F.col("base") == F.col("b_conv"), "left")
    convs = convs.select("conv", "n", "h", F.coalesce(taken, none).alias("taken"))
    convs = convs.withColumn("total", F.size("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    convs = stored(convs, "rebuilt")
    prefixes = convs.select("conv", "total", F.posexplode("taken").alias("at", "t")).select(
        "conv", "total", F.col("at").cast("long").alias("at"), "t.tid", "t.words"
    )
    # A conversation's length and shift meet its turns block by block, however many turns it has.
    blocks = convs.select(
        F.col("conv").alias("i_conv"),
        "total",
        (F.size("taken") - F.col("h")).alias("shift"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / piece))).alias("block"),
    )
    own = turns.where(F.col("pos") >= head)
    own = own.join(blocks, (F.col("conv") == F.col("i_conv")) & (F.floor(F.col("pos") / piece) == F.col("block")))
    own = own.select("conv", "total", (F.col("pos") + F.col("shift")).alias("at"), "tid", "words")
    k = F.floor(F.col("at") / piece)
    pieces = prefixes.unionByName(own).groupBy("conv", k.alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("at", "tid", "words"))).alias("turns"), F.any_value("total").alias("total")
    )
    pieces = pieces.select(
        "conv",
        "k",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["tid"])), "")).alias("key"),
        F.col("turns.words").alias("words"),
        (F.col("k") == F.floor((F.col("total") - 1) / piece)).alias("last"),
    )
    turnless = convs.where("total = 0").select(
        "conv",
        F.lit(0).cast("long").alias("k"),
        F.lit(b"").alias("key"),
        F.array().cast("array<long>").alias("words"),
        F.lit(True).alias("last"),
    )
    return stored(pieces.unionByName(turnless), "pieces")


# --- ids of the conversations that end at a node --------------------------------------------------


def _runs(batches):
    """(nid, conversations) of successive runs of equal nodes in sorted batches; a run may come in several."""
    for batch in batches:
        if not len(batch):
            continue
        nids, convs = batch["nid"].tolist(), batch["conv"].to_numpy()
        cuts = [0, *[i for i in range(1, len(nids)) if nids[i] != nids[i - 1]], len(nids)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            for at in range(start, end, BLOCK):
                yield bytes(nids[start]), convs[at : min(end, at + BLOCK)].tolist()


def _blocks(batches):
    """Digests of nodes whose ids lie within this range and are few; blocks of the ids of all others."""
    out: list[tuple] = []
    node, held, whole = None, [], False  # whole: nothing of the node was sent or lies in an earlier range

    def send(ids):
        return node, ids[0], ",".join(map(str, ids)), None

    def finish(inside):
        if not held:
            return
        if inside and whole:
            out.append((node, held[0], None, hashlib.sha256(",".join(map(str, held)).encode()).hexdigest()))
        else:
            out.append(send(held))

    for nid, ids in _runs(batches):
        if nid != node:
            finish(inside=True)
            whole = node is not None
            node, held = nid, []
        held = held + ids
        if len(held) > BLOCK:
            out.append(send(held[:BLOCK]))
            held, whole = held[BLOCK:], False
        if len(out) >= 1000:
            yield pd.DataFrame(out, columns=["nid", "first", "ids", "sha"])
            out.clear()
    finish(inside=False)
    if out:
        yield pd.DataFrame(out, columns=["nid", "first", "ids", "sha"])


def _hashed(batches):
    node, digest, out = None, None, []
    for batch in batches:
        for nid, ids in zip(batch["nid"], batch["ids"]):
            if nid != node:
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = nid, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) >= 1000:
            yield pd.DataFrame(out, columns=["nid", "sha"])
            out = []
    if node is not None:
        out.append((node, digest.hexdigest()))
    yield pd.DataFrame(out, columns=["nid", "sha"])


def _ends(ended: DataFrame) -> DataFrame:
    """Rows (nid, sha) of the nodes at which conversations (nid, conv) end."""
    ranged = ended.repartitionByRange("nid", "conv").sortWithinPartitions("nid", "conv")
    found = stored(ranged.mapInPandas(_blocks, "nid binary, first long, ids string, sha string"), "ends")
    cut = found.where("sha IS NULL").repartition("nid").sortWithinPartitions("nid", "first")
    return found.where("sha IS NOT NULL").select("nid", "sha").unionByName(
        cut.select("nid", "ids").mapInPandas(_hashed, "nid binary, sha string")
    )


# --- containers -----------------------------------------------------------------------------------


def _sequences(current: DataFrame) -> DataFrame:
    """Different pieces under one head, with the conversations that have them."""
    folded = current.groupBy("nid").agg(
        F.any_value(F.struct("head", "head_lo", "key", "words")).alias("s"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv").alias("lo"),
        F.count_if(~F.col("last")).alias("going"),
        F.min(F.when(~F.col("last"), F.col("conv"))).alias("going_lo"),
    )
    ends = _ends(current.where("last").select("nid", "conv")).withColumnsRenamed({"nid": "e_nid"})
    folded = folded.join(ends, F.col("nid") == F.col("e_nid"), "left")
    return stored(folded.select("nid", "s.*", "n", "lo", "going", "going_lo", "sha"), "sequences")


def _burst(sequences: DataFrame, container: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Containers that don't burst, by depth; nodes of the head, by depth; sequences that end at these."""
    level = sequences.withColumns({"cont": F.col("head"), "parent": F.lit(None).cast("binary"), "j": F.lit(0)})
    settled, heads, stops = [], [], []
    for j in range(PIECE + 1):
        own = F.element_at("words", j) if j else F.lit(0).cast("long")
        large = level.groupBy("cont").agg(
            F.count(F.lit(1)).alias("size"),
            F.any_value(F.struct("parent", "head", "head_lo", own.alias("word"))).alias("of"),
        )
        large = large.where(F.col("size") > container).select(F.col("cont").alias("h_cont"), "of.*")
        large = stored(large, "burst")  # one row for each ``container`` sequences at most
        if large.isEmpty():
            return [*settled, level], heads, stops
        heads.append(large)
        burst = large.select("h_cont")
        settled.append(level.join(burst, F.col("cont") == F.col("h_cont"), "left_anti"))
        inside = level.join(burst, F.col("cont") == F.col("h_cont"), "left_semi")
        stops.append(inside.where(F.length("key") == ID * j))
        deeper = inside.where(F.length("key") > ID * j)
        deeper = deeper.withColumns(
            {
                "parent": F.col("cont"),
                "cont": _id_of(F.concat("head", F.substring("key", 1, ID * (j + 1)))),
                "j": F.lit(j + 1),
            }
        )
        level = stored(deeper, "containers")
    raise AssertionError("containers of whole pieces hold one sequence")


class _Node:
    __slots__ = ("depth", "parent", "word", "n", "lo", "children", "leaves", "saved", "sha")

    def __init__(self, depth, parent, word):
        self.depth, self.parent, self.word = depth, parent, word
        self.n = self.children = self.leaves = self.saved = 0
        self.lo, self.sha = None, None


def _sweep(rows: pd.DataFrame, start: int) -> list[_Node]:
    """The nodes of one container, sorted by key; the first one is the container's own, at depth j."""
    j = int(rows["j"].iloc[0])
    first = rows["words"].iloc[0]
    top = _Node(start + j, None, int(first[j - 1]) if j else 0)
    nodes, stack, before = [top], [top], None

    def close(until):
        while len(stack) > until:
            node = stack.pop()
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.word
            if stack:
                up = stack[-1]
                up.n += node.n
                up.lo = node.lo if up.lo is None else min(up.lo, node.lo)
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved

    columns = ("key", "words", "n", "lo", "sha", "t_children", "t_leaves", "t_saved")
    plain = rows[list(columns)].astype(object)
    plain = plain.where(plain.notna(), None)
    for key, words, n, lo, sha, t_children, t_leaves, t_saved in zip(*[plain[c] for c in columns]):
        length, common = len(key) // ID, j
        if before is not None:
            most = min(length, len(before) // ID)
            while common < most and key[ID * common : ID * common + ID] == before[ID * common : ID * common + ID]:
                common += 1
        close(1 + common - j)
        for d in range(common, length):
            node = _Node(start + d + 1, stack[-1], int(words[d]))
            nodes.append(node)
            stack.append(node)
        end = stack[-1]
        end.n += n
        end.lo = lo if end.lo is None else min(end.lo, lo)
        end.sha = sha
        if t_children is not None:  # what hangs below, from the next pieces
            end.children += int(t_children)
            end.leaves += int(t_leaves)
            end.saved += int(t_saved)
        before = key
    close(0)
    return nodes


def _swept(start: int):
    def run(batches):
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(rows):
                continue
            names = rows["cont"].tolist()
            cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]]]
            done = [rows.iloc[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            rest = rows.iloc[cuts[-1] :]
            yield from _frames(done, start)
        if rest is not None:
            yield from _frames([rest], start)

    return run


def _frames(containers: list[pd.DataFrame], start: int):
    out: list[tuple] = []
    for rows in containers:
        nodes = _sweep(rows, start)
        cont, parent, head, head_lo = (rows[c].iloc[0] for c in ("cont", "parent", "head", "head_lo"))
        top = nodes[0]
        if int(rows["j"].iloc[0]) == 0 and isinstance(head_lo, str):
            top.lo = min(top.lo, int(head_lo))
        for i, x in enumerate(nodes):
            up = x.parent.lo if x.parent else None
            out.append(
                (cont, parent, head, int(i == 0), x.lo, x.depth, up, x.n, x.children, x.leaves, x.saved, x.sha or NOTHING)
            )
        if len(out) > 20_000:
            yield _frame(out)
            out = []
    if out:
        yield _frame(out)


def _frame(out: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(out, columns=["cont", "parent", "head", "top", *_NODE_COLUMNS])
    return frame.astype({"parent_conv_id": "Int64"})


def _trie(sequences: DataFrame, container: int, start: int) -> tuple[DataFrame, DataFrame]:
    """Nodes below the heads of these sequences, and the heads themselves (cont, head and a node's columns)."""
    settled, large, stops = _burst(sequences, container)
    columns = ["cont", "parent", "head", "head_lo", "j", "key", "words", "n", "lo", "sha", "t_children", "t_leaves", "t_saved"]
    rows = functools.reduce(DataFrame.unionByName, [s.select(columns) for s in settled])
    # As text: pandas would read longs with nulls as doubles.
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("head_lo", "t_children", "t_leaves", "t_saved")})
    rows = rows.repartition("cont").sortWithinPartitions("cont", "key")
    swept = stored(rows.mapInPandas(_swept(start), _SWEPT), "swept", "top")
    tops, heads = swept.where("top = 1"), []
    for j in reversed(range(len(large))):
        # Containers that didn't burst, nodes of the head one level deeper, and sequences that end here.
        below = tops.where(F.col("depth") == start + j + 1).select("parent", "conv_id", "n_convs", "n_leaves", "saved_tokens")
        if heads:
            below = below.unionByName(heads[-1].select("parent", "conv_id", "n_convs", "n_leaves", "saved_tokens"))
        zero = F.lit(0).cast("long")
        below = below.select("*", F.lit(1).alias("child"), F.lit(None).cast("string").alias("sha")).unionByName(
            stops[j].select(
                F.col("cont").alias("parent"),
                F.col("lo").alias("conv_id"),
                F.col("n").alias("n_convs"),
                zero.alias("n_leaves"),
                zero.alias("saved_tokens"),
                F.lit(0).alias("child"),
                "sha",
            )
        )
        sums = below.groupBy(F.col("parent").alias("s_cont")).agg(
            F.min("conv_id").alias("lo"),
            F.sum("n_convs").alias("n_convs"),
            F.sum("child").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved"),
            F.max("sha").alias("sha"),
        )
        found = large[j].join(sums, F.col("h_cont") == F.col("s_cont")).select(
            F.col("h_cont").alias("cont"),
            "parent",
            "head",
            F.least("lo", "head_lo").alias("conv_id"),
            F.lit(start + j).cast("long").alias("depth"),
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("saved") + (F.col("n_convs") - 1) * F.col("word")).alias("saved_tokens"),
            F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"),
        )
        heads.append(stored(found, "heads"))
    plain = [c for c in _NODE_COLUMNS if c != "parent_conv_id"]
    upper = tops.select("cont", "parent", "head", *plain)
    for h in heads:
        upper = upper.unionByName(h.select(upper.columns))
    roots = upper.where(F.col("depth") == start)
    below = upper.where(F.col("depth") > start)
    nodes = swept.where("top = 0").select(_NODE_COLUMNS)
    if heads:
        named = functools.reduce(DataFrame.unionByName, heads)
        named = named.select(F.col("cont").alias("p_cont"), F.col("conv_id").alias("parent_conv_id"))
        below = below.join(named, F.col("parent") == F.col("p_cont"))
        nodes = nodes.unionByName(below.select(_NODE_COLUMNS))
    return nodes, roots


def _chains(pieces: DataFrame, alone: DataFrame, piece: int) -> DataFrame:
    """Nodes of conversations that go on alone (conv, from piece, conv_id of the node before)."""
    rows = pieces.join(alone, (F.col("conv") == F.col("a_conv")) & (F.col("k") >= F.col("since")))
    rows = rows.select("conv", "k", "last", "since", "before", F.size("words").alias("n"), F.posexplode("words").alias("i", "w"))
    ended = F.col("last") & (F.col("i") == F.col("n") - 1)
    opening = (F.col("k") == F.col("since")) & (F.col("i") == 0)
    one = F.lit(1).cast("long")
    return rows.select(
        F.col("conv").alias("conv_id"),
        (F.col("k") * piece + F.col("i") + 1).alias("depth"),
        F.when(opening, F.col("before")).otherwise(F.col("conv")).alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(ended, 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(ended, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(NOTHING).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    container: int = CONTAINER,
    piece: int = PIECE,
) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations.

    A conversation c starts with the first h turns of conversation c - c % 20 (all if it has fewer, none if it
    doesn't exist), h being crc32 of c as decimal text modulo 4, and goes on with its own turns after its first
    h. A node is a sequence of the first d turns, told apart by role and text; its members start with it.
    Returns for each node, as long: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (nodes without children in its subtree),
    ``saved_tokens`` (over its subtree, (members - 1) times the words of the node's last text), and
    ``ends_sha256``, of the ids of the conversations that end here, ascending and comma-joined.

    Turns are ordered by ``turn``, null first; equal ones by a digest of role and text, so that the result is
    the same in any layout. Null roles and texts are empty. Repeated rows are turns of their own. Rows without
    a conversation id belong to no conversation and are left out. Conversations rebuilt without turns are
    members of the root. An empty table has no nodes. Other columns are ignored whatever their names.
    """
    turns = _turns(conversations, conv, turn, role, text)
    pieces = _rebuilt(turns, piece)
    current = pieces.where("k = 0").withColumns({"head": F.lit(b""), "head_lo": F.lit(None).cast("long")})
    rounds, chains = [], []
    while True:
        columns = ["conv", "head", "head_lo", "key", "words", "last", _id_of(F.concat("head", "key")).alias("nid")]
        current = stored(current.select(columns), "round")
        sequences = _sequences(current)
        rounds.append(sequences)
        k = F.lit(len(rounds)).cast("long")
        alone = sequences.where("going = 1")
        chains.append(_chains(pieces, alone.select(F.col("going_lo").alias("a_conv"), k.alias("since"), F.col("lo").alias("before")), piece))
        shared = sequences.where("going > 1").select(F.col("nid").alias("s_nid"), F.col("lo").alias("s_lo"))
        if shared.isEmpty():
            break
        going = current.where("NOT last").join(shared, F.col("nid") == F.col("s_nid"))
        going = going.select(F.col("conv").alias("g_conv"), F.col("nid").alias("head"), F.col("s_lo").alias("head_lo"))
        current = pieces.where(F.col("k") == k).join(going, F.col("conv") == F.col("g_conv"))

    nodes, tails = [], None
    for at in reversed(range(len(rounds))):
        tail = [F.when(F.col("going") == 1, v).cast("long") for v in (1, 1, 0)]
        names = ["t_children", "t_leaves", "t_saved"]
        if tails is None:
            sequences = rounds[at].select("*", *[c.alias(n) for c, n in zip(tail, names)])
        else:
            joined = rounds[at].join(tails, F.col("nid") == F.col("r_head"), "left")
            values = [F.coalesce(F.col(f"r_{n}"), c).alias(n) for c, n in zip(tail, names)]
            sequences = joined.select(*rounds[at].columns, *values)
        found, roots = _trie(sequences, container, at * piece)
        nodes.append(found)
        tails = roots.select(
            F.col("head").alias("r_head"),
            F.col("n_children").alias("r_t_children"),
            F.col("n_leaves").alias("r_t_leaves"),
            F.col("saved_tokens").alias("r_t_saved"),
        )
    root = roots.withColumn("parent_conv_id", F.lit(None).cast("long")).select(_NODE_COLUMNS)
    return functools.reduce(DataFrame.unionByName, [root, *nodes, *[c.select(_NODE_COLUMNS) for c in chains]])
