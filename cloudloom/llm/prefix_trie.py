"""Conversation prefix trie: rebuilt conversations as products of turn fingerprints.

A rebuilt conversation is the head of its base conversation followed by its own
later turns. It is never put together: a sequence of turns has a fingerprint
(length, sum of turn values times powers of a base, modulo a prime), and
fingerprints compose like the sequences do,

    (m, F) * (n, G) = (m + n, F + B^m G).

So the fingerprint of any prefix of a rebuilt conversation follows from prefix
products of the stored conversations: head of the base, times the part of the
own products after the cut. The same composition cuts conversations of any
length into blocks: products inside blocks, products over blocks.

Nodes of the trie are groups of equal (depth, fingerprint). No group is
believed unseen: its members must have the same parent and the same last turn
hash, and where they name different stored turns, those turns' texts are
fetched by reference and compared. If a group fails, all is done again with
other turn hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import dense_ids
from .common import settled

#: Each of four lanes works modulo this prime, so that products fit a long; the bases are fixed values.
PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_566_083_941, 806_544_629, 2_038_074_743)
#: Conversations whose number lies in one range of so many share a base, the least of them; at most HEAD_MOST - 1 of its turns are the head.
GROUP, HEAD_MOST = 20, 4
#: Turns of a block of a conversation's running products.
BLOCK = 4096
#: Times that the hashes of turns are drawn anew before it counts as an error.
ATTEMPTS = 5
WORD = r"[^\x20\x09-\x0D]+"

_KEY = ["depth", "f1", "f2"]
_LANES = [f"l{k}" for k in range(len(BASES))]


def _power(base: int, exponent: Column) -> Column:
    """``base`` to the power of a column from 0 to 2^31 - 1, modulo PRIME."""
    found, square = F.lit(1).cast("long"), base
    for bit in range(31):
        found = found * F.when(F.shiftright(exponent, bit).bitwiseAND(1) == 1, F.lit(square)).otherwise(F.lit(1)) % PRIME
        square = square * square % PRIME
    return found


def _hashes(role: Column, text: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + k), role, text).alias(f"k{k + 1}") for k in (0, 1)]


def stored_turns(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """(conv_id, turn, role, text, k1, k2): turns with their hashes; null role or text is empty, rows without conv_id are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    kept = conversations.where(F.col("conv_id").isNotNull())
    return kept.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), *_hashes(role, text, seed))


def running(df: DataFrame, group: str, at: str, values: list[str], backwards: bool = False, block: int = BLOCK) -> DataFrame:
    """``df`` with each of ``values`` replaced by its sum from the first row of the group (the last, if ``backwards``) up to this one.

    ``at`` numbers the rows of a group. Groups of any size are cut into blocks;
    only the small table of block sums is ordered as a whole.
    """
    order = (lambda c: F.col(c).desc()) if backwards else (lambda c: F.col(c).asc())
    cut = df.withColumn("__block", F.floor(F.col(at) / block).cast("long"))
    sums = cut.groupBy(group, "__block").agg(*(F.sum(v).alias(f"__{v}") for v in values))
    before = Window.partitionBy(group).orderBy(order("__block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(group, "__block", *(F.coalesce(F.sum(f"__{v}").over(before), F.lit(0)).alias(f"__{v}") for v in values))
    inside = Window.partitionBy(group, "__block").orderBy(order(at)).rowsBetween(Window.unboundedPreceding, 0)
    joined = cut.join(offsets, [group, "__block"])
    return joined.withColumns({v: F.sum(v).over(inside) + F.col(f"__{v}") for v in values}).drop("__block", *(f"__{v}" for v in values))


def _products(turns: DataFrame) -> DataFrame:
    """Turns in order with the product of their conversation before (b0..b3) and up to them (l0..l3)."""
    light = turns.select("conv_id", "turn", "k1", "k2", F.expr(f"cast(regexp_count(text, r'{WORD}') as long)").alias("words"))
    placed = dense_ids(light, ["turn", "k1", "k2"], "at", partition_by=["conv_id"])
    values = [F.shiftright(k, s).bitwiseAND(PRIME) for k in ("k1", "k2") for s in (0, 31)]
    terms = placed.withColumns({f"t{k}": v * _power(b, F.col("at")) % PRIME for k, (v, b) in enumerate(zip(values, BASES))})
    whole = running(terms.withColumns({n: F.col(f"t{k}") for k, n in enumerate(_LANES)}), "conv_id", "at", _LANES)
    before = {f"b{k}": F.pmod(F.col(n) - F.col(f"t{k}"), F.lit(PRIME)) for k, n in enumerate(_LANES)}
    return whole.withColumns({**before, **{n: F.pmod(n, F.lit(PRIME)) for n in _LANES}}).drop(*(f"t{k}" for k in range(len(BASES))))


def _packed(lanes: list[Column], names: tuple[str, str]) -> list[Column]:
    return [(F.shiftleft(a, 31) + b).alias(n) for a, b, n in ((*lanes[:2], names[0]), (*lanes[2:], names[1]))]


def _members(products: DataFrame) -> DataFrame:
    """One row for each rebuilt conversation and depth: node and parent fingerprints, the stored turn that is its last, and whether it ends there."""
    stored = F.struct("at", *_LANES, "turn", "k1", "k2", "words")
    heads = products.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("at") < HEAD_MOST - 1, stored))).alias("first"))
    heads = settled(heads)
    bases = heads.select(F.col("conv_id").alias("base"), F.col("first").alias("head"))
    rules = heads.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(bases, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_MOST).cast("int")
    rules = rules.withColumn("h", h).withColumn("head", F.expr("coalesce(slice(head, 1, h), slice(first, 1, 0))"))
    rules = rules.withColumns({"hl": F.size("head"), "cut": F.get("first", F.least("h", F.size("first")) - 1)})
    rules = rules.withColumn("length", F.col("hl") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))

    none = [F.lit(0).cast("long")] * len(BASES)

    def at_head(depth: Column) -> list[Column]:
        turn = F.get("head", depth - 1)
        return [F.coalesce(turn[n], z) for n, z in zip(_LANES, none)]

    one = F.get("head", F.col("d") - 1)
    in_head = rules.withColumn("d", F.explode(F.sequence(F.lit(0), "hl"))).select(
        "conv_id", F.col("d").cast("long").alias("depth"), *_packed(at_head(F.col("d")), ("f1", "f2")), *_packed(at_head(F.col("d") - 1), ("p1", "p2")),
        F.when(F.col("d") > 0, F.col("base")).alias("ref_conv"), one["at"].alias("ref_at"), one["turn"].alias("ref_turn"), one["k1"].alias("k1"), one["k2"].alias("k2"),
        F.coalesce(one["words"], F.lit(0)).alias("words"), (F.col("d") == F.col("length")).alias("ends"),
    )

    last = F.get("head", F.col("hl") - 1)
    own = rules.select("conv_id", "h", "hl", "length", *(F.coalesce(last[n], z).alias(f"h{k}") for k, (n, z) in enumerate(zip(_LANES, none))),
                       *(F.coalesce(F.col("cut")[n], z).alias(f"c{k}") for k, (n, z) in enumerate(zip(_LANES, none))))
    met = products.join(own, "conv_id").where("at >= h")

    def moved(names: list[str]) -> list[Column]:
        """Head times own part: the own part is moved from place h to the end of the head."""
        out = []
        for k, (name, base) in enumerate(zip(names, BASES)):
            back = pow(base, -1, PRIME)
            shift = F.lit(1)
            for by in range(1, HEAD_MOST):
                shift = F.when(F.col("h") - F.col("hl") == by, F.lit(pow(back, by, PRIME))).otherwise(shift)
            out.append((F.col(f"h{k}") + F.pmod(F.col(name) - F.col(f"c{k}"), F.lit(PRIME)) * shift) % PRIME)
        return out

    depth = (F.col("hl") + F.col("at") - F.col("h") + 1).cast("long")
    after = met.select(
        "conv_id", depth.alias("depth"), *_packed(moved(_LANES), ("f1", "f2")), *_packed(moved([f"b{k}" for k in range(len(BASES))]), ("p1", "p2")),
        F.col("conv_id").alias("ref_conv"), F.col("at").alias("ref_at"), F.col("turn").alias("ref_turn"), "k1", "k2", "words", (depth == F.col("length")).alias("ends"),
    )
    return in_head.unionByName(after)


def _is_whole(members: DataFrame, nodes: DataFrame, turns: DataFrame) -> bool:
    """Whether every group is one sequence of turns: same parent, same last hash, and equal texts of all stored turns that it names."""
    if nodes.where("lo_parent <> hi_parent or lo_hash <> hi_hash").limit(1).count():
        return False
    several = nodes.where("lo_ref <> hi_ref").select(*_KEY)
    refs = members.join(several, _KEY, "left_semi").select(*_KEY, "ref_conv", "ref_turn", "k1", "k2").distinct()
    texts = turns.select(F.col("conv_id").alias("ref_conv"), F.col("turn").alias("t"), "k1", "k2", F.struct("role", "text").alias("said"))
    met = refs.join(texts, ["ref_conv", "k1", "k2"]).where(F.col("t").eqNullSafe(F.col("ref_turn")))
    return not met.groupBy(*_KEY).agg(F.min("said").alias("lo"), F.max("said").alias("hi")).where("lo <> hi").limit(1).count()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal nodes, in order, as comma-joined numbers of conversations."""
    for batch in batches:
        key = np.stack([batch.column(n).to_numpy() for n in _KEY])
        ids = batch.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]) if len(ids) else np.zeros(0, int)
        texts = [",".join(map(str, run.tolist())) for run in np.split(ids, starts[1:])] if len(ids) else []
        columns = {n: pa.array(key[k][starts], pa.int64()) for k, n in enumerate(_KEY)}
        yield pa.RecordBatch.from_pydict({**columns, "first": pa.array(ids[starts], pa.int64()), "piece": pa.array(texts, pa.string())})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come one after the other; only the state of the hash is held."""
    now, state = None, None

    def row(key: tuple, digest: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({**{n: pa.array([v], pa.int64()) for n, v in zip(_KEY, key)}, "ends_sha256": [digest]})

    for batch in batches:
        done: dict[str, list] = {n: [] for n in (*_KEY, "ends_sha256")}
        for *key, piece in zip(*(batch.column(n).to_pylist() for n in (*_KEY, "piece"))):
            if key != now:
                if now is not None:
                    for n, v in zip(done, (*now, state.hexdigest())):
                        done[n].append(v)
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        kinds = [pa.int64()] * len(_KEY) + [pa.string()]
        yield pa.RecordBatch.from_pydict({n: pa.array(v, k) for (n, v), k in zip(done.items(), kinds)})
    if now is not None:
        yield row(tuple(now), state.hexdigest())


def _ends(members: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256): digest of the ascending, comma-joined conversations that end in a node.

    Ranges of (node, conversation) are sorted and joined to pieces, so a node
    in which very many end is many ranges; the hash of its pieces is taken in
    one pass, as a hash must be.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = members.where("ends").select(*_KEY, "conv_id")
    ranges = ids.repartitionByRange(parts, *_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id")
    pieces = ranges.mapInArrow(_pieces, "depth long, f1 long, f2 long, first long, piece string")
    return pieces.repartition(parts, *_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string")


def _nodes_of(members: DataFrame) -> DataFrame:
    lo_hi = {"parent": F.struct("p1", "p2"), "hash": F.struct("k1", "k2"), "ref": F.struct("ref_conv", "ref_at", "ref_turn")}
    checks = [f(c).alias(f"{p}_{n}") for n, c in lo_hi.items() for p, f in (("lo", F.min), ("hi", F.max))]
    return members.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), *checks)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations, one row each.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``, and ``turn_conv_id``/``turn``: the stored turn that is the
    node's last. ``conversations`` has conv_id, turn, role and text; other
    columns are ignored. Null roles and texts are empty, null turns come first,
    rows without conv_id are left out. Rows of one conversation with equal turn
    numbers (repeated rows too) all count, in a fixed order by a hash of role
    and text. A conversation's base is looked up by number and may be absent;
    for negative numbers the remainder has the number's sign. An empty table
    has no nodes, not even a root.
    """
    for seed in range(ATTEMPTS):
        turns = stored_turns(conversations, seed)
        members = settled(_members(settled(_products(turns))))
        nodes = settled(_nodes_of(members))
        if _is_whole(members, nodes, turns):
            break
    else:
        raise RuntimeError(f"unlike turns had equal hashes {ATTEMPTS} times")
    parent_key = [(F.col("depth") - 1).alias("depth"), F.col("lo_parent.p1").alias("f1"), F.col("lo_parent.p2").alias("f2")]
    below = nodes.where("depth > 0")
    children = below.groupBy(*parent_key).agg(F.count("*").alias("n_children"))
    known = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # what a node adds to its own subtree stands at its smallest member's place, so it is summed along that one conversation only
    own = known.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"))
    placed = members.select("conv_id", *_KEY).join(own, ["conv_id", "depth"], "left").na.fill(0, ["saved_tokens", "n_leaves"])
    sums = running(placed, "conv_id", "depth", ["saved_tokens", "n_leaves"], backwards=True)
    sums = sums.groupBy(*_KEY).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    parents = nodes.select(*(F.col(c).alias(f"__{c}") for c in _KEY), F.col("conv_id").alias("parent_conv_id"))
    same = [F.col("depth") - 1 == F.col("__depth"), F.col("lo_parent.p1") == F.col("__f1"), F.col("lo_parent.p2") == F.col("__f2")]
    full = known.join(sums, _KEY).join(_ends(members), _KEY, "left").join(parents, same, "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.col("lo_ref.ref_conv").alias("turn_conv_id"), F.col("lo_ref.ref_turn").alias("turn"),
    )
