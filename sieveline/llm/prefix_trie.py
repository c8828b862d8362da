"""The trie of shared prefixes of rebuilt conversations, by composable fingerprints.

A rebuilt conversation is the head of another one followed by its own later turns. No
rebuilt text is ever made: a sequence of turns has the fingerprint (n, F) with
F = sum of t_k r^k over its turn hashes t_k, in four lanes modulo 2^31 - 1, and
sequences are joined by (m, F) (n, G) = (m + n, F + r^m G). That is a monoid in which a
head can be taken off again, so the prefix of depth d of a rebuilt conversation is
``K + R F(j)``, where ``F(j)`` is its own prefix of j turns, and ``K`` and ``R`` are two
constants of the conversation, made of the base's head and its own one.

The turns are sorted once by conversation over all tasks, whatever the length of one;
prefixes are running sums within a task, and what a conversation has in tasks before is
joined on from the left by the same law: one row per task reaches the driver.

A turn is one row of one node: its stored reference. A node's members are told by equal
fingerprints, and equality is then verified: all references of a node must have the
same parent and, read back from the stored turns, the same role and text. By induction
over the depth its prefixes are then equal. Should a fingerprint ever fail, all are made
anew from other hashes.

Numbers of a subtree are no walk over levels either: a node is charged to its smallest
member, whose charges lie at the end of its path, so that a subtree is a sum over members
of what is charged to them, plus the node's own place in the path of its smallest member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.llm.common import map_batches
from sieveline.llm.links import lookup
from sieveline.shared import owned, written

#: A conversation's head comes from the one with the next smaller multiple of this.
FAMILY = 5
#: Heads have fewer turns than this.
HEADS = 9
PRIME = (1 << 31) - 1
LANES = range(4)
#: Turns of a conversation that are summed up at once, and ids that are one piece of a digest (as a shift).
CHUNK, PIECE = 4096, 14
#: Seeds of the turn hashes that are tried until no fingerprint fails.
TRIES = 8


def bases(seed: int) -> list[int]:
    """The base of each lane."""
    return [int.from_bytes(hashlib.sha256(f"{seed}:{lane}".encode()).digest()[:8], "big") % (PRIME - 1000) + 500 for lane in LANES]


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base^exponent modulo the prime."""
    out, square = np.ones(len(exponents), np.uint64), np.uint64(base)
    for bit in range(int(exponents.max(initial=0)).bit_length()):
        odd = (exponents >> bit) & 1 == 1
        out[odd] = out[odd] * square % np.uint64(PRIME)
        square = square * square % np.uint64(PRIME)
    return out


def ordered_turns(turns: DataFrame, columns: tuple[str, str, str, str], seed: int) -> DataFrame:
    """``(conv_id, part, role, text, n_bytes, h1, h2)`` sorted by conversation and turn,
    in ranges over tasks; ``part`` is the number of the task."""
    conv, turn, role, text = columns
    empty = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(""))
    rows = turns.select(quoted(conv).cast("bigint").alias("conv_id"), quoted(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    placed = rows.where("conv_id IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select(
        "conv_id",
        F.spark_partition_id().alias("part"),
        "role",
        "text",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.xxhash64(F.lit(seed), "role", "text").alias("h1"),
        F.xxhash64(F.lit(~seed), "text", "role").alias("h2"),
    )


def running(placed: DataFrame, seed: int) -> DataFrame:
    """The rows with ``n``, the place of the turn among those of its conversation in
    this task, ``f0..f3``, the fingerprint of these up to it, and ``u0..u3``, its own term."""
    roots = bases(seed)
    names = ["conv_id", "part", "role", "text", "n_bytes", "n", *[f"f{i}" for i in LANES], *[f"u{i}" for i in LANES]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count, held = None, 0, [0] * 4
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            conv = batch.column("conv_id").to_numpy()
            begins = np.empty(size, bool)
            begins[0], begins[1:] = conv[0] != last, conv[1:] != conv[:-1]
            starts = np.maximum.accumulate(np.where(begins, np.arange(size), 0))
            goes_on = ~np.logical_or.accumulate(begins)  # rows of the conversation that was on
            n = np.arange(size) - starts + 1 + np.where(goes_on, count, 0)
            wide = [batch.column(h).to_numpy().view(np.uint64) for h in ("h1", "h2")]
            terms, sums = [], []
            for lane in LANES:
                raw = wide[lane // 2]
                t = (raw >> np.uint64(33) if lane % 2 else raw & np.uint64(PRIME)) % np.uint64(PRIME)
                u = t * powers(roots[lane], n) % np.uint64(PRIME)
                total = np.cumsum(u)
                before = np.where(starts > 0, total[starts - 1], 0).astype(np.uint64)
                terms.append(u)
                sums.append((total - before + np.where(goes_on, held[lane], 0).astype(np.uint64)) % np.uint64(PRIME))
            last, count, held = conv[-1], int(n[-1]), [int(s[-1]) for s in sums]
            lanes = [pa.array(x.astype(np.int32)) for x in (*sums, *terms)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names[:5]], pa.array(n, pa.int64()), *lanes], names)

    schema = "conv_id bigint, part int, role string, text string, n_bytes bigint, n bigint, " + ", ".join(f"{x}{i} int" for x in "fu" for i in LANES)
    return map_batches(placed, run, schema)


def carried(stored: DataFrame, seed: int) -> DataFrame:
    """The turns with ``idx`` and the fingerprint ``f0..f3`` of their conversation up to
    them: what lies in tasks before is joined on the left."""
    roots = bases(seed)
    end = F.max_by(F.struct("n", *[f"f{i}" for i in LANES]), F.struct("conv_id", "n")).alias("end")
    edges = stored.groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), end).orderBy("part").collect()
    rows, on = [], None  # one row per task
    for edge in edges:
        n, f = edge["end"]["n"], [edge["end"][f"f{i}"] for i in LANES]
        if on and on[0] == edge["first"]:
            shift = [pow(r, on[1], PRIME) for r in roots]
            rows.append((edge["part"], edge["first"], on[1], *on[2], *shift))
            if edge["last"] == edge["first"]:
                n, f = n + on[1], [(c + q * x) % PRIME for c, q, x in zip(on[2], shift, f)]
        on = (edge["last"], n, f)
    if not rows:
        return stored.withColumnRenamed("n", "idx")
    lanes = [f"{x}{i}" for x in "cq" for i in LANES]
    before = stored.sparkSession.createDataFrame(rows, "part int, conv_id bigint, k bigint, " + ", ".join(f"{x} bigint" for x in lanes))
    joined = stored.join(F.broadcast(before), ["part", "conv_id"], "left")
    whole = {f"f{i}": (F.coalesce(f"c{i}", F.lit(0)) + F.coalesce(f"q{i}", F.lit(1)) * F.col(f"f{i}")) % PRIME for i in LANES}
    whole |= {f"u{i}": F.coalesce(f"q{i}", F.lit(1)) * F.col(f"u{i}") % PRIME for i in LANES}
    return joined.withColumns(whole | {"idx": F.col("n") + F.coalesce("k", F.lit(0))}).drop("n", "k", *lanes)


def rebuilt(turns: DataFrame, seed: int) -> DataFrame:
    """One row per conversation: ``n`` turns, of which those behind ``cut`` are its own
    part; ``head`` turns of its base with fingerprints ``heads`` stand before them, ``length``
    together; ``k0..k3`` and ``r0..r3`` make a prefix of its own one of the rebuilt one."""
    place = F.struct("idx", *[F.col(f"f{i}").cast("bigint").alias(f"f{i}") for i in LANES])
    known = turns.groupBy("conv_id").agg(
        F.max("idx").alias("n"), F.sort_array(F.collect_list(F.when(F.col("idx") < HEADS, place))).alias("first")
    )
    known = written(known, "conversations")
    base = known.select(F.col("conv_id").alias("base"), F.col("first").alias("base_first"))
    named = known.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    joined = named.join(base.where(F.col("base") % FAMILY == 0), "base", "left")
    own = F.col("base") == F.col("conv_id")
    cut = F.when(own, 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("bigint")
    head = F.when(own, 0).otherwise(F.least("cut", F.coalesce(F.size("base_first"), F.lit(0)))).cast("bigint")
    sized = joined.withColumn("cut", cut).withColumn("head", F.when(F.col("base_first").isNull(), 0).otherwise(head).cast("bigint"))
    at = lambda heads, n, i: F.when(F.col(n) > 0, F.coalesce(F.try_element_at(heads, F.col(n).cast("int"))[f"f{i}"], F.lit(0))).otherwise(0)
    back = lambda r: F.array(*[F.lit(pow(r, -k, PRIME)) for k in range(HEADS)])
    constants = {f"r{i}": F.element_at(back(r), (F.col("cut") - F.col("head") + 1).cast("int")).cast("bigint") for i, r in enumerate(bases(seed))}
    sized = sized.withColumns(constants | {"length": F.col("head") + F.greatest(F.col("n") - F.col("cut"), F.lit(0))})
    joins = {f"k{i}": F.pmod(at(F.col("base_first"), "head", i) - F.col(f"r{i}") * at(F.col("first"), "cut", i) % PRIME, F.lit(PRIME)) for i in LANES}
    heads = F.when(F.col("head") > 0, F.slice("base_first", F.lit(1), F.col("head").cast("int")))
    lanes = [f"{x}{i}" for x in "kr" for i in LANES]
    return sized.withColumns(joins | {"heads": heads}).select("conv_id", "n", "cut", "head", "length", "heads", *lanes)


def _key(lanes: list[Column], depth: Column) -> Column:
    """The name of a node."""
    pair = lambda a, b: F.shiftleft(a.cast("bigint"), 31).bitwiseOR(b.cast("bigint"))
    return F.struct(depth.cast("bigint").alias("depth"), pair(*lanes[:2]).alias("f"), pair(*lanes[2:]).alias("g"))


def path_rows(turns: DataFrame, plans: DataFrame, total: int) -> DataFrame:
    """``(conv_id, depth, node, parent, n_bytes, idx, last)``: a row for each turn of each
    rebuilt conversation. Turns of its own part are references; those of the head, which
    are the base's, have no ``idx``."""
    lanes = [f"{x}{i}" for x in "kr" for i in LANES]
    numbers = ["conv_id", "idx", "n_bytes", *[f"{x}{i}" for x in "fu" for i in LANES]]
    own = lookup(turns.select(numbers), plans.select("conv_id", "n", "cut", "head", "length", *lanes), "conv_id", total).where("idx > cut")
    own = own.withColumns({"depth": F.col("head") + F.col("idx") - F.col("cut")})
    whole = [(F.col(f"k{i}") + F.col(f"r{i}") * F.col(f"f{i}")) % PRIME for i in LANES]
    above = [F.pmod(w - F.col(f"r{i}") * F.col(f"u{i}") % PRIME, F.lit(PRIME)) for i, w in zip(LANES, whole)]
    last = (F.col("depth") == F.col("length")).alias("last")
    own = own.select("conv_id", "depth", _key(whole, F.col("depth")).alias("node"), _key(above, F.col("depth") - 1).alias("parent"), "n_bytes", "idx", last)
    heads = plans.where("head > 0").select("conv_id", "length", F.inline("heads")).withColumnRenamed("idx", "depth")
    node = _key([F.col(f"f{i}") for i in LANES], F.col("depth")).alias("node")
    nothing = [F.lit(None).cast(own.schema["parent"].dataType).alias("parent"), *[F.lit(None).cast("bigint").alias(c) for c in ("n_bytes", "idx")]]
    return own.union(heads.select("conv_id", "depth", node, *nothing, last))


def verified(paths: DataFrame, nodes: DataFrame, turns: DataFrame) -> bool:
    """Whether all references of each node have one parent and, read back from the stored
    turns, one role and text."""
    if not nodes.where("NOT one_parent").isEmpty():
        return False
    several = written(nodes.where("refs > 1").select("node", F.col("refs").alias("n")), "several")
    total = several.agg(F.sum("n")).first()[0]
    if not total:
        return True
    refs = paths.where("idx IS NOT NULL").select("node", "conv_id", "idx")
    marked = lookup(refs, several.withColumn("listed", F.lit(True)), "node", max(total, refs.count())).where("listed")
    read = turns.select("conv_id", "idx", F.struct("role", "text").alias("turn")).join(marked, ["conv_id", "idx"])
    return read.groupBy("node").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi")).where("lo != hi").isEmpty()


def digests(paths: DataFrame, plans: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` of the nodes at which conversations end. Ids are put
    together in ranges of 2^``PIECE`` ids, and their pieces streamed in order."""
    whole = plans.where("length = 0").select(_key([F.lit(0)] * 4, F.lit(0)).alias("node"), "conv_id")
    ends = paths.where("last").select("node", "conv_id").union(whole)
    piece = F.shiftright("conv_id", PIECE).alias("piece")
    lists = ends.groupBy("node", piece).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    texts = lists.select("node", "piece", F.concat_ws(",", F.transform("ids", lambda c: c.cast("string"))).alias("ids"))
    ordered = texts.repartition("node").sortWithinPartitions("node", "piece").select("node.depth", "node.f", "node.g", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for node, ids in zip(zip(*[batch.column(c).to_pylist() for c in ("depth", "f", "g")]), batch.column("ids").to_pylist()):
                if node != on:
                    if on:
                        done.append((*on, digest.hexdigest()))
                    on, digest = node, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield _digest_rows(done)
        if on:
            yield _digest_rows([(*on, digest.hexdigest())])

    found = map_batches(ordered, run, "depth bigint, f bigint, g bigint, ends_sha256 string")
    return found.select(F.struct("depth", "f", "g").alias("node"), "ends_sha256")


def _digest_rows(rows: list[tuple[int, int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["depth", "f", "g", "ends_sha256"])


def later_charges(tree: DataFrame) -> DataFrame:
    """``(node, later)``: what is charged to the smallest member of each node at the
    node's depth or behind it. A long path is summed up in chunks."""
    rows = tree.select("conv_id", "depth", "node", "charge", F.expr(f"depth div {CHUNK}").alias("chunk"))
    within = Window.partitionBy("conv_id", "chunk").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sum("charge").alias("charged"))
    behind = Window.partitionBy("conv_id").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    rest = chunks.withColumn("rest", F.sum("charged").over(behind)).where("rest > 0").drop("charged")
    summed = rows.withColumn("inner", F.sum("charge").over(within)).join(rest, ["conv_id", "chunk"], "left")
    return summed.select("node", (F.col("inner") + F.coalesce("rest", F.lit(0))).alias("later"))


@owned
def trie(
    turns: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``, one row for each node of the trie of rebuilt conversations.

    The turns of a conversation are in order of ``turn``, null first, equal ones by role and
    text; a null role or text is empty; equal rows are turns of their own. Conversation c
    is rebuilt as the first h turns of c - c % 5 (remainder as in SQL; as many as there
    are) and its own turns behind its first h, with h = crc32(c) % 9. Rows without a conversation are
    left out. A node is a distinct sequence of first turns: ``conv_id`` is the smallest
    conversation that begins with it, ``parent_conv_id`` that of the node above (null for
    the root), ``n_convs`` how many begin with it, ``n_leaves`` counts the childless nodes of
    its subtree, ``saved_tokens`` sums (n_convs - 1) times the bytes of the last text over
    it, ``ends_sha256`` is the digest of the ids that end at it, ascending, with commas.
    An empty table has no node, not even the root. Other columns are left behind.
    """
    columns = (conv_column, turn_column, role_column, text_column)
    for seed in range(TRIES):
        stored = written(running(ordered_turns(turns, columns, seed), seed), "turns")
        placed = carried(stored, seed)
        plans = written(rebuilt(placed, seed), "plans")
        total, convs, first = plans.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.min("conv_id")).first()
        paths = written(path_rows(placed, plans, total), "paths")
        nodes = paths.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.count("idx").alias("refs"),
            F.min("parent").alias("parent"),
            F.max("n_bytes").alias("n_bytes"),
            ((F.min("parent") == F.max("parent")) & (F.min("n_bytes") == F.max("n_bytes"))).alias("one_parent"),
        )
        nodes = written(nodes, "nodes")
        if verified(paths, nodes, placed):
            break
    else:
        raise RuntimeError("no seed tells the turns apart")

    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    charge = ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("charge")
    tree = nodes.join(children, "node", "left").select(
        "node", "node.depth", "conv_id", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), charge
    )
    tree = written(tree, "tree")

    # What is charged to each conversation, where its charges begin, and whether it stands for a leaf.
    owners = tree.groupBy("conv_id").agg(
        F.max("depth").alias("n"),
        F.min("depth").alias("since"),
        F.sum("charge").alias("charged"),
        F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"),
    )
    owners = written(owners, "owners")
    rows = paths.count()
    met = lookup(paths.select("conv_id", "depth", "node"), owners, "conv_id", rows)
    below = met.groupBy("node").agg(
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        F.coalesce(F.sum(F.when(F.col("depth") < F.col("since"), F.col("charged"))), F.lit(0)).alias("others"),
    )
    tops = tree.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n"))
    with_parents = lookup(tree, tops, "parent", tree.count())
    parent = F.when(F.col("depth") == 1, F.lit(first).cast("bigint")).otherwise(F.col("parent_conv_id"))
    listed = with_parents.join(below, "node", "left").join(later_charges(tree), "node", "left")
    listed = listed.select(
        "node", "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", (F.col("others") + F.col("later")).alias("saved_tokens")
    )
    top = tree.agg(
        F.lit(first).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.lit(convs).cast("bigint").alias("n_convs"),
        F.count(F.when(F.col("depth") == 1, 1)).alias("n_children"),
        F.greatest(F.count(F.when(F.col("n_children") == 0, 1)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("charge"), F.lit(0)).alias("saved_tokens"),
    )
    top = top.where("n_convs > 0").select(_key([F.lit(0)] * 4, F.lit(0)).alias("node"), "*")
    result = listed.union(top).join(digests(paths, plans), "node", "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return result.drop("node").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
