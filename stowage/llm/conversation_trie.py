"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

Conversations that begin with the same turns share a path from the root. A node is known by its depth and the XOR of
two 64-bit hashes over (place, role, text) of the turns before it, so prefixes need no chain of hashes and a very
long conversation is hashed in blocks that are put together. From the distinct nodes on, a node is named by its
smallest member and its depth, which no other node shares.

Totals over subtrees come from contraction in join rounds. Each round *rakes* all leaves into their parents, whose
totals are then final, and *compresses* unary chains: a node with one child left is taken out where its hash is above
those of both neighbours, so that no two neighbours go at once, and its child hangs from its parent with what the node
held noted on the edge. A chain of n nodes is gone after a number of rounds that grows with the logarithm of n, as is
a star. The nodes taken out are then put back in reverse order, each from the total of the child it had.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stowage.session import share

BLOCK = 1024  # turns of a conversation whose hashes one window puts together
FAMILY = 100  # fixed value: conversations c to c + 99 share the first turns of one
HEADS = 6  # fixed value: the number of shared turns is a crc32 modulo this
PIECE = 1 << 16  # bytes of joined ids in a row
MOST_ROUNDS = 200
SUMS = ["leaves", "saved"]


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(rows: DataFrame, group: str, order: list[str], keep: list[Column]) -> DataFrame:
    """``group``, the columns ``keep`` and ``rank``: each row's place in its group, from 0.

    Rows are dealt by ranges of group and order, so a group of any size is spread over tasks; each part of a group
    is counted where it lies, and gets the number of rows in the parts before it.
    """
    tie = F.monotonically_increasing_id()
    dealt = rows.withColumn("_tie", tie).repartitionByRange(_parts(rows), group, *order, "_tie")
    lines = dealt.sortWithinPartitions(group, *order, "_tie").select(
        group, *keep, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_line")
    )
    lines = share(lines, "numbered")
    parts = lines.groupBy(group, "_part").agg(F.min("_line").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(
        group, "_part", (F.col("_before") - F.col("_first")).alias("_shift")
    )
    names = [c for c in lines.columns if c not in ("_part", "_line")]
    return lines.join(share(parts, "parts"), [group, "_part"]).select(*names, (F.col("_line") + F.col("_shift")).alias("rank"))


def plain_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, turn, role, text) of rows with an id; null roles and texts become empty."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    return conversations.select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")
    ).filter("c is not null")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, place, h1, h2, chars) of the rebuilt conversations, and (c, length) of each of them.

    Conversation c gets the first h turns of c - c % 100, then its own turns after its first h.
    """
    hashes = [F.xxhash64(F.lit(k), "role", "text").alias(f"t{k}") for k in (1, 2)]
    ranked = numbered(turns, "c", ["turn", "role", "text"], [*hashes, F.length("text").cast("long").alias("chars")])
    ranked = share(ranked, "ranked-turns")
    head = (F.crc32(F.col("c").cast("string").cast("binary")) % HEADS).cast("long")
    convs = ranked.groupBy("c").agg(F.count("*").alias("own")).withColumn("h", head)
    convs = share(convs.withColumn("base", F.col("c") - F.col("c") % FAMILY), "conversations")
    bases = convs.select(F.col("c").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").select(
        "c", "base", "h", F.least("h", F.coalesce("base_own", F.lit(0))).alias("taken"), "own"
    )
    convs = share(convs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "rebuilt")
    values = ["t1", "t2", "chars"]
    own = ranked.join(convs.select("c", "h", "taken"), "c").filter("rank >= h")
    own = own.select("c", (F.col("rank") - F.col("h") + F.col("taken")).alias("place"), *values)
    heads = ranked.filter((F.col("c") % FAMILY == 0) & (F.col("rank") < HEADS - 1)).withColumnRenamed("c", "base")
    heads = heads.join(convs.select("c", "base", "h"), "base").filter("rank < h")
    both = own.unionByName(heads.select("c", F.col("rank").alias("place"), *values))
    placed = both.select("c", "place", *[F.xxhash64("place", f"t{k}").alias(f"h{k}") for k in (1, 2)], "chars")
    return placed, convs.select("c", "length")


def steps_of(placed: DataFrame) -> DataFrame:
    """(c, depth, n1, n2, p1, p2, chars): per turn the node it leads to and that node's parent."""
    rows = share(placed.withColumn("block", F.floor(F.col("place") / BLOCK)), "placed")
    totals = rows.groupBy("c", "block").agg(*[F.bit_xor(f"h{k}").alias(f"h{k}") for k in (1, 2)])
    later = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("c", "block", *[F.bit_xor(f"h{k}").over(later).alias(f"b{k}") for k in (1, 2)])
    carried = share(carried.filter("block > 0"), "carried")
    inside = Window.partitionBy("c", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select("*", *[F.bit_xor(f"h{k}").over(inside).alias(f"x{k}") for k in (1, 2)])
    nodes = [F.col(f"x{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))).alias(f"n{k}") for k in (1, 2)]
    whole = local.join(carried, ["c", "block"], "left").select("c", (F.col("place") + 1).alias("depth"), *nodes, "h1", "h2", "chars")
    parents = [F.col(f"n{k}").bitwiseXOR(F.col(f"h{k}")).alias(f"p{k}") for k in (1, 2)]
    return share(whole.select("c", "depth", "n1", "n2", *parents, "chars"), "steps")


def nodes_of(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, n1, n2, p1, p2, conv_id, n_convs, chars), the root among them."""
    inner = steps.groupBy("depth", "n1", "n2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.min("chars").alias("chars")
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(*[zero.alias(n) for n in ("depth", "n1", "n2", "p1", "p2")], "conv_id", "n_convs", zero.alias("chars"))
    return share(inner.unionByName(root), "trie-nodes")


def joined_hash(rows: DataFrame, key: list[str], member: str) -> DataFrame:
    """``key`` and ``sha``: SHA-256 of the group's members as decimals, ascending, joined by commas.

    Rows are sorted by key and member over all tasks, so a large group is many tasks' work until it is a few long
    texts; the hash, which can only be made in order, then reads these one after the other and never holds them.
    """
    parts = _parts(rows)
    names = [*key, "first", "piece"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = None, [], 0
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                if held and (row[:-1] != at or size > PIECE):
                    out.append((*at, int(held[0]), ",".join(held)))
                    held, size = [], 0
                at = row[:-1]
                held.append(str(row[-1]))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)))))
        if held:
            yield pa.RecordBatch.from_pydict(dict(zip(names, ([v] for v in (*at, int(held[0]), ",".join(held))))))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[:-2] != at:
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = row[:-2], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(row[-1].encode())
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip([*key, "sha"], map(list, zip(*out)))))
        if at is not None:
            yield pa.RecordBatch.from_pydict(dict(zip([*key, "sha"], ([v] for v in (*at, state.hexdigest())))))

    longs = ", ".join(f"{k} long" for k in key)
    dealt = rows.select(*key, member).repartitionByRange(parts, *key, member).sortWithinPartitions(*key, member)
    pieces = dealt.mapInArrow(join, f"{longs}, first long, piece string")
    sorted_pieces = pieces.repartition(parts, *key).sortWithinPartitions(*key, "first")
    return sorted_pieces.mapInArrow(digest, f"{longs}, sha string")


def subtree_sums(tree: DataFrame) -> DataFrame:
    """(c, d) and the subtree totals of ``leaves`` and ``saved``, by rake, compress and re-expansion.

    ``tree`` has a row per node: its name (c, d), its parent's (pc, pd; null for the root), ``kids``, and its own
    ``leaves`` and ``saved``. Every round is written to the shared folder.
    """
    edge = [f"{s}_edge" for s in SUMS]
    live = share(tree.select("c", "d", "pc", "pd", "kids", *SUMS, *[F.lit(0).cast("long").alias(e) for e in edge]), "live")
    finished, removed = [], []
    rank = lambda c, d: F.xxhash64(F.lit(len(removed)), c, d)
    while not live.isEmpty():
        if len(removed) >= MOST_ROUNDS:
            raise RuntimeError(f"the tree is not contracted after {MOST_ROUNDS} rounds: is it a tree?")
        finished.append(live.filter("kids = 0").select("c", "d", *SUMS))
        leaf = F.col("kids") == 0
        from_kids = live.filter("pc is not null").groupBy("pc", "pd").agg(
            F.count_if(leaf).alias("raked"),
            *[F.coalesce(F.sum(F.when(leaf, F.col(s) + F.col(e))), F.lit(0)).alias(f"{s}_raked") for s, e in zip(SUMS, edge)],
            F.min(F.when(~leaf, F.struct("c", "d", *edge))).alias("kid"),
        )
        inner = live.filter("kids > 0").join(
            from_kids.withColumnsRenamed({"pc": "c", "pd": "d"}), ["c", "d"]
        ).withColumns({"kids": F.col("kids") - F.col("raked"), **{s: F.col(s) + F.col(f"{s}_raked") for s in SUMS}})
        own = rank(F.col("c"), F.col("d"))
        out = (F.col("kids") == 1) & F.col("pc").isNotNull() & (own > rank(F.col("pc"), F.col("pd"))) & (own > rank(F.col("kid.c"), F.col("kid.d")))
        inner = share(inner.select("c", "d", "pc", "pd", "kids", *SUMS, *edge, "kid", F.coalesce(out, F.lit(False)).alias("out")), "raked")
        gone = inner.filter("out")
        removed.append(
            gone.select("c", "d", F.col("kid.c").alias("kc"), F.col("kid.d").alias("kd"), *[(F.col(s) + F.col(f"kid.{e}")).alias(s) for s, e in zip(SUMS, edge)])
        )
        moved = gone.select(
            F.col("kid.c").alias("c"), F.col("kid.d").alias("d"), F.col("pc").alias("new_c"), F.col("pd").alias("new_d"),
            *[(F.col(s) + F.col(e)).alias(f"{s}_more") for s, e in zip(SUMS, edge)],
        )
        live = share(
            inner.filter("not out").join(moved, ["c", "d"], "left").select(
                "c", "d", F.coalesce("new_c", "pc").alias("pc"), F.coalesce("new_d", "pd").alias("pd"), "kids", *SUMS,
                *[(F.col(e) + F.coalesce(f"{s}_more", F.lit(0))).alias(e) for s, e in zip(SUMS, edge)],
            ),
            "live",
        )
    known = None
    for part in finished:
        known = part if known is None else known.unionByName(part)
    if known is None:
        return live.select("c", "d", *SUMS)
    known = share(known, "raked-totals")
    for part in reversed(removed):  # the last taken out is the first put back
        if part.isEmpty():
            continue
        kid = known.select(F.col("c").alias("kc"), F.col("d").alias("kd"), *[F.col(s).alias(f"{s}_kid") for s in SUMS])
        back = part.join(kid, ["kc", "kd"]).select("c", "d", *[(F.col(s) + F.col(f"{s}_kid")).alias(s) for s in SUMS])
        known = known.unionByName(share(back, "expanded"))
    return known


def conversation_trie(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are ordered by ``turn``, null first, ties by role and text; repeated rows are turns of their own. Null roles
    and texts count as empty; rows with a null id belong to no conversation and are left out. A rebuilt conversation
    without turns is a member of the root alone. An empty table has no nodes, not even a root. Texts are hashed whole,
    whatever their length; other columns are not read. A very long conversation and a node with very many members or
    children are spread over tasks.
    """
    placed, convs = rebuilt_turns(plain_turns(conversations, conv, turn, role, text))
    steps = steps_of(placed)
    nodes = nodes_of(steps, convs)
    names = nodes.select(F.col("depth").alias("pd"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("pc"))
    tree = nodes.withColumn("pd", F.when(F.col("depth") > 0, F.col("depth") - 1)).join(names, ["pd", "p1", "p2"], "left")
    tree = tree.select("conv_id", "depth", "pc", "pd", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    tree = share(tree, "trie")
    kids = tree.filter("pd is not null").groupBy(F.col("pc").alias("conv_id"), F.col("pd").alias("depth")).agg(F.count("*").alias("n_children"))
    tree = share(tree.join(kids, ["conv_id", "depth"], "left").fillna(0, ["n_children"]), "trie-children")
    sums = subtree_sums(
        tree.select(
            F.col("conv_id").alias("c"), F.col("depth").alias("d"), "pc", "pd", F.col("n_children").alias("kids"),
            (F.col("n_children") == 0).cast("long").alias("leaves"), "saved",
        )
    ).withColumnsRenamed({"c": "conv_id", "d": "depth", "leaves": "n_leaves", "saved": "saved_tokens"})

    last = steps.join(convs.withColumnRenamed("length", "depth"), ["c", "depth"]).select("c", "depth", "n1", "n2")
    ends = share(last, "ends").join(nodes.select("depth", "n1", "n2", "conv_id"), ["depth", "n1", "n2"]).select("conv_id", "depth", "c")
    blank = convs.filter("length = 0").select(F.col("c"), F.lit(0).cast("long").alias("depth"))
    blank = blank.join(nodes.filter("depth = 0").select("depth", "conv_id"), "depth").select("conv_id", "depth", "c")
    hashes = joined_hash(ends.unionByName(blank), ["conv_id", "depth"], "c")
    return (
        tree.join(sums, ["conv_id", "depth"])
        .join(hashes, ["conv_id", "depth"], "left")
        .select(
            "conv_id", "depth", F.col("pc").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


TRIE_SQL = """
with turns as (
    select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as k
    from conversations where conv_id is not null
), convs as (
    select c, c - c % 100 as base, count(*) as own,
           xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(c as varchar), ''), lambda x: ascii(x)::bigint)),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                   lambda v, step: xor(v >> 1, 3988292384::bigint * (v & 1)))), 4294967295::bigint) % 6 as h
    from turns group by c
), joined as (
    select v.c, v.base, v.h, least(v.h, coalesce(b.own, 0)) as taken, v.own
    from convs v left join convs b on b.c = v.base
), rebuilt as (
    select j.c, t.k - j.h + j.taken as place, t.role, t.text
    from joined j join turns t on t.c = j.c where t.k >= j.h
    union all
    select j.c, t.k, t.role, t.text from joined j join turns t on t.c = j.base where t.k < j.h
), steps as (
    select c, place + 1 as depth, text,
           md5(cast(list({'r': role, 't': text}) over (partition by c order by place) as varchar)) as node
    from rebuilt
    union all
    select c, 0, '', 'root' from joined
), lengths as (
    select c, max(depth) as length from steps group by c
), nodes as (
    select node, depth, min(c) as conv_id, count(*) as n_convs, any_value(length(text)) as chars
    from steps group by node, depth
), parents as (
    select n.node, n.depth, p.node as parent, p.conv_id as parent_conv_id
    from nodes n join steps s on s.c = n.conv_id and s.depth = n.depth - 1 join nodes p on p.node = s.node and p.depth = s.depth
), kids as (
    select parent, depth - 1 as depth, count(*) as n from parents group by all
), valued as (
    select n.*, coalesce(k.n, 0) as n_children, (n.n_convs - 1) * n.chars as saved
    from nodes n left join kids k on k.parent = n.node and k.depth = n.depth
), sums as (
    select s.node, s.depth, sum(cast(v.n_children = 0 as bigint)) as n_leaves, sum(v.saved) as saved_tokens
    from valued v join steps s on s.c = v.conv_id and s.depth <= v.depth
    group by s.node, s.depth
), ends as (
    select s.node, s.depth, string_agg(cast(s.c as varchar), ',' order by s.c) as members
    from steps s join lengths l on l.c = s.c and l.length = s.depth group by s.node, s.depth
)
select v.conv_id, cast(v.depth as bigint) as depth, p.parent_conv_id, v.n_convs, v.n_children,
       cast(t.n_leaves as bigint) as n_leaves, cast(t.saved_tokens as bigint) as saved_tokens, sha256(coalesce(e.members, '')) as ends_sha256
from valued v join sums t on t.node = v.node and t.depth = v.depth
left join parents p on p.node = v.node and p.depth = v.depth
left join ends e on e.node = v.node and e.depth = v.depth
"""
