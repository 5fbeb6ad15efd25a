"""A Merkle tree over the rows of a data set: a tree for each group of rows, and one over the groups.

Rows are leaves, numbered within their group in order. Each level is a table of nodes (group,
index, digest). A node's slot is index % arity; siblings are found by equi-joining the level
with itself on the index minus the slot's offset, and the rows of slot zero emit the parents.
Every level's runs of siblings are kept as a table, a third as large as the one before, so the
way back from the root to the leaves is one join a level and no row meets more than its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import free_name, table, written

ARITY = 3
_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its lower 33 bits


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts, one after the other; null parts are left out."""
    return F.unhex(F.sha2(F.concat_ws("", *parts), 256))


def as_text(sha: Column) -> Column:
    return F.lower(F.hex(sha))


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes in UTF-8, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name`` = 0, 1, ... within each group (nulls are values too), in the order of ``order``, nulls first.

    Rows are sorted by range over all groups, so a group with a third of all rows is many
    partitions. Rows that are equal in all of ``order`` are put in any one order. Places
    within a partition come from its row marks, offsets from one row per group and
    partition that holds it.
    """
    mark, part, first, before = (free_name(x, rows.columns) for x in ("mark", "part", "first", "before"))
    tied = rows.withColumn(mark, F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in (*group, *order, mark)]
    placed = tied.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(mark, F.monotonically_increasing_id())
    placed = written(placed.withColumn(part, F.shiftright(mark, _ROW_BITS)))
    pieces = placed.groupBy(*group, part).agg(F.min(mark).alias(first), F.count("*").alias("n"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn(before, F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col(first))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*group, part)]
    joined = placed.alias("l").join(pieces.alias("r"), reduce(Column.__and__, same))
    return joined.select(*[F.col(f"l.`{c}`") for c in rows.columns], (F.col(f"l.{mark}") + F.col(f"r.{before}")).alias(name))


def levels(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """All levels above ``nodes`` (tree, idx, n nodes of the tree, sha).

    Returns a table of runs per level (tree, up: the parent's index, n, run: digests of the
    siblings in order) and the top node of each tree (tree, sha). Trees of different height
    leave the levels when one node of theirs is left. The only number that reaches the
    driver is the largest ``n``, which gives the number of levels.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    runs, tops = [], [nodes.where("n = 1").select("tree", "sha")]
    while most > 1:
        nodes = nodes.where("n > 1")
        level = nodes.where(f"idx % {arity} = 0").select("tree", "idx", "n", F.col("sha").alias("sha_0"))
        for slot in range(1, arity):
            shifted = nodes.where(f"idx % {arity} = {slot}").select("tree", (F.col("idx") - slot).alias("idx"), F.col("sha").alias(f"sha_{slot}"))
            level = level.join(shifted, ["tree", "idx"], "left")
        run = F.array_compact(F.array(*[f"sha_{slot}" for slot in range(arity)]))
        level = written(level.select("tree", F.floor(F.col("idx") / arity).alias("up"), "n", run.alias("run")))
        runs.append(level)
        sha = digest(F.array_join(F.transform("run", as_text), ""))
        nodes = level.select("tree", F.col("up").alias("idx"), F.ceil(F.col("n") / arity).alias("n"), sha.alias("sha"))
        tops.append(nodes.where("n = 1").select("tree", "sha"))
        most = -(-most // arity)
    return runs, reduce(DataFrame.union, tops)


def paths(runs: list[DataFrame], trees: DataFrame, arity: int = ARITY) -> DataFrame:
    """``tree``, ``up``, ``runs`` and the other columns of ``trees``: the runs from a run of leaves to the top of its tree.

    ``trees`` has ``tree`` and ``leaves``, the number of its leaves. A tree with one leaf has
    no runs. The nodes of a level join the paths of the level above on their parent's run.
    """
    size = F.col("leaves")
    at_level = []
    for _ in range(len(runs) + 1):
        at_level.append(size)
        size = F.ceil(size / arity)
    extra = [c for c in trees.columns if c != "tree"]
    nothing = F.array().cast("array<array<binary>>")

    def ending_at(level: int) -> DataFrame:
        here = at_level[level] == 1
        if level:
            here &= at_level[level - 1] > 1
        return trees.where(here).select("tree", F.lit(0).cast("long").alias("up"), nothing.alias("runs"), *extra)

    path = ending_at(len(runs))
    for level in reversed(range(len(runs))):
        step = runs[level].select("tree", F.col("up").alias("low"), F.floor(F.col("up") / arity).alias("up"), "run")
        joined = step.join(path, ["tree", "up"])
        path = joined.select("tree", F.col("low").alias("up"), F.concat(F.array("run"), "runs").alias("runs"), *extra).union(ending_at(level))
    return path


def folded(start: Column, index: Column, runs: Column, arity: int = ARITY) -> Column:
    """(sha, siblings): a node's digest carried up through its runs, with the digests next to it in text, in order."""
    state = F.struct(start.alias("sha"), index.cast("long").alias("at"), F.lit("").alias("siblings"))

    def up(acc: Column, run: Column) -> Column:
        slot = (acc["at"] % arity).cast("int")
        before, after = F.slice(run, F.lit(1), slot), F.slice(run, slot + 2, F.lit(arity))
        left, right = (F.array_join(F.transform(x, as_text), "") for x in (before, after))
        return F.struct(
            digest(left, as_text(acc["sha"]), right).alias("sha"),
            F.floor(acc["at"] / arity).alias("at"),
            F.concat(acc["siblings"], left, right).alias("siblings"),
        )

    return F.aggregate(runs, state, up)


def manifest(docs: DataFrame, group: str = "source", order: str = "doc_id", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), arity: int = ARITY, recheck: dict[str, Column] | None = None) -> DataFrame:
    """``order`` and ``group`` of each row with ``leaf``, ``subroot``, ``root``, ``proof`` and ``folded`` (hex digests).

    ``proof`` is the text of all siblings from the leaf to the root, ``folded`` the root that
    this proof gives for the leaf as it is now: ``recheck`` replaces columns by what a
    receiver holds; by default they are as they were, and ``folded`` equals ``root``.

    Rows are leaves of their group's tree by ``order``, then by digest; nulls come first and
    a null group is a group. Rows that repeat are leaves of their own. Groups are the leaves
    of the top tree in their order. An empty table gives no rows, one row alone is subroot
    and root itself. Columns other than ``columns`` do not count; a null in any of them does.

    Texts are read once, and reduced to digests there. Nothing but the number of levels
    and the root reaches the driver.
    """
    now = recheck or {}
    kept = docs.select(
        F.col(f"`{group}`").alias("grp"), F.col(f"`{order}`").alias("ord"),
        row_digest([F.col(f"`{c}`") for c in columns]).alias("sha"),
        row_digest([now.get(c, F.col(f"`{c}`")) for c in columns]).alias("now"),
    )
    kept = written(kept)
    leaves = numbered(kept, ["grp"], ["ord", "sha"], "idx")
    sizes = kept.groupBy("grp").agg(F.count("*").alias("leaves"))
    everything = F.lit(0).alias("all")
    trees = written(numbered(sizes.select(everything, "grp", "leaves"), ["all"], ["grp"], "tree").drop("all"))
    leaves = written(leaves.alias("l").join(trees.alias("t"), F.expr("l.grp <=> t.grp")).select("l.*", "t.tree", "t.leaves"))
    runs, tops = levels(leaves.select("tree", "idx", F.col("leaves").alias("n"), "sha"), arity)
    tops = written(tops.select(F.lit(0).cast("long").alias("one"), F.col("tree").alias("idx"), "sha"))
    n_trees = tops.count()
    top_runs, root = levels(tops.select(F.col("one").alias("tree"), "idx", F.lit(n_trees).cast("long").alias("n"), "sha"), arity)
    root = root.first()  # none if there are no rows
    root_sha = F.lit(root["sha"] if root else None).cast("binary")
    one = docs.sparkSession.range(1).select(F.col("id").alias("tree"), F.lit(n_trees).cast("long").alias("leaves"))
    top = paths(top_runs, one, arity).select("up", F.col("runs").alias("top"))
    subroots = tops.withColumn("up", F.floor(F.col("idx") / arity)).join(top, "up").select(F.col("idx").alias("tree"), F.col("sha").alias("subroot"), "top")
    path = paths(runs, written(trees.select("tree", "leaves").join(subroots, "tree")), arity).drop("leaves")
    joined = leaves.withColumn("up", F.floor(F.col("idx") / arity)).join(path, ["tree", "up"])
    inner = folded(F.col("now"), F.col("idx"), F.col("runs"), arity)
    proved = joined.select("grp", "ord", "sha", "subroot", "tree", "top", inner.alias("inner"))
    outer = folded(F.col("inner.sha"), F.col("tree"), F.col("top"), arity)
    proved = proved.select("grp", "ord", "sha", "subroot", "inner", outer.alias("outer"))
    return proved.select(
        F.col("ord").alias(order), F.col("grp").alias(group), as_text(F.col("sha")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"),
        as_text(root_sha).alias("root"), F.concat("inner.siblings", "outer.siblings").alias("proof"), as_text(F.col("outer.sha")).alias("folded"),
    )


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 != 0
    tampered = F.when(odd, F.col("text")).otherwise(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    done = manifest(docs, recheck={"text": tampered})
    return done.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


#: CRC-32 of the decimal digits of ``x``, bit by bit; 3988292384 is the reversed polynomial, a fixed value.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({x}, ''), lambda c: ascii(c)::bigint)),
  lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda b, k: case when b % 2 = 1 then xor(b // 2, 3988292384::bigint) else b // 2 end)), 4294967295::bigint)"""
_FIELDS = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", "{text}"]


def _leaf(text: str) -> str:
    fields = [f.format(text=text) for f in _FIELDS]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


#: Parents by grouping on the index, proofs by walking each leaf up through windows over its run.
OP12_SQL = f"""
with recursive rows as (
  select doc_id, source, {_leaf("text")} as leaf,
    {_leaf(f"case when {_CRC.format(x='cast(doc_id as varchar)')} % 2 = 0 then replace(text, chr(10), '') else text end")} as now
  from documents
), placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx,
    dense_rank() over (order by encode(source) nulls first) as tree from rows
), nodes as (
  select tree, 0 as level, idx, leaf as h, count(*) over (partition by tree) as n from placed
  union all
  select tree, level + 1, idx // 3, sha256(string_agg(h, '' order by idx)), (n + 2) // 3
  from nodes where n > 1 group by tree, level, idx // 3, n
), subroots as (
  select tree, h from nodes where n = 1
), tops as (
  select 0 as level, tree - 1 as idx, h, (select count(*) from subroots) as n from subroots
  union all
  select level + 1, idx // 3, sha256(string_agg(h, '' order by idx)), (n + 2) // 3 from tops where n > 1 group by level, idx // 3, n
), beside as (
  select a.tree, a.level, a.idx,
    coalesce(string_agg(b.h, '' order by b.idx) filter (where b.idx < a.idx), '') as l, coalesce(string_agg(b.h, '' order by b.idx) filter (where b.idx > a.idx), '') as r
  from (select tree, level, idx, h, n from nodes union all select 0, level, idx, h, n from tops) a
  join (select tree, level, idx, h, n from nodes union all select 0, level, idx, h, n from tops) b
    on a.tree = b.tree and a.level = b.level and a.idx // 3 = b.idx // 3
  where a.n > 1 group by a.tree, a.level, a.idx
), walk as (
  select doc_id, leaf, tree as home, tree, 0 as level, idx, now as h, '' as proof, tree - 1 as top from placed
  union all
  select doc_id, leaf, home, case when s.tree is null then 0 else walk.tree end, case when s.tree is null then 0 else walk.level + 1 end,
    case when s.tree is null then top else walk.idx // 3 end,
    case when s.tree is null then walk.h else sha256(s.l || walk.h || s.r) end, case when s.tree is null then proof else proof || s.l || s.r end, top
  from walk left join beside s on s.tree = walk.tree and s.level = walk.level and s.idx = walk.idx
  where s.tree is not null or walk.tree > 0
), root as (
  select h from tops where n = 1
)
select doc_id, leaf, (select h from subroots s where s.tree = home) as subroot, (select h from root) as root,
  sha256(proof) as proof_sha256, walk.h as folded_root, walk.h = (select h from root) as verified
from walk where walk.tree = 0 and not exists (select 1 from beside s where s.tree = 0 and s.level = walk.level and s.idx = walk.idx)
"""
