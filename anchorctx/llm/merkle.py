"""Merkle manifest of a dataset: digests of rows, folded per group and over the groups.

Rows of a group are numbered in order; every level equijoins the nodes with the computed
indices of their siblings, and the nodes in slot zero of a run emit its parent.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorctx.llm.common import discard, documents, saved, shuffles_removed

ARITY = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NO_STEPS = "cast(array() as array<struct<left: binary, right: binary>>)"


def _field(column: str | Column) -> Column:
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[str | Column] = COLUMNS) -> Column:
    """Lowercase hex SHA-256 of the columns, each ``-`` if null, else byte count, ``:`` and value."""
    return F.sha2(F.concat(*map(_field, columns)), 256)


def proof_digest(proof: str) -> Column:
    """Digest of the siblings of a proof, level by level, left to right."""
    siblings = f"transform({proof}, s -> lower(hex(concat(s.left, s.right))))"
    return F.expr(f"sha2(array_join({siblings}, ''), 256)")


def folded_root(leaf: str, proof: str) -> Column:
    """The root that a leaf (lowercase hex) and its proof lead to."""
    step = "sha2(concat(lower(hex(s.left)), h, lower(hex(s.right))), 256)"
    return F.expr(f"aggregate({proof}, {leaf}, (h, s) -> {step})")


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], index: str) -> DataFrame:
    """``rows`` with their position in ``order`` (nulls first) within ``group``, gapless from 0.

    ``rows`` is a saved table. Rows are dealt by ranges of group and order, so a large group is
    spread over many tasks; positions add up from counts per task and group. Rows equal
    in all of these columns are told apart by their place in the table, and spread as well.
    """
    keys = [*group, *order, "_row"]
    placed = saved(
        rows.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("_row").withColumn("_at", F.monotonically_increasing_id()),
        "merkle-order",
    ).withColumn("_part", F.shiftright("_at", 33))
    own = ", ".join([*group]) or "1"
    counts = saved(
        placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
        .withColumn(
            "_before",
            F.expr(
                f"coalesce(sum(_n) over (partition by {own} order by _part"
                " rows between unbounded preceding and 1 preceding), 0)"
            ),
        )
        .drop("_n"),
        "merkle-counts",
    )
    return (
        placed.join(counts, [*group, "_part"])
        .withColumn(index, F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_at", "_part", "_first", "_before")
    )


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Each node (``grp``, ``idx``, ``digest``) with the digests to its left and right in its run.

    A node asks for the nodes of its run by their indices: its own index shifted to another
    slot (XOR 1 where runs are pairs). Offset 0 is the node itself, so a run of one is found too.
    Nodes and questions are both dealt by the run, which decides where a sibling's index is.
    """
    nodes = nodes.withColumn("run", F.expr(f"idx div {arity}")).repartition("grp", "run")
    if arity == 2:
        sibling = "idx ^ offset"
    else:
        sibling = f"idx - idx % {arity} + (idx % {arity} + offset) % {arity}"
    wanted = nodes.selectExpr(
        "grp", "run", "idx as of", f"explode(sequence(0, {arity - 1})) as offset"
    ).selectExpr("grp", "run", "of", f"{sibling.replace('idx', 'of')} as idx")
    found = (
        wanted.join(nodes, ["grp", "run", "idx"])
        .groupBy("grp", "run", F.col("of").alias("idx"))
        .agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("all"))
    )

    def joined(comparison: str) -> str:
        some = f"filter(all, x -> x.idx {comparison} idx)"
        return f"unhex(array_join(transform({some}, x -> hex(x.digest)), ''))"

    return found.selectExpr(
        "grp", "idx", f"{joined('<')} as left", f"{joined('=')} as digest", f"{joined('>')} as right"
    ).withColumn("single", F.expr("idx = 0 and length(left) + length(right) = 0"))


@contextmanager
def partly_keyed(spark: SparkSession) -> Iterator[None]:
    """Joins take inputs that are both dealt by some of the join's keys as they are."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _levels(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """Saved tables of nodes with their siblings, from the leaves up until each group has one node.

    A group's last node is ``single``, and only that: a run of one elsewhere has its parent.
    """
    found = []
    while True:
        with shuffles_removed(nodes.sparkSession), partly_keyed(nodes.sparkSession):
            level = saved(_with_siblings(nodes, arity), "merkle-level")
        found.append(level)
        parents = level.where(f"not single and idx % {arity} = 0").selectExpr(
            "grp",
            f"idx div {arity} as idx",
            "unhex(sha2(lower(hex(concat(digest, right))), 256)) as digest",
        )
        if parents.isEmpty():
            return found
        nodes = parents


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(``grp``, ``digest``): the last node of every group."""
    found = levels[0].where("single")
    for level in levels[1:]:
        found = found.unionByName(level.where("single"))
    return found.select("grp", "digest")


def _proofs(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """(``grp``, ``idx``, ``proof`` and further columns of ``tops``) for all nodes of the lowest level.

    From above: a group's last node has the proof of its row in ``tops``, any other node its own
    siblings followed by its parent's proof. So a path is shuffled once per run, not once per leaf.
    """
    own = F.array(F.struct("left", "right"))
    found = None
    for depth, level in reversed(list(enumerate(levels))):
        here = level.where("single").select("grp", "idx").join(tops, "grp")
        if found is not None:
            more = level.where("not single").withColumn("parent", F.expr(f"idx div {arity}"))
            here = here.unionByName(
                more.join(found.withColumnRenamed("idx", "parent"), ["grp", "parent"])
                .withColumn("proof", F.concat(own, "proof"))
                .select(*here.columns)
            )
        found = saved(here, "merkle-proofs") if depth else here
    return found


def merkle_manifest(
    rows: DataFrame,
    *,
    order: str = "doc_id",
    group: str = "source",
    columns: Sequence[str] = COLUMNS,
    carry: Mapping[str, Column] | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """(``order``, ``group``, slot, leaf, subroot, root, proof) of every row, and what is carried along.

    The rows of a group ascend by ``order``, then by leaf; ``slot`` is their place. While a
    group has several nodes, every ``arity`` consecutive ones, the last fewer, become the digest of
    their digests in lowercase hex. What remains is the subroot; subroots in the bytewise order of
    their groups, null first, lead to the root in the same way. ``proof`` lists, from the leaf to
    the root, the digests to the ``left`` and to the ``right`` in each run, as joined bytes; see
    ``folded_root``. ``carry`` names columns to compute from the rows and to hand on.

    Null values are ``-`` in a leaf, null order values come first, null is a group of its own. Rows
    equal in everything have equal leaves and take the slots in any way. A lone row is its own
    subroot, a lone subroot the root; an empty table gives an empty manifest. Whole texts
    are digested, and only there are they read; other columns are not read.

    No group is held in one task: leaves are numbered by ranges, and each level is an equijoin on
    (group, index) whose keys occur ``arity`` times at most. Levels, one per power of ``arity``,
    are written tables.
    """
    carry = dict(carry or {})
    leaves = saved(
        rows.select(
            F.col(order).alias("_order"),
            F.col(group).alias("_group"),
            # Bytewise order with null first, and an equijoin that keeps null.
            F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("")).alias("_key"),
            F.unhex(leaf_digest(columns)).alias("_leaf"),
            *[column.alias(f"_carried_{name}") for name, column in carry.items()],
        ),
        "merkle-leaves",
    )
    keys = saved(leaves.select("_key").distinct(), "merkle-groups")
    ranks = saved(numbered(keys, [], ["_key"], "grp"), "merkle-groups")
    placed = saved(
        numbered(leaves, ["_key"], ["_order", "_leaf"], "idx").join(ranks, "_key").drop("_key"),
        "merkle-placed",
    )
    discard(leaves, keys)

    levels = _levels(placed.select("grp", "idx", F.col("_leaf").alias("digest")), arity)
    subroots = saved(_tops(levels), "merkle-subroots")
    upper = _levels(subroots.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("idx"), "digest"), arity)
    root = _tops(upper).select("grp", F.expr(f"{_NO_STEPS} as proof"), F.col("digest").alias("root"))
    above = _proofs(upper, root, arity).select(F.col("idx").alias("grp"), "proof", "root")
    tops = saved(
        above.join(subroots.withColumnRenamed("digest", "subroot"), "grp"), "merkle-tops"
    )
    text = {name: F.lower(F.hex(name)) for name in ("subroot", "root")}
    return placed.join(_proofs(levels, tops, arity), ["grp", "idx"]).select(
        F.col("_order").alias(order),
        F.col("_group").alias(group),
        F.col("idx").alias("slot"),
        F.lower(F.hex("_leaf")).alias("leaf"),
        *[column.alias(name) for name, column in text.items()],
        "proof",
        *[F.col(f"_carried_{name}").alias(name) for name in carry],
    )


def tampered(text: str, doc_id: str, mod: int = 5) -> Column:
    """``text`` with A-Z lower-cased where ``mod`` divides crc32 of the id as text."""
    upper = "".join(map(chr, range(65, 91)))
    chosen = F.crc32(F.col(doc_id).cast("string")) % mod == 0
    return F.when(chosen, F.translate(text, upper, upper.lower())).otherwise(F.col(text))


def op11_merkle(spark, sf_dir):
    """Manifest of the documents, and the roots that partly tampered texts lead to."""
    changed = leaf_digest([*COLUMNS[:-1], tampered("text", "doc_id")])
    rows = merkle_manifest(documents(spark, sf_dir), carry={"tampered_leaf": changed})
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        proof_digest("proof").alias("proof_sha256"),
        folded_root("tampered_leaf", "proof").alias("folded_root"),
    ).withColumn("verified", F.expr("folded_root = root"))


# Levels in the statement below: enough for 16 ** 5 rows of a source and as many sources.
_SQL_LEVELS = 5


def _sql() -> str:
    """Each level as two tables: nodes, and what stands beside each node in its run."""
    field = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
    head = " || ".join(field.format(c) for c in COLUMNS[:-1])
    changed = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32, bit by bit over the digits of the id; 3988292384 is its polynomial.
    bit = "lambda c, z: xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    digits = "list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)"
    crc = f"xor(list_reduce(list_prepend(4294967295, {digits}), {byte}), 4294967295)"
    ctes = [
        f"""hashed as materialized (select doc_id, source, sha256({head} || {field.format('text')}) as leaf,
              sha256({head} || {field.format(f"(case when {crc} % 5 = 0 then {changed} else text end)")})
              as tampered_leaf from documents)""",
        """placed as materialized (select *, row_number() over (partition by source order by doc_id nulls first,
              leaf) - 1 as idx, dense_rank() over (order by source is not null, encode(source)) - 1 as grp
              from hashed)""",
        "a0 as (select grp, idx, leaf as digest from placed)",
    ]

    def levels(name: str) -> None:
        for k in range(_SQL_LEVELS):
            ctes.append(f"""{name}s{k} as materialized (
              select n.grp, n.idx, any_value(n.digest) as digest, any_value(n.many) as many,
                     coalesce(string_agg(o.digest, '' order by o.idx) filter (o.idx < n.idx), '') as l,
                     coalesce(string_agg(o.digest, '' order by o.idx) filter (o.idx > n.idx), '') as r
              from (select *, count(*) over (partition by grp) > 1 as many from {name}{k}) n
              join {name}{k} o on o.grp = n.grp and o.idx // 16 = n.idx // 16
              group by n.grp, n.idx)""")
            ctes.append(f"""{name}{k + 1} as materialized (
              select grp, idx // 16 as idx, case when many then sha256(l || digest || r) else digest end
                     as digest from {name}s{k} where idx % 16 = 0)""")

    levels("a")
    ctes.append(f"b0 as (select 0 as grp, grp as idx, digest from a{_SQL_LEVELS})")
    levels("b")
    joins, folded, proof = "", "tampered_leaf", []
    for name, number in (("a", "p.idx"), ("b", "p.grp")):
        grp = "p.grp" if name == "a" else "0"
        for k in range(_SQL_LEVELS):
            t = f"{name}s{k}"
            joins += f" join {t} on {t}.grp = {grp} and {t}.idx = {number} // {16**k}"
            proof.append(f"{t}.l || {t}.r")
    ctes.append(f"paths as materialized (select p.*, {' || '.join(proof)} as proof, " + ", ".join(
        f"{n}s{k}.{c} as {n}{c}{k}" for n in "ab" for k in range(_SQL_LEVELS) for c in ("l", "r", "many")
    ) + f" from placed p{joins})")
    last = "paths"
    for n in "ab":
        for k in range(_SQL_LEVELS):
            step = f"case when {n}many{k} then sha256({n}l{k} || {folded} || {n}r{k}) else {folded} end"
            ctes.append(f"f{n}{k} as (select * exclude (tampered_leaf), {step} as tampered_leaf from {last})")
            last = f"f{n}{k}"
    return f"""
        with {', '.join(ctes)}
        select doc_id, leaf, a{_SQL_LEVELS}.digest as subroot, b{_SQL_LEVELS}.digest as root,
               sha256(proof) as proof_sha256, f.tampered_leaf as folded_root,
               f.tampered_leaf = b{_SQL_LEVELS}.digest as verified
        from {last} f join a{_SQL_LEVELS} using (grp) join b{_SQL_LEVELS} on true
    """


ORACLE_SQL = _sql()
