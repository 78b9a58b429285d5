"""A Merkle tree over the rows of a table, with the path that proves each row.

Rows are leaves, numbered within their group by a key. Every run of FANOUT consecutive nodes
has their joint digest as parent, until one node remains for each group, its subroot; the
subroots, ordered by group, give the root in the same way. The last run of a level may be
shorter, down to one node, whose parent is its digest again.

A tree is climbed in blocks of FANOUT ** LEVELS aligned nodes. Within a block a level is a
window over the numbered rows: a node stands on the row of its first leaf, so its siblings
are lag and lead columns at fixed offsets, masked by the node's slot in its run and the
length of the run, and the rows of first children hash the parents. On the way back each row
takes up its parent's path by a lag over its slot. The windows of a block share one shuffle
and one sort. The first rows of the blocks are the nodes of the next round, so a table of
10**12 rows takes five rounds with FANOUT 2, each a 512th of the last, and no task sees more
than one block of a group.

Groups and keys may be null (first) and repeat: rows of one key stand in order of their
digest. Repeated rows are leaves each. An empty table gives no rows. No column of the table is
needed besides those named; extra columns are left out unless they are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from estrato.workspace import freeze

FANOUT = 2
LEVELS = 9


def field(value: Column) -> Column:
    """A value as it enters a digest: `-` for null, else its UTF-8 length, `:` and itself."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def parent(digests: Column) -> Column:
    """Digest of an array of digests; nulls in it are not there."""
    return F.unhex(F.sha2(F.array_join(F.transform(digests, as_hex), ""), 256))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""

    def step(node: Column, at: Column) -> Column:
        others, slot = at["siblings"], at["slot"]
        return parent(F.concat(
            F.slice(others, F.lit(1), slot), F.array(node),
            F.slice(others, slot + 1, F.size(others)),
        ))

    return F.aggregate(path, leaf, step)


def siblings(path: Column) -> Column:
    """All digests of a path, from the leaf up and from left to right."""
    return F.flatten(F.transform(path, lambda at: at["siblings"]))


def manifest(
    docs: DataFrame, columns: tuple[str, ...], group: str, key: str, keep: tuple[str, ...] = (),
    fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """One row per row of `docs`: key, group, the columns in `keep`, `position` in the group,
    `leaf`, `path` (slot and siblings per level, from the leaf to the root), `subroot` and
    `root`; digests are 32 bytes."""
    leaves = freeze(
        docs.select(
            F.col(key).alias("__key"), F.col(group).alias("__group"),
            field(F.col(group)).alias("__name"),
            leaf_digest(*[F.col(c) for c in columns]).alias("__node"),
            *[F.col(c).alias(f"__keep_{c}") for c in keep],
            F.monotonically_increasing_id().alias("__row"),
        ),
        "leaves",
    )
    order = [F.asc_nulls_first(c) for c in ("__group", "__key", "__node", "__row")]
    rows = _numbered(leaves, order)
    blocks = _climbed(rows, fanout, levels)
    subroots = blocks[-1].where(F.col("__at") == 0).select(
        F.col("__name").alias("__group_name"), F.col("__top").alias("__subroot"),
        F.col("__top").alias("__node"), "__group",
    )
    top = _numbered(
        subroots.withColumn("__name", F.lit("")), [F.asc_nulls_first("__group")]
    )
    above = _climbed(top, fanout, levels)
    root = above[-1].where(F.col("__at") == 0).select(
        "__name", F.lit(0).cast("long").alias("__at"), F.array().cast(PATH).alias("__path"),
        F.col("__top").alias("__root"),
    )
    groups = _descended(above, root, fanout, levels, ("__group_name", "__subroot", "__root"))
    groups = groups.select(
        F.col("__group_name").alias("__name"), F.lit(0).cast("long").alias("__at"), "__path",
        "__subroot", "__root",
    )
    kept = [f"__keep_{c}" for c in keep]
    found = _descended(
        blocks, groups, fanout, levels, ("__subroot", "__root"),
        ("__key", "__group", "__node", *kept),
    )
    return found.select(
        F.col("__key").alias(key), F.col("__group").alias(group),
        *[F.col(f"__keep_{c}").alias(c) for c in keep], F.col("__at").alias("position"),
        F.col("__node").alias("leaf"), F.col("__path").alias("path"),
        F.col("__subroot").alias("subroot"), F.col("__root").alias("root"),
    )


PATH = "array<struct<slot:int,siblings:array<binary>>>"


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with `__at`, gapless from 0 within `__name`, and `__of`, the rows of a name.

    `order` is an order of names first. Rows are dealt to ranges and sorted there; only a
    table of one row per range and name is needed to join the ranges.
    """
    dealt = freeze(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({
            "__part": F.spark_partition_id(), "__seen": F.monotonically_increasing_id(),
        }),
        "ranges",
    )
    name = Window.partitionBy("__name")
    ranges = (
        dealt.groupBy("__name", "__part")
        .agg(F.min("__seen").alias("__first"), F.count("*").alias("__rows"))
        .select(
            "__name", "__part",
            (F.sum("__rows").over(name.orderBy("__part")) - F.col("__rows") - F.col("__first"))
            .alias("__shift"),
            F.sum("__rows").over(name).alias("__of"),
        )
    )
    return (
        dealt.join(ranges, ["__name", "__part"])
        .withColumn("__at", F.col("__seen") + F.col("__shift"))
        .drop("__part", "__seen", "__shift")
    )


def _climbed(rows: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Stored tables, one per round: the rows (later the first rows of blocks) with `__steps`,
    their path inside the block, and on first rows `__top`, the block's digest."""
    size = fanout**levels
    tables = []
    while True:
        tables.append(freeze(_block(rows, fanout, levels), "blocks"))
        # One number decides on another round; it is the size of the largest group.
        most = tables[-1].agg(F.max("__of")).first()[0] or 0
        if most <= size:
            return tables
        rows = tables[-1].where(F.col("__at") % size == 0).select(
            "__name", "__group", F.col("__top").alias("__node"),
            _over(F.col("__at"), size).alias("__at"),
            _over(F.col("__of") + (size - 1), size).alias("__of"),
        )


def _over(a: Column, size: int) -> Column:
    return F.floor(a / F.lit(size)) if size & (size - 1) else F.shiftright(a, size.bit_length() - 1)


def _block(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    at, of = F.col("__at"), F.col("__of")
    block = Window.partitionBy("__name", "__block").orderBy("__at")
    out = rows.withColumn("__block", _over(at, fanout**levels)).withColumn(
        "__node_0", F.col("__node")
    )
    for level in range(levels):
        span = fanout**level
        nodes = _over(of + (span - 1), span)
        slot = (_over(at, span) % fanout).cast("int")
        length = F.least(F.lit(fanout), nodes - (_over(at, span) - slot))
        node = F.col(f"__node_{level}")
        around = [
            F.when(slot >= d, F.lag(node, d * span).over(block)) for d in range(fanout - 1, 0, -1)
        ] + [
            F.when(slot + d < length, F.lead(node, d * span).over(block))
            for d in range(1, fanout)
        ]
        climbs = (at % span == 0) & (nodes > 1)
        out = out.withColumn("__around", F.array_compact(F.array(*around))).withColumns({
            f"__step_{level}": F.when(
                climbs, F.struct(slot.alias("slot"), F.col("__around").alias("siblings"))
            ),
            f"__node_{level + 1}": F.when(
                at % (span * fanout) == 0,
                F.when(climbs, parent(F.concat(F.array(node), F.col("__around"))))
                .otherwise(node),
            ),
        }).drop("__around")
    out = out.withColumn("__steps", F.array().cast(PATH))
    for level in reversed(range(levels)):
        span = fanout**level
        slot = (_over(at, span) % fanout).cast("int")
        inherited = F.coalesce(
            F.when(slot == 0, F.col("__steps")),
            *[
                F.when(slot == d, F.lag("__steps", d * span).over(block))
                for d in range(1, fanout)
            ],
        )
        step = F.col(f"__step_{level}")
        out = out.withColumn("__inherited", inherited).withColumn(
            "__steps",
            F.when(step.isNull(), F.col("__inherited"))
            .otherwise(F.concat(F.array(step), F.col("__inherited"))),
        ).drop("__inherited")
    return out.withColumn("__top", F.col(f"__node_{levels}")).select(
        *rows.columns, "__steps", "__top"
    )


def _descended(
    tables: list[DataFrame], above: DataFrame, fanout: int, levels: int,
    carried: tuple[str, ...], own: tuple[str, ...] = (),
) -> DataFrame:
    """The rows of the first table with their whole path, and the columns `carried`, which
    come from `above` or from the rows themselves."""
    for i, table in reversed(list(enumerate(tables))):
        mine = [*own] if i == 0 else []
        mine += [c for c in carried if c in table.columns]
        theirs = [c for c in carried if c in above.columns and c not in table.columns]
        higher = above.select(
            "__name", F.col("__at").alias("__block"), F.col("__path").alias("__higher"), *theirs
        )
        above = (
            table.withColumn("__block", _over(F.col("__at"), fanout**levels))
            .join(higher, ["__name", "__block"])
            .select(
                "__name", "__at", F.concat("__steps", "__higher").alias("__path"), *mine, *theirs
            )
        )
    return above
