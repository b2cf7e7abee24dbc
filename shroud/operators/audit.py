"""Access audit (A11) and lineage tag propagation (A12). The reference only names both;
their inputs (an access log, a column lineage graph) are taken as relations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.written import written


def audit_summary(access_log: DataFrame, current_tags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reads of tables holding tagged columns, per principal and tag.

    ``access_log`` is (principal, table_id) per read. Reads are pre-aggregated per
    (principal, table) before the join, so a table read a billion times is one row per
    reader when it meets the tag side; the join then multiplies by the few tags a table
    carries. Reads are unique per (principal, table) and tags per (table, key, value), so a plain
    count gives the tables."""
    reads = access_log.groupBy("principal", "table_id").agg(F.count(F.lit(1)).alias("n"))
    sens = (current_tags.where(F.col("key").isin(list(keys)))
            .select("table_id", F.col("key").alias("tag_key"), F.col("value").alias("tag_value")).distinct())
    return (reads.join(sens, "table_id")
            .groupBy("principal", "tag_key", "tag_value")
            .agg(F.sum("n").alias("n_reads"), F.count(F.lit(1)).alias("n_tables")))


def propagate_tags(edges: DataFrame, seed: DataFrame) -> DataFrame:
    """Push column tags along lineage edges to a fixpoint.

    ``edges`` (src_table, src_column, dst_table, dst_column); ``seed`` (table_id,
    column_name, key, value). Columns and tags get numbers once; the tags of a column are
    bits, 62 to a mask, so a round moves masks and not facts.

    Columns fed by one other column follow it to the column at the head of their chain: their
    pointers double each round, so a chain of n steps, or a ring, takes about log2(n) rounds, and
    only columns that have not met their head take part.
    What is left are columns with several feeders; edges into them start at chain heads, and
    only masks with new bits move on, one contracted edge a round. Last, chains below such a column take
    over its tags. Rounds end when one adds nothing; each is a table in the shared folder."""
    edges, seed = written(edges), written(seed.select("table_id", "column_name", "key", "value").distinct())
    columns, number, key = _numbered(edges, seed)
    tags = written(seed.select("key", "value").distinct().withColumn("id", F.monotonically_increasing_id())).select(
        "key", "value", F.floor(F.col("id") / 62).alias("block"), F.expr("shiftleft(1L, cast(pmod(id, 62) AS int))").alias("bit"))
    links = number(number(edges, "src_table", "src_column", "src"), "dst_table", "dst_column", "dst").select("src", "dst").where(F.col("src") != F.col("dst"))
    own = number(seed.where(F.col("table_id").isNotNull() & F.col("column_name").isNotNull()), "table_id", "column_name", "id").join(tags, ["key", "value"])
    masks = (own.select("id", "block", "bit").repartition("id").groupBy("id", "block").agg(F.bit_or("bit").alias("mask"))
             .groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("block", "mask"))).alias("masks")))
    feeders = links.groupBy(F.col("dst").alias("id")).agg(F.min("src").alias("lo"), F.max("src").alias("hi"))
    nodes = written(feeders.join(masks, "id", "full").select(
        "id", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("up"), F.coalesce(F.col("lo") != F.col("hi"), F.lit(False)).alias("joint"), "masks"))

    chains = _follow_chains(nodes)
    facts = chains.select("id", F.explode("masks").alias("block", "mask"))
    fed = chains.where("joint AND up IS NOT NULL").select("id", "up")  # below a column with several feeders
    several = nodes.where("joint").select("id")
    joints = written(links.join(several.withColumnRenamed("id", "dst"), "dst", "left_semi").distinct())
    short = joints.join(fed.withColumnRenamed("id", "src"), "src").select(F.col("up").alias("src"), "dst").unionByName(
        joints.join(several.withColumnRenamed("id", "src"), "src", "left_semi"))
    short = written(short.where(F.col("src") != F.col("dst")).distinct())
    # only the ends of these edges take part in the rounds: few beside all columns
    ends = joints.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    core = written(facts.join(ends, "id", "left_semi"))
    delta, along = core, joints
    while True:
        step = delta.join(along, delta.id == along.src).select(F.col("dst").alias("id"), "block", "mask")
        core, delta = _merged(core, step)
        if delta.isEmpty():
            break
        along = short
    below = fed.join(core.withColumnRenamed("id", "up"), "up").select("id", "block", "mask")  # what heads had before has come down
    facts = facts.unionByName(core).unionByName(below).repartition("id").groupBy("id", "block").agg(F.bit_or("mask").alias("mask"))
    return (facts.join(columns, F.col("id") == key).join(tags, "block").where(F.col("mask").bitwiseAND(F.col("bit")) != 0)
            .select("table_id", "column_name", "key", "value"))


def _hashed(table: str, column: str) -> Column:
    return F.xxhash64(table, column, F.col(table).isNull(), F.col(column).isNull())  # a null alone leaves no trace in a hash


def _numbered(edges: DataFrame, seed: DataFrame) -> tuple[DataFrame, Callable[[DataFrame, str, str, str], DataFrame], Column]:
    """Every column by name, the step that gives a relation the id of the column two of its columns name, and the id in
    the first. The id is a hash, worked out in place, if no two columns have the same; else numbers are joined to names."""
    ends = edges.select(F.explode(F.array(*[F.struct(F.col(f"{e}_table").alias("table_id"), F.col(f"{e}_column").alias("column_name"))
                                            for e in ("src", "dst")])).alias("c")).select("c.*")
    columns = written(ends.unionAll(seed.select("table_id", "column_name")).distinct())
    if columns.groupBy(_hashed("table_id", "column_name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return columns, lambda df, table, column, name: df.withColumn(name, _hashed(table, column)), _hashed("table_id", "column_name")
    # the numbers follow the partitions: fixed by writing them
    columns = written(columns.withColumn("number", F.monotonically_increasing_id()))
    keyed = columns.select(F.struct("table_id", "column_name").alias("c"), "number")

    def number(df: DataFrame, table: str, column: str, name: str) -> DataFrame:
        named = df.withColumn("c", F.struct(F.col(table).alias("table_id"), F.col(column).alias("column_name")))
        return named.join(keyed.withColumnRenamed("number", name), "c").drop("c")
    return columns, number, F.col("number")


def _merged(facts: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """facts with more masks, and the masks of those that got bits they lacked."""
    both = facts.select("id", "block", "mask", F.col("mask").alias("old")).unionAll(more.select("id", "block", "mask", F.lit(0).cast("long")))
    both = written(both.groupBy("id", "block").agg(F.bit_or("mask").alias("mask"), F.bit_or("old").alias("old")))
    return both.select("id", "block", "mask"), both.where(F.col("mask") != F.col("old")).select("id", "block", "mask")


def _follow_chains(nodes: DataFrame) -> DataFrame:
    """nodes(id, up, joint, masks): ``up`` is the feeder of a column with one feeder, else null; ``masks`` by block.
    Returns them with the masks of all columns above; below a head that has several feeders ``joint`` is set and ``up`` is
    that head. A column is written once a round until it has met its head; those that have are only read."""
    state = ["id", "up", "joint", "masks"]
    done, going = nodes.where(F.col("up").isNull()), nodes.where(F.col("up").isNotNull())
    open_before = None
    while True:
        above = done.select(*state, F.lit(False).alias("more")).unionByName(going.select(*state, F.lit(True).alias("more"))).select(
            F.col("id").alias("up"), F.col("up").alias("upper"), F.col("joint").alias("fed"), F.col("masks").alias("theirs"), "more")
        union = F.map_zip_with("masks", "theirs", lambda _, x, y: F.coalesce(x, F.lit(0).cast("long")).bitwiseOR(F.coalesce(y, F.lit(0).cast("long"))))
        moved = going.join(above, "up", "left").select(
            "id", F.when(F.col("more") | F.col("fed"), F.coalesce("upper", "up")).alias("up"), F.coalesce("fed", F.lit(False)).alias("joint"), F.col("masks").alias("had"),
            F.when(F.col("theirs").isNull(), F.col("masks")).when(F.col("masks").isNull(), F.col("theirs")).otherwise(union).alias("masks"),
            F.coalesce("more", F.lit(False)).alias("open"))
        moved = written(moved.withColumn("grew", F.col("open") & (_bits("masks") > _bits("had"))).drop("had"))
        still, grown = moved.agg(F.count_if("open"), F.count_if("grew")).first()
        done, going = done.unionByName(moved.where(~F.col("open")).select(*state)), moved.where("open").select(*state)
        # none open: all have met their heads; rings stay open, until a round adds nothing to them
        if not still or still == open_before and not grown:
            return done.unionByName(going)
        open_before = still


def _bits(masks: str) -> Column:
    return F.coalesce(F.aggregate(F.map_values(masks), F.lit(0), lambda n, x: n + F.bit_count(x)), F.lit(0))
