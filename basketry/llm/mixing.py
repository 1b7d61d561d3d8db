"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

The mix has a fixed number of seats, blocks of ``block_words`` words. A source with target t has quotients t / (2k - 1), k = 1, 2, ...; seats go to the
highest quotients, ties to the source of lower code points, and the shards take the seats in that order, so every shard has an integer quota of
each source. A source's documents lie on a line of words in a seeded order; the line is dealt to the shards in proportion to their quotas, and each shard takes its quota
as blocks from a seeded one on, around its own stretch. A quota beyond the line's length first takes the whole line, once or more.
Sources shorter than a block don't compete: they give their target in words.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import lookup, materialize, running

WEIGHTS = (5, 2, 1)  # fixed values: the contract's weights, repeating
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words: the parts between white space that aren't empty (only the first and last may be)."""
    parts = F.split(text, SPACE, -1)
    edge = lambda p: F.when(p == "", 1).otherwise(0)
    return F.coalesce(F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + 1 - edge(p)), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Adds ``target`` to (source, source_size).

    All words are shared by weight; no target is above ``most`` times its source's size, and the excess is
    shared again by weight until none is. The end of that process is one level: min(cap, level * weight), found
    in one pass over the sources sorted by cap / weight. The window sees one row for each source.
    """
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_code) - 1) % len(weights) + 1)
    s = sizes.withColumn("_w", weight.cast("double")).withColumn("_cap", (F.col("source_size") * most).cast("double"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    s = s.withColumns({
        "_total": F.sum("source_size").over(every).cast("double"),
        "_full": F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_left": F.sum("_w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    s = s.withColumn("_level", (F.col("_total") - F.col("_full")) / F.col("_left"))
    level = F.max(F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.col("_level"))).over(every)
    return s.withColumn("_at", level).select(
        "source", "source_size",
        F.when(F.col("_at").isNull() | (F.col("_cap") <= F.col("_at") * F.col("_w")), F.col("_cap")).otherwise(F.col("_at") * F.col("_w")).alias("target"))


def quotas(goals: DataFrame, shards: int = 8, block_words: int = 16) -> DataFrame:
    """(source, source_size, target, upto): ``upto`` has each source's seats after shard 0, 1, ... of the seats dealt by highest quotients.

    The n highest quotients are found without listing them: a source has between t (n - m / 2) / T and t (n + m / 2) / T seats, rounded, of n seats
    among m sources whose targets sum to T; only the quotients in between are ranked, about two for each source and shard.
    """
    every = Window.partitionBy(F.lit(0))
    big = goals.where(F.col("source_size") >= block_words).select(
        "*", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("_nth"),
        F.sum(F.col("target").cast("decimal(38,6)")).over(every).cast("double").alias("_sum"), F.count(F.lit(1)).over(every).alias("_m"))
    big = big.withColumn("_seats", F.floor(F.col("_sum") / block_words + 0.5).cast("long"))
    big = big.withColumn("_shard", F.explode(F.sequence(F.lit(1), F.lit(shards)))).withColumn("_n", F.expr(f"_shard * _seats div {shards}"))
    near = lambda n: F.floor(F.col("target") * n / F.col("_sum") + 0.5).cast("long")
    big = big.withColumn("_low", F.greatest(near(F.col("_n") - F.col("_m") / 2) - 1, F.lit(0))).withColumn("_high", near(F.col("_n") + F.col("_m") / 2) + 1)
    big = big.withColumn("_open", F.col("_n") - F.sum("_low").over(Window.partitionBy("_shard")))
    asked = big.withColumn("_k", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))))
    order = Window.partitionBy("_shard").orderBy(F.desc(F.col("target") / (2 * F.col("_k") - 1)), "_nth", "_k")
    won = asked.withColumn("_won", F.row_number().over(order) <= F.col("_open")).groupBy("source", "source_size", "target", "_shard").agg(
        (F.min("_low") + F.count(F.when(F.col("_won"), True))).alias("_seats"))
    held = won.groupBy("source", "source_size", "target").agg(F.array_sort(F.collect_list(F.struct("_shard", "_seats"))).alias("_s"))
    own = held.select("source", "source_size", "target", F.transform("_s", lambda x: x["_seats"]).alias("upto"))
    none = goals.where(F.col("source_size") < block_words).select("source", "source_size", "target", F.array_repeat(F.lit(0).cast("long"), shards).alias("upto"))
    return own.unionByName(none)


def allocation(goals: DataFrame, block_words: int, shards: int, seed: int) -> DataFrame:
    """(source, source_size, target, rounds, runs): how often the whole line is taken, and the stretches of words [lo, hi) taken once more, in order."""
    q = materialize(quotas(goals, shards, block_words))
    small = F.col("source_size") < block_words
    all_seats = F.element_at("upto", -1)
    words = F.least(F.when(small, F.floor(F.col("target") + 0.5).cast("long")).otherwise(all_seats * block_words), F.col("source_size") * 3)
    q = q.withColumn("_words", words).withColumn("rounds", F.coalesce(F.expr("_words div nullif(source_size, 0)"), F.lit(0)).cast("long"))
    q = q.withColumn("_rest", F.col("_words") - F.col("rounds") * F.col("source_size")).withColumn("_all", F.greatest(all_seats, F.lit(1)))
    # a short source's words go to the last shard
    q = q.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    seats = lambda at: F.when(F.col("_shard") + at == shards, F.col("_all")).when(F.col("_shard") + at == 0, 0).otherwise(
        F.get("upto", F.col("_shard") + (at - 1))).cast("long")
    q = q.withColumns({"_a0": seats(0), "_a1": seats(1)})
    part = lambda c: F.expr(f"cast(_rest AS decimal(38,0)) * {c} div _all")
    q = q.withColumns({"_r0": part("_a0"), "_r1": part("_a1")})
    edge = lambda c: F.coalesce(F.expr(f"cast(source_size AS decimal(38,0)) * {c} div nullif(_rest, 0)"), F.lit(0))
    q = q.withColumns({"_e0": edge("_r0"), "_e1": edge("_r1")})
    q = q.withColumns({"_len": F.col("_e1") - F.col("_e0"), "_take": F.col("_r1") - F.col("_r0")})
    code = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce("source", F.lit("")), F.col("_shard"))), 1, 12), 16, 10).cast("long")
    start = F.pmod(code, F.greatest(F.ceil(F.col("_len") / block_words).cast("long"), F.lit(1))) * block_words
    q = q.withColumn("_u", start)
    span = lambda lo, hi: F.struct(lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    runs = F.array(span(F.col("_e0"), F.col("_e0") + F.greatest(F.col("_u") + F.col("_take") - F.col("_len"), F.lit(0))),
                   span(F.col("_e0") + F.col("_u"), F.col("_e0") + F.least(F.col("_u") + F.col("_take"), F.col("_len"))))
    # two runs for each of a source's shards
    out = q.groupBy("source", "source_size", "target", "rounds").agg(F.array_sort(F.flatten(F.collect_list(runs))).alias("_runs"))
    return out.select("source", "source_size", "target", "rounds", touching(F.filter("_runs", lambda r: r["hi"] > r["lo"])).alias("runs"))


def touching(runs: Column) -> Column:
    """Ordered runs, those that touch made one."""
    def step(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joins = F.coalesce(last["hi"] == r["lo"], F.lit(False))
        longer = F.array(F.struct(last["lo"].alias("lo"), r["hi"].alias("hi")))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), longer)).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(runs, F.array().cast("array<struct<lo:bigint,hi:bigint>>"), step)


def on_lines(rows: DataFrame, seed: int) -> DataFrame:
    """Adds ``start`` to (doc_id, source, size, mark, ...): each document's place on its source's line of words, in an order of hashes of id and text."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("mark")))
    rows = rows.withColumn("_key", (F.conv(F.substring(key, 1, 15), 16, 10).cast("long") - (1 << 59)) * 16)
    ties = [c for c in ("doc_id", "size", "other") if c in rows.columns]
    return running(materialize(rows), ["source"], "_key", ties, before={"start": "size"}).drop("_key")


def place(rows: DataFrame, block_words: int = 16, weights: tuple[int, ...] = WEIGHTS, shards: int = 8, seed: int = 4) -> DataFrame:
    """Adds source_size, target, rounds and runs to (doc_id, source, size, mark, ...): how often the mix takes the whole document, and the
    words [a, b) that it takes once more."""
    lines = materialize(on_lines(rows, seed))
    goals = materialize(targets(lines.groupBy("source").agg(F.sum("size").alias("source_size")), weights))
    plan = materialize(allocation(goals, block_words, shards, seed).withColumnsRenamed({"source": "_source", "runs": "_runs"}))
    out = lookup(lines, plan, {"source": "_source"})
    end = F.col("start") + F.col("size")
    mine = F.filter("_runs", lambda r: (r["lo"] < end) & (r["hi"] > F.col("start")))
    cut = F.transform(mine, lambda r: F.struct((F.greatest(r["lo"], F.col("start")) - F.col("start")).alias("a"), (F.least(r["hi"], end) - F.col("start")).alias("b")))
    return out.withColumn("runs", cut).drop("_runs", "start")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per row of ``docs``.

    A null or empty text has size 0 and is never taken; a null source is a source of its own, last in order. Repeated rows and ids are
    documents of their own; rows with the same doc_id and text are interchangeable. Very long texts are cut like others. An empty table gives
    an empty result, other columns are ignored.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(text).alias("size"),
                       F.md5(F.coalesce(text, F.lit(""))).alias("mark"))
    more = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["b"] - r["a"])
    return place(rows, **options).select("doc_id", "size", "source_size", "target", (F.col("rounds") * F.col("size") + more).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str = "n_chars", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: every document once for each time it is taken whole, then copies with the words
    taken once more (each shard cuts at most four documents of a source). ``length_col``, if there, is counted anew for cut copies.

    Null texts, empty ones and those without words are there once for each whole round of their source; null ids and sources are values like others. Rows alike
    in id and text are interchangeable, repeated rows are documents of their own. An empty table gives an empty result. Columns may have any
    name and type: the row travels as one value.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/mixed-{uuid.uuid4().hex}"
    # the rows' numbers hold once they are written
    docs.select(F.monotonically_increasing_id().alias("nr"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).write.parquet(folder)
    kept = spark.read.parquet(folder)
    of = lambda c: F.col("row").getField(c)
    rest = [of(c) for c in docs.columns if c != text_col]
    rows = kept.select("nr", of(id_col).alias("doc_id"), of(source_col).alias("source"), word_count(of(text_col)).alias("size"),
                       F.md5(F.coalesce(of(text_col), F.lit(""))).alias("mark"), F.xxhash64(F.to_json(F.struct(*rest))).alias("other"))
    span = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    plan = place(rows, **options).select("nr", "size", F.concat(F.array_repeat(span(F.lit(0), F.col("size")), F.col("rounds").cast("int")), "runs").alias("copies"))
    out = kept.join(plan.where(F.size("copies") > 0), "nr").select("row", "size", F.explode("copies").alias("c"))
    words = F.split(F.regexp_replace(of(text_col), f"^{SPACE}", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1)
    cut = F.array_join(F.slice(words, (F.col("c.a") + 1).cast("int"), (F.col("c.b") - F.col("c.a")).cast("int")), "")
    uncut = (F.col("c.a") == 0) & (F.col("c.b") == F.col("size"))
    out = out.select("row", uncut.alias("uncut"), F.when(uncut, of(text_col)).otherwise(cut).alias("new"))
    new = {text_col: F.col("new")}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("uncut"), of(length_col)).otherwise(F.length("new")).cast(docs.schema[length_col].dataType)
    return out.select(*(new.get(c, of(c)).alias(c) for c in docs.columns))
