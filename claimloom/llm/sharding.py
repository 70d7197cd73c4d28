"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows each partition sends to each shard is drawn first, exactly as a uniform permutation
would: multivariate hypergeometric counts. Then rows are permuted inside their partition and cut
by those counts, exchanged, and permuted again inside their shard. Everything is DataFrame
expressions; draws are inversions of the exact distribution from hashed uniforms, so a rerun or a
retried task gives the same rows.

For n rows there are about sqrt(n) partitions of sqrt(n) rows. Their counts are drawn in two
levels, for groups of partitions and then inside each group, so no task draws for all of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import saved

LONGS = "array<bigint>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _long(value: Column | int) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("long")


def _uniform(*parts: Column | int) -> Column:
    """In [0, 1), from a hash of the parts."""
    bits = F.xxhash64(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    return F.shiftrightunsigned(bits, 11) * F.lit(2.0**-53)


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``drawn`` rows out of ``total`` are ``marked``, by inversion from the mode.

    Probabilities are relative to the mode's, by their recurrence; beyond eight standard
    deviations and twelve rows they are below the precision of a double.
    """
    n, k, d = (c.cast("double") for c in (total, marked, drawn))
    spread = F.sqrt(F.greatest(d * k / n * (n - k) / n * (n - d) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0)))
    reach = _long(F.ceil(spread * 8) + 12)
    least = F.greatest(_long(0), drawn + marked - total)
    most = F.least(drawn, marked)
    mode = F.least(F.greatest(_long(F.floor((d + 1) * (k + 1) / (n + 2))), least), most)

    def up(x: Column) -> Column:
        """Probability of x + 1 relative to x."""
        return (k - x) * (d - x) / ((x + 1) * (n - k - d + x + 1))

    def down(x: Column) -> Column:
        return x * (n - k - d + x) / ((k - x + 1) * (d - x + 1))

    def states(first: Column, last: Column, step: int) -> Column:
        empty = F.array().cast(LONGS)
        steps = (last - first) if step > 0 else (first - last)
        return F.when(steps > 0, F.sequence(first, last - step, _long(step))).otherwise(empty)

    def mass(xs: Column, ratio: Callable[[Column], Column]) -> Column:
        """The sum of the probabilities after the mode's, relative to it."""

        def add(state: Column, x: Column) -> Column:
            return _let(
                state["p"] * ratio(x.cast("double")),
                lambda p: F.struct(p.alias("p"), (state["sum"] + p).alias("sum")),
            )

        return F.aggregate(xs, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum")), add)["sum"]

    def walk(xs: Column, start: Column, step: int, ratio: Callable, rest: Column) -> Column:
        """The state at which the probabilities reach ``rest``."""

        def add(state: Column, x: Column) -> Column:
            return _let(
                state["p"] * ratio(x.cast("double")),
                lambda p: F.struct(
                    p.alias("p"),
                    (state["rest"] - p).alias("rest"),
                    F.when(state["rest"] > 0, x + step).otherwise(state["at"]).alias("at"),
                ),
            )

        first = F.struct(F.lit(1.0).alias("p"), rest.alias("rest"), start.alias("at"))
        return F.aggregate(xs, first, add)["at"]

    def draw(s: Column) -> Column:
        ups = states(s["mode"], F.least(s["most"], s["mode"] + s["reach"]), 1)
        downs = states(s["mode"], F.greatest(s["least"], s["mode"] - s["reach"]), -1)

        def pick(m: Column) -> Column:
            target = uniform * (m["up"] + m["down"] + 1)
            above = target - 1
            return F.when(above < m["up"], walk(ups, s["mode"], 1, up, above)).otherwise(
                walk(downs, s["mode"], -1, down, above - m["up"])
            )

        return _let(F.struct(mass(ups, up).alias("up"), mass(downs, down).alias("down")), pick)

    bounds = F.struct(
        least.alias("least"), most.alias("most"), mode.alias("mode"), reach.alias("reach")
    )
    return F.when(least >= most, least).otherwise(_let(bounds, draw))


def multivariate(room: Column, drawn: Column, seed: tuple) -> Column:
    """Rows for each shard, of ``drawn`` rows dealt to shards with ``room`` left."""

    def deal(state: Column, at: Column) -> Column:
        here = F.element_at(room, at.cast("int"))
        count = F.when(
            state["rows"] > 0, hypergeometric(state["room"], here, state["rows"], _uniform(*seed, at))
        ).otherwise(_long(0))
        return _let(
            count,
            lambda x: F.struct(
                (state["rows"] - x).alias("rows"),
                (state["room"] - here).alias("room"),
                F.concat(state["out"], F.array(x)).alias("out"),
            ),
        )

    first = F.struct(
        drawn.alias("rows"),
        F.aggregate(room, _long(0), lambda a, b: a + b).alias("room"),
        F.array().cast(LONGS).alias("out"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.size(room)), first, deal)["out"]


def _deal_to(parts: Column, room: Column, seed: tuple) -> Column:
    """``parts`` (``part, rows``) in turn, each dealt to the room that is left."""

    def deal(state: Column, part: Column) -> Column:
        return _let(
            multivariate(state["room"], part["rows"], (*seed, part["part"])),
            lambda counts: F.struct(
                F.zip_with(state["room"], counts, lambda a, b: a - b).alias("room"),
                F.concat(
                    state["out"], F.array(F.struct(part["part"].alias("part"), counts.alias("counts")))
                ).alias("out"),
            ),
        )

    first = F.struct(
        room.alias("room"),
        F.array().cast("array<struct<part:bigint,counts:array<bigint>>>").alias("out"),
    )
    return F.aggregate(parts, first, deal)["out"]


def communication_matrix(sizes: DataFrame, shards: int, total: int, groups: int, seed: int) -> DataFrame:
    """``part, counts``: the rows each partition of ``sizes`` (``part, rows``) sends to each shard.

    Shards get ``total`` rows in all, their sizes at most one apart.
    """
    room = F.array(*(_long(total // shards + (s < total % shards)) for s in range(shards)))
    grouped = (
        sizes.withColumn("grp", F.pmod("part", _long(groups)))
        .groupBy("grp")
        .agg(
            F.sum("rows").alias("rows"),
            F.sort_array(F.collect_list(F.struct("part", "rows"))).alias("parts"),
        )
    )
    # One row: the groups' totals only.
    top = (
        grouped.agg(
            F.sort_array(F.collect_list(F.struct(F.col("grp").alias("part"), "rows"))).alias("groups")
        )
        .select(F.explode(_deal_to(F.col("groups"), room, (seed, 1))).alias("g"))
        .select(F.col("g.part").alias("grp"), F.col("g.counts").alias("room"))
    )
    # A number of its own: the few bytes of a group do not tell how long its draws take.
    return (
        grouped.join(top, "grp")
        .repartition(max(1, groups // 4), "grp")
        .select(F.explode(_deal_to(F.col("parts"), F.col("room"), (seed, 2))).alias("m"))
        .select("m.part", "m.counts")
    )


def shuffle_into_shards(rows: DataFrame, shards: int = 40, seed: int = 42) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in its shard).

    A uniform permutation cut into shards whose sizes are at most one apart. Rows are told apart
    by their place in the input, so NULLs, repeated rows and hot values have no effect. The rows
    are stored in the shared folder first, so their places stay as they are. An empty table gives
    no rows. Columns named ``shard`` or ``slot`` are replaced.
    """
    kept = rows.drop("shard", "slot")
    base = saved(
        kept.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("seq")),
        "rows",
    )
    total = base.count()
    parts = max(1, math.isqrt(total))
    groups = max(1, math.isqrt(parts))
    placed = base.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "seq"), _long(parts)))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    matrix = communication_matrix(sizes, shards, total, groups, seed).select(
        "part",
        F.transform(
            F.sequence(F.lit(1), F.lit(shards)),
            lambda n: F.aggregate(F.slice("counts", 1, n), _long(0), lambda a, b: a + b),
        ).alias("ends"),
    )
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed + 1), "seq"), "seq")
    rank = (F.row_number().over(local) - 1).cast("long")
    blocks = max(1, math.isqrt(total // shards))
    dealt = saved(
        placed.withColumn("rank", rank)
        .join(matrix, "part")
        .select(
            "row",
            "seq",
            F.size(F.filter("ends", lambda end: end <= F.col("rank"))).alias("shard"),
            F.pmod(F.xxhash64(F.lit(seed + 2), "seq"), _long(blocks)).alias("block"),
        ),
        "dealt",
    )
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), _long(0)).alias("start")
    )
    inside = Window.partitionBy("shard", "block").orderBy(F.xxhash64(F.lit(seed + 3), "seq"), "seq")
    return (
        dealt.withColumn("nth", F.row_number().over(inside))
        .join(starts, ["shard", "block"])
        .select("row.*", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"))
    )


def shard_documents(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", seed: int = 42
) -> DataFrame:
    """``<id>, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    ``size`` is the UTF-8 bytes of the text (NULL: none) plus 16. The law is ``rows``: shard sizes
    are at most one apart; ``grown_shard`` is NULL. See ``shuffle_into_shards`` for odd inputs.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        id_col,
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shuffle_into_shards(narrow, shards, seed).select(
        id_col,
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
