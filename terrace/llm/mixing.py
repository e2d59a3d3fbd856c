"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is cut into blocks of about ``rows_per_block`` documents by a hash
of the row, so blocks need no shuffle of texts. A source's target in words is
met by whole passes over its blocks, then by the blocks that come first under
a Feistel permutation, then by documents of the next few blocks, largest first,
down to the nearest document. Where those hold less than the room that is left
(a very long document did not fit), documents longer than half of the room are
left out and the blocks are taken further down the order, as often as needed; the
room halves each time. If the order ends first, a long document is taken in place
of others. Block quotas are split over the output shards
by a tree: a node splits its exact quota vector between its two halves by a
multivariate-hypergeometric draw, so every shard gets a fair random mix and
the quotas add up exactly. A shard's quota of a source is a run of that
source's draws, so shards draw disjoint blocks; inside a shard, ``order``
shuffles the rows.

The driver holds one line per source (``MAX_SOURCES`` is checked, with a clear
error) and never rows, blocks or documents.

Defined cases: null text is empty (size 0: taken 0); null source is a source
of its own, sorted last; repeated rows stand for themselves; an empty table
gives none; a source without words has target 0. Input columns named ``size``,
``source_size``, ``target``, ``shards`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.feistel import permute, round_keys
from terrace.llm.tables import stored, totals_before

SEED = 977
MAX_SOURCES = 100_000
FILL_BLOCKS = 8
#: how far off its target a source may end, as a share, before a longer document is taken instead of others
FAR = 0.001
#: numpy draws hypergeometric numbers from populations below 10**9; larger ones are cut into parts
MAX_DRAWS = 900_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: np.ndarray, weights: np.ndarray, most: float) -> np.ndarray:
    """Shares of the total by weight, none above ``most`` times its size; the excess is reshared by weight."""
    limit, total = most * sizes, float(sizes.sum())
    out, free = np.zeros(len(sizes)), sizes > 0
    while free.any():
        level = (total - out[~free].sum()) / weights[free].sum()
        above = free & (level * weights > limit)
        if not above.any():
            out[free] = level * weights[free]
            break
        out[above] = limit[above]
        free &= ~above
    return out


def drawn_from(quota: np.ndarray, n: int, rng: np.random.Generator, most: int = MAX_DRAWS) -> np.ndarray:
    """A multivariate-hypergeometric draw of ``n`` out of ``quota``.

    Over ``most`` in all (more than numpy draws from), ``quota`` is cut into equal parts, each with its share of
    ``n``, and the parts' draws add up: the counts stay exact, and vary no more than those of one draw.
    """
    total = int(quota.sum())
    parts = max(1, -(-total // most))
    out, done = np.zeros_like(quota), 0
    for k in range(parts):
        part = quota * (k + 1) // parts - quota * k // parts
        upto = done + int(part.sum())
        out += rng.multivariate_hypergeometric(part, n * upto // total - n * done // total if total else 0, method="marginals")
        done = upto
    return out


def split_tree(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """(shards, sources): exact block quotas; shard totals differ by one at most."""
    out = np.zeros((shards, len(quotas)), np.int64)
    total = int(quotas.sum())
    cut = [total * s // shards for s in range(shards + 1)]
    todo = [(0, shards, quotas.astype(np.int64), 1)]
    while todo:
        lo, hi, quota, node = todo.pop()
        if hi - lo == 1:
            out[lo] = quota
            continue
        mid = (lo + hi) // 2
        left = drawn_from(quota, cut[mid] - cut[lo], np.random.default_rng([seed, node]))
        todo += [(lo, mid, left, 2 * node), (mid, hi, quota - left, 2 * node + 1)]
    return out


def greedy_fill(sizes: np.ndarray, room: int) -> np.ndarray:
    """Which of ``sizes`` (descending) to take to come nearest to ``room`` from below, then one past it if nearer."""
    take = np.zeros(len(sizes), bool)
    for i, size in enumerate(sizes):
        if 0 < size <= room:
            take[i], room = True, room - size
    rest = np.flatnonzero(~take & (sizes > 0))
    if len(rest) and room:
        best = rest[np.argmin(sizes[rest])]
        take[best] = sizes[best] - room < room
    return take


class Plan:
    """What every row needs: per source (in code point order, null last) blocks, passes, quota and shard bounds."""

    def __init__(self, sources: pd.DataFrame, most: float, weights: tuple, rows_per_block: int):
        n = len(sources)
        sizes = sources["words"].to_numpy(np.int64)
        self.names = sources["source"].tolist()
        self.target = targets(sizes, np.array([weights[i % len(weights)] for i in range(n)], float), most)
        self.sizes = sizes
        rows = sources["n"].to_numpy(np.int64)
        self.blocks = np.maximum(1, -(-rows // rows_per_block))
        aim = np.minimum(np.rint(self.target).astype(np.int64), (most * sizes).astype(np.int64))
        self.passes = np.where(sizes > 0, aim // np.maximum(sizes, 1), 0)
        self.rest = np.where(sizes > 0, aim - self.passes * sizes, 0)
        #: of the last, partial pass, per source: places from, places to, longest document taken there
        self.legs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.room = self.rest.copy()  # words left for the fill
        self.bounds: np.ndarray | None = None

    def position(self, sid: np.ndarray, block: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """Place of a block in its source's order of pass ``turn``."""
        out = np.zeros(len(sid), np.int64)
        for s, t in {*zip(sid.tolist(), turn.tolist())}:
            own = (sid == s) & (turn == t)
            out[own] = permute(block[own], int(self.blocks[s]), round_keys(SEED, s, t))
        return out


def _tagged(docs: DataFrame, plan: Plan) -> DataFrame:
    """``docs`` plus ``__sid`` and ``__block``; the table of sources is joined, one row per source."""
    spark = docs.sparkSession
    rows = [(name, i, int(plan.blocks[i])) for i, name in enumerate(plan.names)]
    known = F.broadcast(spark.createDataFrame(rows, "__source string, __sid int, __blocks long"))  # MAX_SOURCES rows at most
    return (
        docs.join(known, F.col("source").cast("string").eqNullSafe(F.col("__source")))
        .withColumn("__block", F.pmod(F.col("__key"), F.col("__blocks")))
        .drop("__source", "__blocks")
    )


def _sized(docs: DataFrame) -> DataFrame:
    """``__key`` is a hash of id and text: what rows are dealt into blocks by."""
    return docs.withColumns(
        {"__size": word_count(F.col("text")), "__key": F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text"))}
    )


def _with_positions(df: DataFrame, plan: Plan, turn: np.ndarray) -> DataFrame:
    """(__sid, __block, words) plus ``__pos`` in the pass ``turn[sid]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            pos = plan.position(sid, block, turn[sid])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pos)], names=[*batch.schema.names, "__pos"])

    return df.mapInArrow(run, "__sid int, __block long, words long, __pos long")


def _per_source(spark, sids: np.ndarray, **values: np.ndarray) -> DataFrame:
    """One row per source of ``sids`` (``MAX_SOURCES`` at most): ``__sid`` and long columns."""
    rows = [(int(i), *(int(v[i]) for v in values.values())) for i in np.flatnonzero(sids)]
    return F.broadcast(spark.createDataFrame(rows, ", ".join(["__sid int", *(f"{c} long" for c in values)])))


def _legs(every: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """Sets the legs and the room of ``plan``; (__sid, __key, size) of candidates of the fill, and of documents taken anyhow.

    A leg takes, from a place in the order on, the documents up to a length, as many blocks as fit. A source needs no
    further leg once the documents that fit, of the next ``FILL_BLOCKS`` blocks, make up its room. Where the order ends
    first and the source is more than ``FAR`` off, the next longer document left out is taken and the source begins anew.
    """
    spark, n, kinds = every.sparkSession, len(plan.names), "__sid int, __key long, size long"
    tagged, none = every, spark.createDataFrame([], kinds)
    fixed: list[tuple[int, int, int]] = []
    extremes: dict[int, list] = {}
    nears: list[tuple[DataFrame, np.ndarray]] = []  # and the sources whose last leg it belongs to
    start, top, active = np.zeros(n, np.int64), plan.rest.copy(), plan.rest > 0
    while active.any():
        leg = _per_source(spark, active, __start=start, __top=top)
        kept = tagged.join(leg, "__sid").where("size <= __top")
        words = kept.groupBy("__sid", "__block").agg(F.sum("size").alias("words"))
        placed = _with_positions(words, plan, plan.passes).join(leg, "__sid").where("__pos >= __start")
        placed = placed.select("__sid", "__block", "words", "__pos")
        ordered = stored(
            totals_before(placed, [F.col("__sid"), F.col("__pos")], "words", f"mix-blocks-{len(plan.legs)}"),
            f"mix-order-{len(plan.legs)}",
        )
        limit, to, taken = np.zeros(n, np.int64), np.where(active, plan.blocks, 0), np.zeros(n, np.int64)
        for sid, before in ordered.groupBy("__sid").agg(F.min("__before")).collect():
            limit[sid] = before + plan.room[sid]
        fits = F.col("__before") + F.col("words") <= F.col("__limit")
        ends = ordered.join(_per_source(spark, active, __limit=limit), "__sid").groupBy("__sid")
        for sid, end, sum_ in ends.agg(F.min(F.when(~fits, F.col("__pos"))), F.sum(F.when(fits, F.col("words")))).collect():
            to[sid], taken[sid] = plan.blocks[sid] if end is None else end, sum_ or 0
        plan.legs.append((np.where(active, start, 0), to, np.where(active, top, 0)))
        plan.room = plan.room - taken
        edge = _per_source(spark, active, __to=to, __room=plan.room)
        near = ordered.join(edge, "__sid").where(f"__pos >= __to and __pos < __to + {FILL_BLOCKS}")
        near = stored(
            _units(tagged.join(F.broadcast(near.select("__sid", "__block")), ["__sid", "__block"])),
            f"mix-near-{len(plan.legs)}",
        )
        have = np.zeros(n, np.int64)
        for sid, total in near.join(edge, "__sid").where("size <= __room").groupBy("__sid").agg(F.sum("size")).collect():
            have[sid] = total
        more = active & (plan.room > 1) & (have < plan.room) & (to < plan.blocks)
        nears.append((near, active & ~more))
        # no block fits where copies of one row are more than the room: go on behind them
        start = np.where(more, np.where(to > start, to, to + 1), 0)
        active, top = more, plan.room // 2
        if more.any():
            continue
        # where the order has come to its end: of the documents left out, the longest that fits and the next longer
        at_end = np.any([to >= plan.blocks for _, to, _ in plan.legs], axis=0)
        ended = (plan.rest > 0) & (plan.room > 0) & at_end
        extremes = {sid: (fits, over) for sid, fits, over in _left_out(tagged, plan, ended)} if ended.any() else {}
        for sid, (_, over) in extremes.items():
            if over is None or over["size"] > plan.rest[sid]:
                continue
            if min(plan.room[sid], over["size"] - plan.room[sid]) > FAR * plan.target[sid]:
                fixed.append((sid, over["__key"], over["size"]))
                plan.rest[sid] -= over["size"]
                start[sid] = 0
                for of_leg in (*[x for leg in plan.legs for x in leg[:2]], *[mask for _, mask in nears]):
                    of_leg[sid] = 0
                plan.room[sid] = top[sid] = plan.rest[sid]
                active[sid] = plan.rest[sid] > 0
        if fixed:
            tagged = every.join(F.broadcast(spark.createDataFrame(fixed, kinds).drop("size")), ["__sid", "__key"], "left_anti")
    last = none
    for near, mask in nears:
        last = last.union(near.join(_per_source(spark, mask), "__sid", "left_semi"))
    one = [(sid, d["__key"], d["size"]) for sid, both in extremes.items() for d in both if d]
    return last.union(spark.createDataFrame(one, kinds)).distinct(), spark.createDataFrame(fixed, kinds)


def _left_out(tagged: DataFrame, plan: Plan, which: np.ndarray) -> list:
    """(sid, longest document that fits the room, next longer one) of those that the legs left out; a row per source."""
    spark = tagged.sparkSession
    rest = tagged.join(_per_source(spark, which), "__sid")
    blocks = rest.groupBy("__sid", "__block").agg(F.sum("size").alias("words"))
    places = _with_positions(blocks, plan, plan.passes).select("__sid", "__block", "__pos")
    left = rest.join(places, ["__sid", "__block"])
    for start, to, top in plan.legs:
        left = left.join(_per_source(spark, which, __from=start, __to=to, __top=top), "__sid")
        left = left.where("not (__pos >= __from and __pos < __to and size <= __top)").drop("__from", "__to", "__top")
    left = _units(left).join(_per_source(spark, which, __room=plan.room), "__sid")
    pick = F.struct("size", "__key")
    fits = F.max(F.when((F.col("size") > 0) & (F.col("size") <= F.col("__room")), pick))
    return left.groupBy("__sid").agg(fits, F.min(F.when(F.col("size") > F.col("__room"), pick))).collect()


def _units(rows: DataFrame) -> DataFrame:
    """Equal rows of one block are one choice: their key is the same."""
    return rows.groupBy("__sid", "__key").agg(F.sum("size").alias("size"))


def make_plan(narrow: DataFrame, most: float, weights: tuple, shards: int, rows_per_block: int) -> tuple[Plan, DataFrame]:
    """The plan and the fill: (__sid, __key, size) of documents taken one by one. ``narrow``: source, size, __key."""
    found = narrow.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    listed = found.orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    if len(listed) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: mix over a coarser source column")
    plan = Plan(
        pd.DataFrame([r.asDict() for r in listed], columns=["source", "n", "words"]), most, weights, rows_per_block
    )
    spark = narrow.sparkSession
    fill = spark.createDataFrame([], "__sid int, __key long, size long")
    if plan.rest.any():
        candidates, fixed = _legs(_tagged(narrow, plan), plan)
        room = plan.room.copy()

        def chosen(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["size", "__key"], ascending=[False, True], kind="stable")
            return rows[greedy_fill(rows["size"].to_numpy(), int(room[rows["__sid"].iloc[0]]))]

        picked = candidates.groupBy("__sid").applyInPandas(chosen, "__sid int, __key long, size long")
        fill = stored(picked.union(fixed), "mix-fill")
    filled = {r[0] for r in fill.select("__sid").distinct().collect()}
    partial = sum((to - start for start, to, _ in plan.legs), np.zeros(len(plan.names), np.int64))
    quotas = plan.passes * plan.blocks + partial + np.array([i in filled for i in range(len(plan.names))], np.int64)
    quotas = quotas.astype(np.int64).reshape(-1)
    split = split_tree(quotas, shards)
    plan.bounds = np.cumsum(split, axis=0)
    return plan, fill


def mix(
    docs: DataFrame,
    most: float = 3,
    weights: tuple = (5, 2, 1),
    shards: int = 64,
    rows_per_block: int = 16,
    carry: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target`` and ``shards``: a shard per time it is taken.

    ``prefix`` goes before the new names, for inputs that have such columns.
    """
    made = [f"{prefix}{c}" for c in ("size", "source_size", "target", "shards")]
    columns = carry or [c for c in docs.columns if c not in made]
    narrow = stored(_sized(docs).select("source", F.col("__size").alias("size"), "__key"), "mix-sizes")
    plan, fill = make_plan(narrow, most, weights, shards, rows_per_block)
    few = fill.select("__sid", "__key", F.lit(True).alias("__fill"))  # broadcast if its stored size is small
    rows = (
        _tagged(_sized(docs), plan)
        .join(few, ["__sid", "__key"], "left")
        .select(*columns, "__size", "__sid", "__block", F.coalesce("__fill", F.lit(False)).alias("__fill"))
    )

    @F.arrow_udf("struct<source_size: long, target: double, shards: array<int>>")
    def placed(sids: pa.Array, blocks: pa.Array, sizes: pa.Array, fills: pa.Array) -> pa.Array:  # texts stay out of Python
        size = sizes.to_numpy(zero_copy_only=False)
        sid, block = sids.to_numpy(zero_copy_only=False), blocks.to_numpy(zero_copy_only=False)
        fill_row = fills.to_numpy(zero_copy_only=False).astype(bool)
        base = plan.passes[sid]
        lists: list[list[int]] = [[] for _ in sid]
        for turn in range(int(base.max(initial=0)) + 1):
            at = np.flatnonzero(turn <= base)
            pos = plan.position(sid[at], block[at], np.full(len(at), turn))
            last = turn == base[at]
            inside, place, so_far = np.zeros(len(at), bool), pos.copy(), np.zeros(len(at), np.int64)
            for start, to, top in plan.legs if last.any() else ():
                start, to, top = start[sid[at]], to[sid[at]], top[sid[at]]
                own = last & (pos >= start) & (pos < to) & (size[at] <= top)
                inside |= own
                place[own] = (so_far + pos - start)[own]
                so_far += to - start
            extra = last & ~inside & fill_row[at]
            place[extra] = so_far[extra]
            taken = ~last | inside | extra
            draw = turn * plan.blocks[sid[at]] + place
            for i, s, d in zip(at[taken].tolist(), sid[at][taken].tolist(), draw[taken].tolist()):
                lists[i].append(int(np.searchsorted(plan.bounds[:, s], d, "right")))
        return pa.StructArray.from_arrays(
            [
                pa.array(plan.sizes[sid], pa.int64()),
                pa.array(plan.target[sid], pa.float64()),
                pa.array(lists, pa.list_(pa.int32())),
            ],
            names=["source_size", "target", "shards"],
        )

    with_plan = rows.withColumn("__placed", placed("__sid", "__block", "__size", "__fill"))
    return with_plan.select(
        *columns,
        F.col("__size").alias(made[0]),
        *[F.col(f"__placed.{c}").alias(n) for c, n in zip(("source_size", "target", "shards"), made[1:])],
    )


def drawn(mixed: DataFrame, prefix: str = "") -> DataFrame:
    """One row per time a row is taken: ``copy`` (from 0), ``shard``, and ``order``, the shuffle key within the shard.

    The three replace columns of those names, ``prefix`` included.
    """
    copy, shard, order = (f"{prefix}{c}" for c in ("copy", "shard", "order"))
    each = mixed.drop(copy, shard, order).select("*", F.posexplode(f"{prefix}shards").alias(copy, shard))
    return each.withColumn(order, _order(F.col(f"{prefix}size"), F.col(copy), F.col(shard)))


def _order(size: Column, copy: Column, shard: Column) -> Column:
    return F.xxhash64(F.lit(SEED), F.col("doc_id"), size, copy, shard)


def laid_out(mixed: DataFrame, prefix: str = "") -> DataFrame:
    """``drawn`` rows dealt by shard (large shards over several tasks) and shuffled locally."""
    place = [f"{prefix}shard", f"{prefix}order"]
    return drawn(mixed, prefix).repartitionByRange(*place).sortWithinPartitions(*place)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, the words taken, and shard and order of each copy."""
    return mix(docs, carry=["doc_id"]).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.size("shards") * F.col("size")).cast("long").alias("taken"),
        "shards",
        F.transform("shards", lambda shard, copy: _order(F.col("size"), copy, shard)).alias("orders"),
    )
