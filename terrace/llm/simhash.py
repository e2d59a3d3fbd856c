"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint has bit b set if more than half of its shingles' 64-bit
hashes have it. Fingerprints that differ in at most ``radius`` bits are
linked; a component's id is its smallest ``doc_id``.

Search: the 64 bits are cut into ``radius + 2`` blocks. Two fingerprints
within the radius agree on at least two whole blocks, so for every pair of
blocks the distinct fingerprints are bucketed by the bits of both. Within a
bucket, bit planes are stored vertically (64 fingerprints to a word), one
query's distances to all of them are summed by carry-save counters plane by
plane, and a block (one query, 64 fingerprints) is abandoned once all its lanes
exceed the radius: of random fingerprints less than half of the planes are read. A bucket
over ``TILE`` rows is cut into chunks and every pair of chunks becomes a task
of its own, so no bucket is capped and none is held whole.

Defined cases: a null, empty or blank text has fingerprint 0 and is linked
like any other; a text with fewer words than a shingle is one shingle;
repeated rows each get a row; rows that share a ``doc_id`` are one document,
so their fingerprints are linked; rows with a null ``doc_id`` take part and get
the component of their fingerprint, named by the smallest non-null id (null if
there is none); an empty table gives none.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import components, stored
from terrace.llm.words import lean, tidy

TILE = 4096
QUERIES_AT_ONCE = 64


def fingerprint(text: bytes, shingle: int, seed: int = 42, step: int = 1 << 16) -> int:
    """Majority bits of the hashes of ``text``'s word shingles (UTF-8, A-Z lower-cased)."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.diff(ends, prepend=0))[:n].tolist()
    ends = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    one, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, step):
        hashes = np.array([one(line[s:e], seed) for s, e in zip(starts[at : at + step], ends[at : at + step])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp: the fingerprint's 64 bits as a long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_buffer() if t.is_valid else b"" for t in batch.column(1).cast(pa.large_binary()))
            prints = [fingerprint(bytes(t), shingle) for t in texts]
            yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])

    return lean(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        tidy(run), "doc_id long, fp long"
    )


def block_masks(radius: int) -> list[int]:
    """64-bit masks of every pair of ``radius + 2`` blocks of bits."""
    edges = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [x | y for x, y in combinations(blocks, 2)]


def planes_of(values: np.ndarray) -> np.ndarray:
    """(64, words): bit b of value i is bit i % 64 of word i // 64 of plane b; lanes beyond the values are 0."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def lanes_within(
    bits: list[int], difference: Callable[[int, np.ndarray], np.ndarray], over: np.ndarray, radius: int, tally: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, lanes): the blocks of 64 lanes that hold lanes with at most ``radius`` ones, and those lanes.

    ``difference(b, blocks)`` gives plane ``b`` of some blocks; lanes set in ``over``
    (padding, or not asked for) are out from the start. Carry-save counting: plane
    i of the counter holds bit i of every lane's count, and ``over`` collects the lanes whose
    count has passed it. A block whose lanes have all passed is
    abandoned: no further plane of it is read. ``tally`` gets the number of blocks read at each plane.
    """
    width = radius.bit_length()
    blocks = np.flatnonzero(over != FULL)
    over = over[blocks]
    counter = [np.zeros(len(blocks), np.uint64) for _ in range(width)]
    for k, b in enumerate(bits):
        if not len(blocks):
            break
        if tally is not None:
            tally.append(len(blocks))
        carry = difference(b, blocks)
        for i in range(width):
            counter[i], carry = counter[i] ^ carry, counter[i] & carry
        over |= carry
        if k > radius and k & 1:
            alive = over != FULL
            if np.count_nonzero(alive) < 0.9 * len(blocks):
                blocks, over, counter = blocks[alive], over[alive], [c[alive] for c in counter]
    # counts that fit the counter's bits but exceed the radius
    greater, equal = np.zeros(len(blocks), np.uint64), np.full(len(blocks), FULL)
    for i in reversed(range(width)):
        if radius >> i & 1:
            equal = equal & counter[i]
        else:
            greater |= equal & counter[i]
            equal = equal & ~counter[i]
    lanes = ~(over | greater)
    held = lanes != 0
    return blocks[held], lanes[held]


def lanes_up_to(n: int, words: int) -> np.ndarray:
    """``words`` blocks in which the first ``n`` lanes are set."""
    filled = np.clip(n - 64 * np.arange(words), 0, 64)
    return np.where(filled == 64, FULL, (np.uint64(1) << (filled % 64).astype(np.uint64)) - np.uint64(1))


def unpack(lanes: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(lanes).view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def linked_pairs(left: np.ndarray, right: np.ndarray, bits: list[int], radius: int, tally: list | None = None) -> np.ndarray:
    """For aligned arrays, whether ``left[i]`` and ``right[i]`` are within the radius (lanes are the pairs)."""
    planes = planes_of(left ^ right)
    words = planes.shape[1]
    blocks, lanes = lanes_within(bits, lambda b, at: planes[b][at], ~lanes_up_to(len(left), words), radius, tally)
    out = np.zeros(words, np.uint64)
    out[blocks] = lanes
    return unpack(out, len(left))


def local_links(prints: np.ndarray, bits: list[int], radius: int, tally: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) places, i < j, of one bucket's fingerprints within the radius, some queries at a time.

    A block is one query against 64 fingerprints; a query's own lane and those before it are not asked for.
    """
    n, planes = len(prints), planes_of(prints)
    for at in range(0, n, QUERIES_AT_ONCE):
        asked, from_word = prints[at : at + QUERIES_AT_ONCE], at // 64
        words = planes.shape[1] - from_word
        out = ~lanes_up_to(n - 64 * from_word, words)
        over = np.stack([out | lanes_up_to(at + i + 1 - 64 * from_word, words) for i in range(len(asked))])

        def difference(b, blocks, asked=asked, from_word=from_word, words=words):
            flip = np.where((asked >> np.uint64(b)) & np.uint64(1), FULL, np.uint64(0))
            return planes[b, from_word + blocks % words] ^ flip[blocks // words]

        blocks, lanes = lanes_within(bits, difference, over.ravel(), radius, tally)
        block, lane = np.nonzero(unpack(lanes[:, None], 64)) if len(blocks) else (blocks, blocks)
        yield at + blocks[block] // words, 64 * (from_word + blocks[block] % words) + lane


def local_stars(prints: np.ndarray, nodes: np.ndarray, bits: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning stars (node, its component's smallest node) among one bucket's fingerprints."""
    label = np.arange(len(prints))
    for i, j in local_links(prints, bits, radius):
        cuts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else i
        for s, e in zip(cuts, np.append(cuts[1:], len(i))):
            met = np.unique(np.append(label[j[s:e]], label[i[s]]))
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
        if (label == label[0]).all():
            break
    out = []
    for root in np.unique(label):
        own = nodes[label == root]
        if len(own) > 1:
            least = own.min()
            out += [(int(x), int(least)) for x in own if x != least]
    return out


def bucket_links(masks: list[int], radius: int):
    """mapInArrow over rows sorted by (t, key, i, j): links found in each run of equal buckets."""
    free_bits = [[b for b in range(64) if not m >> b & 1] for m in masks]

    def links(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(cols["fp"])
        us, vs = [], []
        if n > 1:
            same = np.ones(n - 1, bool)
            for c in ("t", "key", "i", "j"):
                same &= cols[c][1:] == cols[c][:-1]
            cuts = np.flatnonzero(~same) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, n)
            sizes = ends - starts
            fp = cols["fp"].view(np.uint64)
            small = np.repeat(sizes <= 16, sizes)
            left_in_run = np.repeat(ends, sizes) - np.arange(n)
            for d in range(1, 16):  # short runs: lanes are all pairs at distance d
                at = np.flatnonzero(small & (left_in_run > d))
                if not len(at):
                    break
                hit = at[linked_pairs(fp[at], fp[at + d], list(range(64)), radius)]
                us += cols["node"][hit].tolist()
                vs += cols["node"][hit + d].tolist()
            for s, e in zip(starts[sizes > 16], ends[sizes > 16]):
                for u, v in local_stars(fp[s:e], cols["node"][s:e], free_bits[cols["t"][s]], radius):
                    us.append(u)
                    vs.append(v)
        return pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            if held is not None:
                cols = {c: np.concatenate([held[c], cols[c]]) for c in cols}
            n = len(cols["fp"])
            if not n:
                continue
            last = np.ones(n, bool)
            for c in ("t", "key", "i", "j"):
                last &= cols[c] == cols[c][-1]
            cut = int(np.argmax(last))  # the last run may go on in the next batch; at most two chunks long
            held = {c: v[cut:] for c, v in cols.items()}
            yield links({c: v[:cut] for c, v in cols.items()})
        if held is not None:
            yield links(held)

    return run


def near_links(prints: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within ``radius``; ``prints``: (node, fp), fp distinct."""
    masks = block_masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = prints.select(
        F.explode(
            F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)])
        ).alias("b"),
        "fp",
        "node",
    ).select("b.t", "b.key", "fp", "node")
    buckets = stored(keyed.groupBy("t", "key").count().where("count > 1"), "simhash-buckets")
    chunks = F.ceil(F.col("count") / F.lit(tile)).cast("int")
    dealt = (
        keyed.join(buckets, ["t", "key"])  # fingerprints alone in a bucket go no further
        .withColumn("m", chunks)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .select(
            "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "node"
        )
    )
    return (
        dealt.repartition("t", "key", "i", "j")
        .sortWithinPartitions("t", "key", "i", "j")
        .mapInArrow(tidy(bucket_links(masks, radius)), "u long, v long")
    )


def grouped(docs: DataFrame, shingle: int = 3, radius: int = 3) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, component_id) of every distinct fingerprint; both stored."""
    prints = stored(fingerprints(docs, shingle), "simhash-prints")
    # a node is the smallest doc_id with the fingerprint; ids may be null
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    several = stored(  # ids of several texts
        prints.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("fp").alias("v"), F.max("fp").alias("w"))
        .where("v < w")
        .select("doc_id", "v"),
        "simhash-several",
    )
    if several.limit(1).count() or distinct.where("low is null").limit(1).count():
        # link by the fingerprints themselves, and those of one id; then take the smallest id
        nodes = distinct.select("fp", F.col("fp").alias("node"), "low")
        same_id = prints.join(several, "doc_id").select(F.col("fp").alias("u"), "v")
        linked = components(near_links(nodes, radius).union(same_id), "simhash-cc")
        named = nodes.join(linked, "node", "left").select("fp", "low", F.coalesce("component", "node").alias("c"))
        known = named.join(named.groupBy("c").agg(F.min("low").alias("component_id")), "c")
    else:
        nodes = distinct.select("fp", F.col("low").alias("node"))
        linked = components(near_links(nodes, radius), "simhash-cc")
        known = nodes.join(linked, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    # a plain table, so that a hot fingerprint can be split in a join
    return prints, stored(known.select("fp", "component_id"), "simhash-known")


def group(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    prints, known = grouped(docs, shingle, radius)
    return prints.join(known, "fp", "left").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``group`` with the fingerprint as 16 lowercase hex digits."""
    return group(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One document of each component stays, the one that names it; columns unchanged.

    Rows that repeat a kept ``doc_id`` are left out but for one. A row without
    id stays if its component has no id at all, one for each fingerprint.
    """
    prints, known = grouped(docs, shingle, radius)
    members = prints.join(known, "fp").where("doc_id is not null")
    gone = stored(members.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")), "simhash-gone")
    doc_id = F.col("doc_id").cast("long")
    kept = docs.where("doc_id is not null").join(gone, doc_id == F.col("__gone"), "left_anti")
    again = stored(members.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__again")), "simhash-again")
    if again.limit(1).count():
        one = kept.join(again, doc_id == F.col("__again"), "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(again, doc_id == F.col("__again"), "left_anti").union(one)
    nameless = docs.where("doc_id is null")
    if nameless.limit(1).count():
        fp = _fingerprint_column(nameless, shingle)
        free = known.where("component_id is null").select(F.col("fp").alias("__fp"))
        kept = kept.union(fp.join(free, "__fp", "left_semi").dropDuplicates(["__fp"]).select(*docs.columns))
    return kept


def _fingerprint_column(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs`` plus ``__fp``."""
    picked = lean(docs).select("*", F.col("text").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, texts = batch.columns
            prints = pa.array([fingerprint((t or "").encode(), shingle) for t in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, prints], names=[*batch.schema.names[:-1], "__fp"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return picked.mapInArrow(tidy(run), ", ".join([*kinds, "__fp long"]))
