"""Near-duplicates by b-bit MinHash.

Signing.  ``BANDS`` x ``ROWS`` minima of the shingle hashes under multiplicative permutations; of each minimum the
lowest two bits are kept, in two planes of bits.  Texts with the same set of shingles are one class from here on.

Candidates.  Classes that agree on all minima of a band share a bucket.  A pair at the similarity limit of 0.8 meets in no
bucket with probability (1 - 0.8^4)^32 < 1e-7.  The agreement a pair of signatures shows, p, counted on the bits,
gives the similarity (p - C) / (1 - C) with C = 1/4, the chance that two bits agree by accident; pairs whose estimate is
six standard deviations under the limit are no candidates.

Links.  Every candidate is confirmed on the full sets.  First every class is compared with one class of its
buckets: of the bucket's centres (the class that meets most others, as an original among its edited copies does) the one
that seems most alike.  That joins groups of any size with as many comparisons as members.  Then the classes that are not
of their centre's component meet all classes of the bucket that they aren't joined with, so no link that
would join two components is lost.  This goes bucket by bucket in tasks, a large bucket in parts of ``PART`` classes.  First
only signatures travel, and a class leaves a part in which no estimate reaches the limit; the texts of those that stay
follow, and full sets decide the pairs whose estimate does.  A bucket of unlike classes, which share some boilerplate, costs
bit counts only.  A part yields no pairs but the few links that connect what it has found to belong together.

Cases.  Texts without words (null among them) have the empty set and are linked with nothing.  A text of fewer
words than a shingle has one shingle, the whole sequence.  Repeated rows are one class and share their
component.  component_id is the smallest doc_id of the component; rows with null doc_id belong to components and
never name one, and are kept only where no row of the component has an id.  Other columns are not read.  An empty
table stays empty.  Shingles are compared by 64-bit hashes, classes by 128-bit digests.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import ready, tidy, written
from .shingles import mixed, shingle_set

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: A part of a bucket has about this many classes, and bytes of compressed text.
PART, PART_BYTES = 1024, 2 << 20

_factors = np.random.default_rng(20_240_607).integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)

SIGNED = "doc_id long, text_hash long, n_shingles long, node binary, signature array<long>, bands array<long>"


def minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (_factors[:, None] * shingles[None, i: i + 2048]).min(1), out=least)
    return mixed(least)


def planes(least: np.ndarray) -> list[int]:
    """The lowest bits of all minima, then their second bits, 64 to a number."""
    return np.concatenate([np.packbits(((least >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)).view("<i8") for b in (0, 1)]).tolist()


def band_keys(least: np.ndarray) -> list[int]:
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + least[r::ROWS])
    return key.view(np.int64).tolist()


def _sign(n_words: int):
    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text"):
                s = shingle_set(text.as_buffer().to_pybytes() if text.is_valid else b"", n_words)
                least = minima(s)
                out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), planes(least), band_keys(least)) if len(s) else (0, None, None, None))
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))],
                                             ["doc_id", "text_hash", "n_shingles", "node", "signature", "bands"])
    return run


def estimate(a: str, b: str) -> Column:
    """Collision-corrected similarity of two signatures."""
    x, y, n = F.col(a), F.col(b), HASHES // 64
    differ = sum((F.bit_count(x[i].bitwiseXOR(y[i]).bitwiseOR(x[i + n].bitwiseXOR(y[i + n]))) for i in range(n)), F.lit(0))
    return ((1 - differ / F.lit(float(HASHES))) - 0.25) / 0.75


def least_estimate(percent: int) -> float:
    """Six standard deviations under the limit."""
    p = 0.25 + 0.75 * percent / 100
    return percent / 100 - 6 * (p * (1 - p) / HASHES) ** 0.5 / 0.75


def likely_pairs(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether the signatures (a row each) of ``left`` and ``right`` reach the least estimate, by the bit counts of ``estimate``."""
    n = HASHES // 64
    left, right = left.view(np.uint64), right.view(np.uint64)  # of signed numbers the absolute value's bits would be counted
    differ = np.zeros((len(left), len(right)), np.int32)
    for i in range(n):
        differ += np.bitwise_count((left[:, None, i] ^ right[None, :, i]) | (left[:, None, i + n] ^ right[None, :, i + n]))
    return ((1 - differ / HASHES) - 0.25) / 0.75 >= least_estimate(percent)


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _compress(batches):
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        z = [squeeze.compress(t.as_buffer().to_pybytes()) if t.is_valid else b"" for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), pa.array(z, pa.binary())], ["id", "text_hash", "z"])


NO_ID = -(1 << 63)  # stands for a null doc_id in keys


def _texts(documents: DataFrame, reps: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, z): compressed text of every class in ``nodes``."""
    keys = reps.join(nodes, "node", "left_semi").select("node", "id", "text_hash")
    texts = (_keyed(documents).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash", "text")
             .mapInArrow(tidy(_compress), "id long, text_hash long, z binary"))
    return written(texts.join(keys, ["id", "text_hash"]).groupBy("node").agg(F.min("z").alias("z")).withColumn("bytes", F.length("z")), "texts")


def _confirm(n_words: int, percent: int):
    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        known: dict[bytes, np.ndarray] = {}

        def of(z: bytes) -> np.ndarray:
            if z not in known:
                if len(known) >= 256:
                    known.clear()
                known[z] = shingle_set(open_.decompress(z), n_words)
            return known[z]

        for batch in batches:
            keep = []
            for zx, zy in zip(batch.column("zx"), batch.column("zy")):
                x, y = of(zx.as_py()), of(zy.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("x"), kept.column("y")], ["a", "b"])
    return run


def _links(texts: DataFrame, pairs: DataFrame, n_words: int, percent: int) -> DataFrame:
    """(a, b): the pairs (x, y) that are links."""
    with_texts = (pairs.join(texts.select(F.col("node").alias("x"), F.col("z").alias("zx")), "x")
                  .join(texts.select(F.col("node").alias("y"), F.col("z").alias("zy")), "y"))
    return written(with_texts.select("x", "y", "zx", "zy").mapInArrow(tidy(_confirm(n_words, percent)), "a binary, b binary"), "links")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``left`` with every set of ``right``."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left])
    flat = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    values, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = np.cumsum(times > 1) - 1  # a shingle of one set alone is shared with nobody
    keep = times[column] > 1
    row, column = row[keep], often[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        has = np.zeros((len(left) + len(right), width), np.float32)
        has[row[a:b], column[a:b] - lo] = 1
        out += has[: len(left)] @ has[len(left):].T
    return out.astype(np.int64)


def connecting(linked: np.ndarray) -> list[tuple[int, int]]:
    """True places (left, right), fewer than rows and columns, that connect all that the true places connect."""
    out, group = [], np.full(linked.shape[1], -1)
    for i in np.flatnonzero(linked.any(1)).tolist():
        own = np.flatnonzero(linked[i])
        groups, first = np.unique(group[own], return_index=True)
        out += [(i, int(own[j])) for g, j in zip(groups.tolist(), first.tolist()) if g >= 0]
        out += [(i, j) for j in own[group[own] < 0].tolist()]
        group[np.isin(group, groups[groups >= 0])] = i
        group[own] = i
    return out


def _by_part(batches, columns):
    """The rows of one part after the other; rows come in order of their part."""
    held = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if held and row[0] != held[-1][0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _apart_and_likely(left, right, percent: int) -> np.ndarray:
    """Pairs of classes of different components whose signatures are alike enough; rows are (part, node, component, signature, ...)."""
    number = {c: i for i, c in enumerate({r[2] for r in (*left, *right)})}
    apart = np.array([number[r[2]] for r in left])[:, None] != np.array([number[r[2]] for r in right])[None]
    return apart & likely_pairs(*(np.array([r[3] for r in side], np.int64) for side in (left, right)), percent)


SIDES = "part long, node binary, component binary, signature array<long>, is_left boolean"


def _likely(percent: int):
    """The rows of each part that have a likely partner on its other side."""
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.bool_())
    names = ["part", "node", "component", "signature", "is_left"]

    def run(batches):
        for rows in _by_part(batches, names):
            left, right = [r for r in rows if r[4]], [r for r in rows if not r[4]]
            if not left or not right:
                continue
            likely = _apart_and_likely(left, right, percent)
            stay = [r for r, has in zip((*left, *right), (*likely.any(1), *likely.any(0))) if has]
            if stay:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in stay], k) for i, k in enumerate(kinds)], names)
    return run


def _part_links(n_words: int, percent: int):
    """Links between classes of different components in parts of buckets, of the pairs whose signatures are alike."""
    def compare(rows):
        left, right = [r for r in rows if r[4]], [r for r in rows if not r[4]]
        if not left or not right:
            return []
        likely = _apart_and_likely(left, right, percent)
        open_ = zstandard.ZstdDecompressor()
        sets = {node: shingle_set(open_.decompress(z), n_words) for node, z in {r[1]: r[5] for r in rows}.items()}
        x, y = [sets[r[1]] for r in left], [sets[r[1]] for r in right]
        linked = np.zeros_like(likely)
        if likely.sum() <= 16 * (len(x) + len(y)):  # few pairs: one by one
            for i, j in np.argwhere(likely).tolist():
                both = len(np.intersect1d(x[i], y[j], assume_unique=True))
                linked[i, j] = 100 * both >= percent * (len(x[i]) + len(y[j]) - both)
        else:
            both = shared_counts(x, y)
            size = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None]
            linked = likely & (100 * both >= percent * (size - both))
        return [(left[i][1], right[j][1]) for i, j in connecting(linked)]

    def run(batches):
        for rows in _by_part(batches, ("part", "node", "component", "signature", "is_left", "z")):
            out = compare(rows)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.binary()) for i in (0, 1)], ["a", "b"])

    return run


def near_duplicates(documents: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (null for the empty set), component_id, kept of every row (doc_id, text)."""
    ready(documents.sparkSession)
    signed = written(_keyed(documents).mapInArrow(tidy(_sign(n_words)), SIGNED), "signed")
    nodes = signed.where(F.col("node").isNotNull())
    # one class per set: its signature and the text that stands for it
    reps = written(nodes.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash")).alias("key"),
        F.first("signature").alias("signature"), F.first("bands").alias("bands")).select("node", "least", "key.id", "key.text_hash", "signature", "bands"), "classes")
    held = reps.select("node", "signature")

    banded = reps.select("node", F.explode("bands").alias("band"))
    # written sides: Spark can split a join's hot key only between two plain exchanges
    buckets = written(banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "bands")
    met = written(banded.join(buckets, "band").select("band", "node", "n"), "met")
    # the centre of a bucket: the class that meets most others over all its buckets, as an original among its edited copies does
    degree = met.groupBy("node").agg(F.sum("n").alias("degree"))
    met = met.join(degree, "node")
    centres = written(met.groupBy("band").agg(F.max(F.struct("degree", "node")).alias("top")).select("band", F.col("top.node").alias("centre")), "centres")
    shared = written(met.join(centres, "band").select("band", "node", "n", "centre"), "buckets")

    # one comparison for every class: the centre that seems most alike
    alike = written(shared.where("node <> centre").select(F.col("node").alias("x"), F.col("centre").alias("y")).distinct()
                    .join(held.select(F.col("node").alias("x"), F.col("signature").alias("sx")), "x")
                    .join(held.select(F.col("node").alias("y"), F.col("signature").alias("sy")), "y")
                    .withColumn("alike", estimate("sx", "sy")).where(F.col("alike") >= least_estimate(percent)).select("x", "y", "alike"), "alike")
    first = written(alike.groupBy("x").agg(F.max(F.struct("alike", "y")).alias("best")).select("x", F.col("best.y").alias("y")), "first")
    both_sides = first.select(F.col("x").alias("node")).union(first.select(F.col("y").alias("node"))).distinct()
    links = _links(_texts(documents, reps, both_sides), first, n_words, percent)
    joined = components(links)

    # then the classes of other components than their bucket's centre, with all of the bucket that they aren't joined with
    unseen = alike.join(first.select("x", "y", F.lit(True).alias("seen")), ["x", "y"], "left").where("seen IS NULL")
    labelled = written(
        shared.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        .join(joined.select(F.col("node").alias("centre"), F.col("component").alias("centre_component")), "centre", "left")
        .join(unseen.select(F.col("x").alias("node"), F.col("y").alias("centre"), F.lit(True).alias("unseen")), ["node", "centre"], "left")
        .withColumn("other", F.col("component") != F.coalesce("centre_component", "centre")).select("band", "node", "n", "component", "other", "unseen"), "labelled")
    # a bucket of two whose pair was compared, or whose signatures are unlike, is done
    bands = written(labelled.where("other AND (n > 2 OR unseen)").select("band").distinct(), "bands")
    open_ = written(labelled.join(bands, "band", "left_semi").select("band", "node", "component", "other"), "open")
    texts = _texts(documents, reps, open_.select("node").distinct())
    size = F.col("bytes").cast("long")
    parts = open_.join(texts.select("node", "bytes"), "node").groupBy("band").agg(
        F.ceil(F.greatest(F.count("*") / PART, F.sum(size) / PART_BYTES)).cast("int").alias("right_parts"),
        F.ceil(F.greatest(F.count_if("other") / PART, F.sum(F.when(F.col("other"), size)) / PART_BYTES)).cast("int").alias("left_parts"))
    dealt = open_.join(written(parts, "parts"), "band").withColumns({
        "l": F.pmod(F.xxhash64("node"), F.col("left_parts")), "r": F.pmod(F.xxhash64("node", F.lit(1)), F.col("right_parts"))})
    right = dealt.select("band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("left_parts") - 1)).alias("l"), "r", "node", "component", F.lit(False).alias("is_left"))
    left = dealt.where("other").select("band", "l", F.explode(F.sequence(F.lit(0).cast("long"), F.col("right_parts") - 1)).alias("r"), "node", "component", F.lit(True).alias("is_left"))
    sides = (left.union(right).select(F.xxhash64("band", "l", "r").alias("part"), "node", "component", "is_left").join(held, "node")
             .select("part", "node", "component", "signature", "is_left"))
    likely = written(sides.repartition("part").sortWithinPartitions("part").mapInArrow(tidy(_likely(percent)), SIDES), "likely")
    with_texts = likely.join(texts.select("node", "z"), "node")
    more = written(with_texts.repartition("part").sortWithinPartitions("part").mapInArrow(tidy(_part_links(n_words, percent)), "a binary, b binary"), "more")
    joined = components(links.union(more))

    # the smallest doc_id of a class, or of all classes of its component
    named = reps.select("node", "least").join(joined, "node", "left")
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("together"))
    named = named.join(least, "component", "left").select(
        "node", F.coalesce("component", "node").alias("component"), F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("together")).alias("component_id"))
    out = signed.select("doc_id", "text_hash", "n_shingles", "node").join(named, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "text_hash", "n_shingles", "component", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(documents: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """The documents of which one row of every component stays, the first by (doc_id, hash of text), and all rows without words.

    Of rows with words and the same doc_id and text one stays.
    """
    found = near_duplicates(documents, n_words, percent).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash", "component", "kept")
    chosen = (found.where("kept AND component IS NOT NULL").groupBy("component").agg(F.min(F.struct("id", "text_hash")).alias("key"))
              .select(F.col("key.id").alias("_id"), F.col("key.text_hash").alias("_hash")))
    keyed = documents.select(F.struct("*").alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_hash"))
    one = keyed.join(written(chosen, "kept"), ["_id", "_hash"]).dropDuplicates(["_id", "_hash"]).select("_row.*")
    # linked with nothing: they pass as often as they are there
    return one.union(documents.where(~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")))
