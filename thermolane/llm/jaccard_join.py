"""Exact Jaccard join of documents on word shingles by vertical partitioning.

Shingles have one global order, rare ones first. It is cut into fragments. The fragments that hold a
document's first shingles (as many as two linked documents cannot both miss) give candidate pairs; the
overlap of a pair is counted in each fragment on its own, and summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .storage import discard, small_batches, stage
from .textbytes import mixed, shingles, text_pieces

#: Counters of repeated shingles: a fixed number, so that what is broadcast never grows.
SKETCH_BITS = 20
#: Shingles among which a task counts repeats. Those that occur once there, nearly all, fill no counter, so
#: that a common one stands out however many there are.
BLOCK = 1 << 22
CHUNK_BITS = 12
#: A key of the global order is 5 bits for the frequency class and 58 bits of the fingerprint.
HASH_BITS = 58
#: Bits of the filter for documents whose sets are compared: fixed, as it is broadcast.
FILTER_BITS = 1 << 25
#: Fragments: 8 for each frequency class.
FRAGMENT_SHIFT = np.uint64(HASH_BITS - 3)
#: Shingles whose counter is beyond this are dealt over several groups.
GROUP = 4096
#: Shingles of a set of n beyond its first ones.
BEYOND = "(({n} * {percent} + 99) div 100 - 1)"
#: Sets that a task remembers, so as not to send their copies; copies beyond them go after the shuffle.
SEEN = 1 << 18


def _bucket(prints: np.ndarray) -> np.ndarray:
    return (prints >> np.uint64(64 - SKETCH_BITS)).view(np.int64)


class _Seen:
    """Sets that a task has met: of those with the same last bits the latest, so that its size is fixed."""

    def __init__(self):
        self.latest = np.arange(1, SEEN + 1)  # no place holds a set of its own yet

    def first(self, node: np.ndarray) -> np.ndarray:
        """One row of each set that is not remembered: copies add nothing."""
        new = np.zeros(len(node), bool)
        new[np.unique(node, return_index=True)[1]] = True
        at = node & (SEEN - 1)
        new &= self.latest[at] != node
        self.latest[at] = node
        return new


def _repeats(block: np.ndarray) -> np.ndarray:
    """Per counter how often its shingles occur again among those of the block, which is sorted in place."""
    block.sort()
    return np.bincount(_bucket(block[1:][block[1:] == block[:-1]]), minlength=1 << SKETCH_BITS)


def _profiles(width: int):
    """Per document its set size and a 128-bit fingerprint of the set; per task its counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        block, held, seen = np.empty(BLOCK, np.uint64), 0, _Seen()
        for batch in batches:
            ids = batch.column(0)
            for i, j, texts in text_pieces(batch.column(1)):
                row, h = shingles(texts, width)
                n = np.bincount(row, minlength=j - i)
                marks = [_mark(h, n, 1), _mark(h, n, 2)]
                if held + len(h) > len(block):
                    counts += _repeats(block[:held])
                    block, held, seen = np.empty(max(BLOCK, len(h)), np.uint64), 0, _Seen()
                new = h[seen.first(marks[0])[row]]
                block[held : held + len(new)] = new
                held += len(new)
                none = pa.nulls(j - i, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(n), pa.array(marks[0]), pa.array(marks[1]),
                     pa.nulls(j - i, pa.int32()), none],
                    ["doc_id", "n", "m1", "m2", "chunk", "counts"],
                )
        counts += _repeats(block[:held])
        parts = np.minimum(counts, 2**31 - 1).astype(np.int32).reshape(-1, 1 << CHUNK_BITS)
        some = np.flatnonzero(parts.any(1))
        empty = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [empty, empty, empty, empty, pa.array(some.astype(np.int32)), pa.array([parts[k].tobytes() for k in some], pa.binary())],
            ["doc_id", "n", "m1", "m2", "chunk", "counts"],
        )

    return run


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros(1 << CHUNK_BITS, np.int64)
    for raw in group["counts"]:
        total += np.frombuffer(raw.as_buffer(), np.int32)
    level = np.ceil(np.log2(total + 1)).astype(np.uint8)
    return pa.table({"chunk": group["chunk"].slice(0, 1), "counts": pa.array([level.tobytes()], pa.binary())})


def _levels(profiles: DataFrame) -> np.ndarray:
    """log2 of one more than each counter, rounded up: one byte for each of the fixed number of counters."""
    parts = profiles.where("chunk is not null").select("chunk", "counts")
    rows = parts.groupBy("chunk").applyInArrow(_summed, "chunk int, counts binary").collect()
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for chunk, raw in rows:
        out[chunk << CHUNK_BITS : (chunk + 1) << CHUNK_BITS] = np.frombuffer(raw, np.uint8)
    return out


def _mark(h: np.ndarray, n: np.ndarray, salt: int) -> np.ndarray:
    """A fingerprint of each row's set: the wrapping sum of its shingles' own hashes."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(h ^ np.uint64(salt * 0x5851F42D4C957F2D)))])
    at = np.concatenate([[0], np.cumsum(n)])
    return (total[at[1:]] - total[at[:-1]]).view(np.int64)


def _ordered(texts, width, levels, wanted):
    """(node of the row, row, key, size of the row's set, place in it), by row and key, of wanted nodes."""
    row, h = shingles(texts, width)
    node = _mark(h, np.bincount(row, minlength=len(texts)), 1)
    some = wanted(node)[row]
    row, h = row[some], h[some]
    level = np.minimum(levels[_bucket(h)], 31).astype(np.uint64)
    key = (level << np.uint64(HASH_BITS)) | (mixed(h) >> np.uint64(64 - HASH_BITS))
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    n = np.bincount(row, minlength=len(texts))
    place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    return node, row, key, n[row], place


def _prefixes(width: int, shared, percent: int):
    def run(batches):
        levels = np.frombuffer(shared.value, np.uint8)
        seen = _Seen()
        for batch in batches:
            for _, _, texts in text_pieces(batch.column(0)):
                node, row, key, n, place = _ordered(texts, width, levels, seen.first)
                # Two linked sets share percent of the larger one at least, so also one of the first
                # n - ceil(percent n) + 1 shingles of each.
                first = place < n - -(-n * percent // 100) + 1
                row, key, n, place = row[first], key[first], n[first], place[first]
                ways = (1 << np.maximum((key >> np.uint64(HASH_BITS)).astype(np.int64), 12)) // GROUP
                of = node[row]
                salt = (mixed(of.view(np.uint64)) % ways.astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array((ways > 1)), pa.array(of), pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32))],
                    ["s", "salt", "dealt", "node", "n", "place"],
                )

    return run


def _segments(width: int, shared, filled):
    def run(batches):
        levels, bits = np.frombuffer(shared.value, np.uint8), np.frombuffer(filled.value, np.uint8)

        def wanted(node):
            at = (node.view(np.uint64) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

        for batch in batches:
            for _, _, texts in text_pieces(batch.column(0)):
                node, row, key, _, _ = _ordered(texts, width, levels, wanted)
                fragment = (key >> FRAGMENT_SHIFT).astype(np.int64)
                edge = (row[1:] != row[:-1]) | (fragment[1:] != fragment[:-1])
                start = np.flatnonzero(np.concatenate([[True], edge])[: len(row)])
                offsets = np.concatenate([start, [len(row)]]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(key.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[row[start]]), pa.array(fragment[start].astype(np.int32)), keys],
                    ["node", "fragment", "keys"],
                )

    return run


def _filter_of(nodes: DataFrame) -> bytes:
    """A bitmap of fixed size with a bit set for each node: no node is missed, a few others pass."""
    at = nodes.select((F.col("node").bitwiseAND(FILTER_BITS - 1) + 1).alias("at"))
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for bucket, bits in parts.collect():
        out[(bucket - 1) * len(bits) : bucket * len(bits)] = bits
    return bytes(out)


def _linked(pairs: DataFrame, texts: DataFrame, width: int, shared, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose partial overlaps, summed over the fragments, suffice."""
    pairs = stage(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    filled = texts.sparkSession.sparkContext.broadcast(_filter_of(nodes))
    segments = texts.mapInArrow(_segments(width, shared, filled), "node long, fragment int, keys array<long>")
    with small_batches(texts.sparkSession):
        segments = stage(segments.dropDuplicates(["node", "fragment"]), "segments")
    left = pairs.join(segments.select(F.col("node").alias("a"), "fragment", F.col("keys").alias("x")), "a")
    both = left.join(
        segments.select(F.col("node").alias("b"), "fragment", F.col("keys").alias("y")), ["b", "fragment"]
    )
    overlap = both.select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).alias("part"))
    links = overlap.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("o"))
    links = stage(links.where(f"100 * o >= {percent} * (na + nb - o)").select("a", "b"), "links")
    discard(pairs, segments)
    return links


def _candidates(shared_rows: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets not yet known to be connected whose overlap in the first fragments may suffice.

    Within a shingle, the most common component is compared with all others, not with itself. A pair
    meets where a shingle may be the first that it shares and still leave enough for a link.
    """
    rows = shared_rows.join(comps, "node", "left").withColumn("c", F.coalesce("component", "node"))
    rows = stage(rows.select("s", "node", "n", "place", "c"), "rows")
    by = rows.groupBy("s", "c").agg(F.count("*").alias("k"))
    most = by.groupBy("s").agg(F.max_by("c", F.struct("k", "c")).alias("most"), F.count("*").alias("parts"))
    several = rows.join(most.where("parts > 1").select("s", "most"), "s")
    # Only these can be common to an unknown pair among the first shingles of both: so many follow each in a node.
    mine = Window.partitionBy("node")
    after = F.count("*").over(mine) - F.row_number().over(mine.orderBy("place"))
    mixed_rows = stage(several.withColumn("after", after), "mixed")
    discard(rows)
    one = mixed_rows.where("c != most").select("s", F.struct("node", "n", "place", "after").alias("p"), F.col("c").alias("cp"))
    two = mixed_rows.select("s", F.struct("node", "n", "place", "after").alias("q"), F.col("c").alias("cq"), "most")
    once = (F.col("cq") == F.col("most")) | (F.col("p.node") < F.col("q.node"))
    # A common shingle that is not among the first of both lies beyond those of the node whose first ones end earlier.
    beyond = BEYOND.format(n="greatest(p.n, q.n)", percent=percent)
    left = f"least(1 + least(p.after, q.after) + {beyond}, p.n - p.place, q.n - q.place)"
    may_link = f"(100 + {percent}) * {left} >= {percent} * (p.n + q.n)"
    met = one.join(two, "s").where("cp != cq").where(once).where(may_link)
    met = met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    pairs = met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
    return _hopeful(pairs.distinct(), mixed_rows, percent)


def _hopeful(pairs: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) whose overlap in the first fragments, and all that may follow, suffice.

    ``firsts`` has the first shingles (s) of each node that others have. Any other common shingle lies
    beyond the first ones of the node whose first ones end earlier.
    """
    lists = firsts.groupBy("node").agg(F.collect_list("s").alias("first"))
    both = pairs.join(lists.select(F.col("node").alias("a"), F.col("first").alias("x")), "a")
    both = both.join(lists.select(F.col("node").alias("b"), F.col("first").alias("y")), "b")
    most = "size(array_intersect(x, y)) + " + BEYOND.format(n="greatest(na, nb)", percent=percent)
    return both.where(f"(100 + {percent}) * ({most}) >= {percent} * (na + nb)").select("a", "b", "na", "nb")


def _nearest(met: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb): for each node b the lead a that most of its first shingles have, and that of the rarest.

    ``met`` has a row (node, n, place, lead) for every first shingle of a node that others have. A shingle that
    a and b share may have another lead, so all those of b count as shared with a. A pair that links may
    be left out here; the second phase finds it, since its ends are not known to be connected.
    """
    own = met.groupBy("node", "n", F.struct("lead.node", "lead.n").alias("lead")).agg(
        F.count("*").alias("k"), F.min("place").alias("place")
    )
    other = F.col("lead.node") != F.col("node")
    best, rarest = F.max_by("lead", F.when(other, F.struct("k", "lead"))), F.min_by("lead", F.when(other, F.struct("place", "lead")))
    both = own.groupBy(F.col("node").alias("b"), F.col("n").alias("nb")).agg(F.sum("k").alias("k"), F.array(best, rarest).alias("leads"))
    pairs = both.select("b", "nb", "k", F.explode(F.array_distinct("leads")).alias("lead")).where("lead is not null")
    pairs = pairs.select(F.col("lead.node").alias("a"), "b", F.col("lead.n").alias("na"), "nb", "k")
    most = "k + " + BEYOND.format(n="greatest(na, nb)", percent=percent)
    return pairs.where(f"(100 + {percent}) * ({most}) >= {percent} * (na + nb)").drop("k")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, n_copies), one row for each input row.

    Two documents are linked when 100 * intersection >= percent * union of their sets of shingles of
    ``width`` words; ``component_id`` is the smallest id reachable by links. Documents with equal sets
    form one class, and only its smallest id takes part in the join; ``n_copies`` is the class size.
    Within a class of near copies not every pair is compared: once two documents are known to be
    connected, their own link adds nothing.

    Null and empty texts, and texts without words, have no set and are their own component. A row with
    a null id links with nothing and has a null component. Rows that repeat an id count as one document
    per text. Sets are compared by 58 bits of a 64-bit fingerprint. Other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profiles = source.mapInArrow(
        _profiles(width), "doc_id long, n long, m1 long, m2 long, chunk int, counts binary"
    )
    with small_batches(spark):
        profiles = stage(profiles, "profiles")
    shared = spark.sparkContext.broadcast(_levels(profiles).tobytes())
    sets = profiles.where("chunk is null")
    usable = sets.where("n > 0 and doc_id is not null")
    # A node is a set, by the first half of its fingerprint; copies of a set are one node.
    classes = stage(usable.groupBy(F.col("m1").alias("node")).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies")), "classes")
    texts = source.where("doc_id is not null").select("text")
    prefix = texts.mapInArrow(
        _prefixes(width, shared, percent), "s long, salt int, dealt boolean, node long, n int, place int"
    )
    size = F.count("*").over(Window.partitionBy("s", "salt"))
    several = prefix.withColumn("k", size).where("k > 1 or dealt").select("s", "salt", "node", "n", "place")
    # Copies of a set lie in the group of its shingle, so this needs no shuffle of its own.
    with small_batches(spark):
        shared_rows = stage(several.distinct().drop("salt"), "shared")
    # First every set meets, of its size band, a node that has fewest rarer shingles before a shared one: among
    # near copies that is the text they were made from, or for a rare shingle the copy with least other changes.
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent)))
    banded = shared_rows.withColumn("band", band)
    lead = banded.groupBy("s", "band").agg(F.min_by(F.struct("node", "n", "place"), F.struct("place", "node")).alias("lead"))
    near = _nearest(banded.join(lead, ["s", "band"]).select("node", "n", "place", "lead"), percent)
    first = _linked(near, texts, width, shared, percent)
    known = stage(connected_components(first), "known")
    rest = _linked(_candidates(shared_rows, known, percent), texts, width, shared, percent)
    discard(shared_rows, known)
    groups = connected_components(first.union(rest))
    joined = stage(classes.join(groups, "node", "left").withColumn("c", F.coalesce("component", "node")), "joined")
    lowest = joined.groupBy("c").agg(F.min("rep").alias("component_id"))
    found = stage(joined.join(lowest, "c").select(F.col("node").alias("m1"), "component_id", "n_copies"), "components")
    discard(classes, joined)
    # Rows without a set or an id stand alone; their key is null.
    key = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("m1"))
    alone = sets.where(key.isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"))
    grouped = sets.where(key.isNotNull()).join(found, "m1").select("doc_id", "n", "component_id", "n_copies")
    return grouped.unionByName(alone).select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "n_copies"
    )
