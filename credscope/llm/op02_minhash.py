"""MinHash near-dedup with fast similarity sketching.

A sketch has one coordinate for each bin.  In each of the first rounds every
element of a set falls into a hashed bin with a hashed value; a bin keeps the
least value of the first round that reached it.  Rounds go on until every bin
is filled; the second half of the rounds puts all elements into one given bin
each, so no coordinate can stay empty.  Bands of coordinates that agree make
buckets of candidates, which are confirmed on the full sets (64-bit numbers of
the word sequences).

Documents with equal word sequences are one node.  A bucket of ``SMALL`` nodes
at most is compared pair by pair.  A larger one, such as a family of near
copies, is settled without all its pairs, and without losing one of its links:

* All nodes are compared with a pivot, the node of a sample of the bucket whose
  sketch agrees most with the others'.  Nodes linked to it join its component.
  Buckets whose pivots are of one component become one bucket, with one of the
  pivots: a family is settled once and not once a band.
* For the others only differences from the pivot count.  Let D(x) be the set
  by which x and the pivot differ.  Then x and y differ by the elements that
  are in just one of D(x) and D(y), so a link between them means that D(x) and
  D(y) share a certain number of elements, which follows from the sizes.  It is
  at least one where x isn't linked to the pivot.
* Sets that share so many elements share one among the rarest of each (the
  prefix principle).  Of the two the one that has to share less leads: the other
  needs as much, so few of its differences have to be looked up, most of them
  its own.  Nodes whose rarest differences meet make new buckets, one for an
  element and a range of what the following node has to share.  Where few nodes
  lead or few follow, the pairs that come early enough in both orders are
  compared; other buckets are settled likewise.

What near copies have in common, with the pivot or with each other, doesn't
bring them together: edits of their own are rare differences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, table
from .components import components
from .words import join_texts, mix64, sequence_hashes, slices, word_hashes

SHINGLE = 5
THRESHOLD = 80
BINS = 96
#: A pair agrees in no band of ``ROWS`` chosen coordinates, and is no candidate,
#: with a probability of 1.3e-5 at a similarity of 0.85 and 4e-4 at 0.8
#: (4 million simulated pairs).  Nothing else is lost.
BANDS, ROWS = 40, 6
#: Buckets up to this size are compared pair by pair; those of an element and a
#: range, where nearly all pairs come early enough in both orders, up to ``FEW``.
SMALL, FEW = 8, 64
#: Nodes of a larger bucket among which its pivot is found, and the parts into
#: which its rows are dealt.
SAMPLE, SALTS = 16, 16
#: Ranges of what a node needs, for nodes of a bucket that share an element.
LEVELS = 16

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 48) - 1)


def sketches(element: np.ndarray, owner: np.ndarray, sets: int, bins: int) -> np.ndarray:
    """Sketch of each set, one row each.  ``element``: hashes of the elements;
    ``owner``: the set of each (every set has one at least)."""
    out = np.full(sets * bins, _FULL)
    for turn in range(2 * bins):
        x = mix64(element ^ mix64(np.array([turn + 1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        place = ((x >> np.uint64(48)) * np.uint64(bins)) >> np.uint64(16) if turn < bins else np.full(len(x), turn - bins)
        np.minimum.at(out, owner * bins + place.astype(np.int64), (np.uint64(turn) << np.uint64(48)) | (x & _LOW))
        open_set = (out.reshape(sets, bins) == _FULL).any(axis=1)
        if not open_set.any():
            break
        keep = open_set[owner]
        element, owner = element[keep], owner[keep]
    return out.reshape(sets, bins)


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts and the text of each, by text."""
    buf, begin = join_texts(texts)
    words, starts, _ = word_hashes(buf)
    first = np.searchsorted(starts, begin)
    count = np.diff(first)
    parts, owners = [], []
    if len(words) >= n:
        grams = sequence_hashes(words, n)
        doc = np.repeat(np.arange(len(texts)), count)
        whole = np.arange(len(grams)) + n <= first[1:][doc[: len(grams)]]
        parts.append(grams[whole])
        owners.append(doc[: len(grams)][whole])
    for i in np.flatnonzero((count > 0) & (count < n)):
        parts.append(sequence_hashes(words[first[i] : first[i + 1]], int(count[i])))
        owners.append(np.array([i]))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    element, owner = np.concatenate(parts), np.concatenate(owners).astype(np.int64)
    order = np.lexsort((element, owner))
    element, owner = element[order], owner[order]
    fresh = np.concatenate(([True], (element[1:] != element[:-1]) | (owner[1:] != owner[:-1])))
    return element[fresh], owner[fresh]


def _key(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()[:16]


def _signatures(n: int):
    """doc_id, text, text_hash -> these without text, n_shingles, class, sig: 16 bits of each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, 1):
            texts = [t.lower() for t in texts]
            element, owner = shingle_sets(texts, n)
            sizes = np.bincount(owner, minlength=len(texts))
            used = np.flatnonzero(sizes)
            short = sketches(element, np.searchsorted(used, owner), len(used), BINS).astype("<u2")
            sig = [None] * len(texts)
            for i, x in zip(used, short):
                sig[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array([_key(t.split()) for t in texts], pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "text_hash", "n_shingles", "class", "sig"])

    return run


def _bands(bands: int, rows: int):
    """node, sig -> bucket, node: a bucket for each band."""
    columns = [np.random.default_rng([0, i]).permutation(BINS)[:rows] for i in range(bands)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            sig = np.frombuffer(b"".join(x.as_py() for x in batch.column(1)), dtype="<u2").reshape(len(batch), BINS).astype(np.uint64)
            for i, c in enumerate(columns):
                key = mix64(np.full(len(batch), i + 1, dtype=np.uint64))
                for j in c:
                    key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + sig[:, j])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], names=["bucket", "node"])

    return run


def _medoids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, sample (array of node, sig) -> bucket, pivot: the sample's node that agrees most with the others."""
    for batch in batches:
        pivots = []
        for sample in batch.column(1).to_pylist():
            sample.sort(key=lambda x: x["node"])
            sig = np.frombuffer(b"".join(x["sig"] for x in sample), dtype="<u2").reshape(-1, BINS)
            pivots.append(sample[int((sig[:, None] == sig[None]).sum(axis=(1, 2)).argmax())]["node"])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pivots, pa.int64())], names=["bucket", "pivot"])


def least_agreement(similarity: float, miss: float = 1e-9) -> int:
    """Coordinates of which sketches of two sets of at least this similarity
    agree in fewer with a probability of at most ``miss`` (Chernoff bound)."""
    for k in range(int(BINS * similarity), 0, -1):
        p = k / BINS
        if BINS * (p * np.log(p / similarity) + (1 - p) * np.log((1 - p) / (1 - similarity))) > -np.log(miss):
            return k
    return 0


def _agreeing(least: int):
    """a, b, both signatures -> the pairs that agree in enough coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(v.as_py() for v in batch.column(i)), dtype="<u2").reshape(-1, BINS) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= least))

    return run


def _full_sets(n: int):
    """node, class, text -> node, elements (sorted, 8 bytes each), where the class is the text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, 2):
            texts = [t.lower() for t in texts]
            right = [_key(t.split()) == c.as_py() for t, c in zip(texts, part.column(1))]
            element, owner = shingle_sets(texts, n)
            edge = np.searchsorted(owner, np.arange(len(texts) + 1))
            picked = [i for i, r in enumerate(right) if r]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(picked, pa.int64())), pa.array([element[edge[i] : edge[i + 1]].astype("<u8").tobytes() for i in picked], pa.binary())], names=["node", "elements"])

    return run


def _elements(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), dtype="<u8")


def _shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places in sorted ``y`` of the elements that ``x`` has too."""
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    return x[at] == y


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, elements of both -> a, b, size of the intersection, both sizes."""
    for batch in batches:
        out, last, x = [], None, None
        for a, b in zip(batch.column(2), batch.column(3)):
            if last is None or a.as_buffer() != last:
                last, x = a.as_buffer(), _elements(a)
            y = _elements(b)
            out.append((int(_shared(x, y).sum()), len(x), len(y)))
        both, size_a, size_b = (pa.array([o[i] for o in out], pa.int64()) for i in range(3))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), both, size_a, size_b], names=["a", "b", "both", "size_a", "size_b"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """..., elements of the node, of the pivot -> ..., elements that just one has."""
    for batch in batches:
        found = [np.setxor1d(_elements(x), _elements(y), assume_unique=True).view(np.int64) for x, y in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names[:-2], "differs"])


def _side(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.select(F.col("node").alias(name), F.col(value).alias(f"{value}_{name}"))


def _salted(info: DataFrame) -> DataFrame:
    """A row for each salt, for joins with buckets of any size."""
    return info.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _mixed(entries: DataFrame) -> DataFrame:
    """The buckets that hold nodes of two components, leading and following ones."""
    mixed = entries.groupBy("bucket").agg((F.min("comp") != F.max("comp")).alias("x"), F.max("leads").alias("y"), F.max("follows").alias("z"))
    mixed = mixed.where("x AND y AND z").select("bucket")
    return entries.join(mixed, "bucket", "left_semi")


def _unit(threshold: int) -> int:
    """A link of x and y takes at least (need(x) + need(y)) / unit common differences from a pivot."""
    return 2 * (100 + threshold)


def _pairs(few: DataFrame, threshold: int) -> DataFrame:
    """a, b: of each bucket the pairs of a leading and a following node of two
    components, the leading one of less need, whose common element comes early
    enough in both orders: what comes after it can hold what a link takes."""
    other = few.where("follows").select("bucket", *[F.col(c).alias(f"{c}_b") for c in ("node", "comp", "need", "gap", "place")])
    need = F.col("need") + F.col("need_b")
    early = ((F.col("gap") + 1 - F.col("place")) * _unit(threshold) >= need) & ((F.col("gap_b") + 1 - F.col("place_b")) * _unit(threshold) >= need)
    before = (F.col("need") < F.col("need_b")) | ((F.col("need") == F.col("need_b")) & (F.col("node") < F.col("node_b")))
    met = few.where("leads").join(other, "bucket").where(before & early & (F.col("comp") != F.col("comp_b")))
    return met.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def _settle(ws: Workspace, entries: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: int) -> DataFrame | None:
    """u, v: links' components (see ``components``) of the nodes in the buckets
    of ``entries`` (bucket, node, comp, and as in ``_rest`` need, gap, place,
    leads, follows).  ``nodes``: node, sig.  ``sets``: node, elements."""
    labels = late = None
    families = True  # of band buckets; later ones are apart by their common elements
    agreeing = _agreeing(least_agreement(threshold / 100))
    while not entries.isEmpty():
        size = F.least(F.count_if("leads"), F.count_if("follows"))
        large = ws.store(entries.groupBy("bucket").agg(size.alias("size")).where(F.col("size") > (SMALL if families else FEW)).select("bucket"), "large")
        settled = large.isEmpty()
        entries = entries.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
        flagged = entries if settled else ws.store(entries.join(_salted(large).withColumn("large", F.lit(True)), ["bucket", "salt"], "left"), "flagged")

        # buckets with few leading or few following nodes: pairs whose sketches leave a link any chance
        pairs = _pairs(flagged if settled else flagged.where("large IS NULL"), threshold)
        pairs = pairs.join(_side(nodes, "a", "sig"), "a").join(_side(nodes, "b", "sig"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(agreeing, "a long, b long")

        # large buckets: every node with the bucket's pivot
        if not settled:
            many = flagged.where("large")
            sample = many.groupBy("bucket", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(SAMPLE)).alias("part")).agg(F.min_by("node", F.xxhash64("node", F.lit(2))).alias("node"))
            sample = sample.join(nodes, "node").groupBy("bucket").agg(F.collect_list(F.struct("node", "sig")).alias("sample"))
            pivots = ws.store(sample.mapInArrow(_medoids, "bucket long, pivot long"), "pivots")
            star = many.join(_salted(pivots), ["bucket", "salt"]).select("bucket", "salt", "node", "pivot", F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
            star = ws.store(star, "stars")
            pairs = pairs.union(star.where("a != b").select("a", "b"))

        tested = _tested(ws, pairs, sets)
        fresh = tested.where(_linked(threshold)).select(F.col("b").alias("u"), F.col("a").alias("v"))
        known = [e for e in (labels, late) if e is not None]
        labels = components(ws, reduce(DataFrame.union, [fresh, *known]))
        if settled:
            ws.drop(large, tested, *known)
            return labels
        entries, late = _rest(ws, star, tested, labels, sets, threshold, families)
        families = False
        ws.drop(large, flagged, pivots, star, tested, *known)
    return labels if late is None or late.isEmpty() else components(ws, labels.union(late))


def _tested(ws: Workspace, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, both, size_a, size_b of the distinct pairs a, b."""
    pairs = ws.store(pairs.distinct(), "pairs")
    full = pairs.join(_side(sets, "a", "elements"), "a").join(_side(sets, "b", "elements"), "b").select("a", "b", "elements_a", "elements_b")
    tested = ws.store(full.mapInArrow(_overlap, "a long, b long, both long, size_a long, size_b long"), "tested")
    ws.drop(pairs)
    return tested


def _linked(threshold: int) -> Column:
    return F.col("both") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("both")) * threshold


def _rest(ws: Workspace, star: DataFrame, tested: DataFrame, labels: DataFrame, sets: DataFrame, threshold: int, families: bool) -> tuple[DataFrame, DataFrame]:
    """The buckets still to be settled after the stars (with ``families``,
    buckets with pivots of one component as one); and links (u, v) found on the
    way.

    Of the buckets: bucket, node, comp, need, gap (number of differences from
    the pivot), place of the bucket's element among these in the order of
    rarity, leads, follows.  A link of x and y takes at least (need(x) +
    need(y)) / unit common differences from the pivot.  The one of less need
    leads: it can only be linked where the first common element comes early,
    for it needs as much of the other.  The place also bounds the other's need,
    so an element has a bucket for each of at most ``LEVELS`` + 2 ranges of
    need, and leading nodes are in those that their partners can be in."""
    unit = _unit(threshold)
    comp = lambda df, name, out: df.join(labels.select(F.col("u").alias(name), F.col("v").alias(out)), name, "left").withColumn(out, F.coalesce(out, name))
    home = ws.store(comp(star.select("bucket", "pivot").distinct(), "pivot", "home"), "homes")
    if families:
        rows = star.join(_salted(home.select("bucket", "home")), ["bucket", "salt"]).select(F.col("home").alias("bucket"), "salt", "node").distinct()
        size = star.groupBy("bucket").count().join(home, "bucket").groupBy("home", "pivot").agg(F.sum("count").alias("n"))
        home = size.groupBy(F.col("home").alias("bucket")).agg(F.max_by("pivot", F.struct("n", "pivot")).alias("pivot")).withColumn("home", F.col("bucket"))
    else:
        rows = star.select("bucket", "salt", "node").distinct()
    rows = comp(rows, "node", "comp").join(_salted(home), ["bucket", "salt"])
    merged = ws.store(rows.where("node != pivot").withColumn("a", F.least("node", "pivot")).withColumn("b", F.greatest("node", "pivot")), "merged")
    outsides = merged.join(_salted(merged.where("comp != home").select("bucket").distinct()), ["bucket", "salt"], "left_semi")
    if families:
        outsides = ws.store(outsides, "outsides")
        tested = _tested(ws, outsides.select("a", "b"), sets)

    size = F.when(F.col("node") == F.col("a"), F.col("size_a")).otherwise(F.col("size_b"))
    gap = F.col("size_a") + F.col("size_b") - 2 * F.col("both")
    rows = outsides.join(tested, ["a", "b"]).withColumn("now", (F.col("comp") != F.col("home")) & _linked(threshold))
    rows = ws.store(rows.select("bucket", "salt", "node", "pivot", "home", F.when(F.col("now"), F.col("home")).otherwise(F.col("comp")).alias("comp"), "now", size.alias("size"), gap.alias("gap"), ((100 + threshold) * gap - (100 - threshold) * size).alias("need")), "rows")
    late = ws.store(rows.where("now").select(F.greatest("node", "pivot").alias("u"), F.least("node", "pivot").alias("v")), "late")
    inside = F.col("comp") == F.col("home")
    # buckets with nodes outside the pivot's component, the least need of these, whether they are of several components, and the ranges' width
    outside = [F.when(~inside, F.col(c)) for c in ("need", "comp")]
    width = F.greatest(F.lit(unit), F.ceil(F.max("size") * 2 * (100 - threshold) / LEVELS)).alias("width")
    outer = rows.groupBy("bucket").agg(F.min(outside[0]).alias("outer"), (F.min(outside[1]) != F.max(outside[1])).alias("several"), width).where("outer IS NOT NULL")
    # elements of the sorted differences among which a common one lies, if there is a link
    most = F.floor((100 - threshold) * F.col("size") / threshold) + 1  # linked sets differ by fewer than this
    prefix = lambda other: F.least(most, F.col("gap") - F.ceil((F.col("need") + other) / unit) + 1).cast("long")
    left = ws.store(rows.join(_salted(outer), ["bucket", "salt"]).withColumn("outward", prefix(F.col("outer"))), "outward")
    inner = left.where(inside & (F.col("outward") > 0)).groupBy("bucket").agg(F.min("need").alias("inner"))
    full = left.join(_salted(inner), ["bucket", "salt"], "left")
    # the least need of a node's partners
    least = F.when(inside, F.col("outer")).otherwise(F.least("inner", F.when(F.col("several"), F.col("outer"))))
    full = full.withColumn("least", least).where("least IS NOT NULL").withColumn("reach", prefix(F.col("least"))).withColumn("lead", prefix(F.greatest("need", "least")))
    full = full.select("bucket", "node", "comp", "need", "reach", "lead", "least", "width", "pivot").where("reach > 0")
    full = full.join(_side(sets, "node", "elements"), "node").join(_side(sets, "pivot", "elements"), "pivot")
    full = full.select("bucket", "node", "comp", "need", "reach", "lead", "least", "width", "elements_node", "elements_pivot")
    full = full.mapInArrow(_differences, "bucket long, node long, comp long, need long, reach long, lead long, least long, width long, differs array<long>")
    held = ws.store(full.select("bucket", "node", "comp", "need", "reach", "lead", "least", "width", F.size("differs").cast("long").alias("gap"), F.explode("differs").alias("element")), "differences")

    shared = held.groupBy("bucket", "element").count().where("count > 1")
    of_node = Window.partitionBy("bucket", "node")
    # differences of one node only come first in the order, and need no rows
    place = F.row_number().over(of_node.orderBy("count", "element")) + F.col("gap") - F.count("*").over(of_node)
    ranked = held.join(shared, ["bucket", "element"]).withColumn("place", place).where("place <= reach")
    level = lambda need: F.floor(need / F.col("width"))
    partners = F.sequence(level(F.greatest("need", "least")), level((F.col("gap") + 1 - F.col("place")) * unit - F.col("need")))
    leading = F.transform(F.when(F.col("place") <= F.col("lead"), partners), lambda x: F.struct(x.alias("level"), F.lit(True).alias("leads")))
    roles = F.concat(F.array(F.struct(level(F.col("need")).alias("level"), F.lit(False).alias("leads"))), F.coalesce(leading, F.array().cast("array<struct<level:bigint,leads:boolean>>")))
    new = ranked.withColumn("role", F.explode(roles)).select(F.xxhash64("bucket", "element", "role.level").alias("bucket"), "node", "comp", "need", "gap", "place", "role.leads", (~F.col("role.leads")).alias("follows"))
    new = ws.store(new, "met")
    entries = ws.store(_mixed(new), "entries")
    ws.drop(merged, outsides, rows, left, held, new, *([tested] if families else []))
    return entries, late


def near_groups(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash: one row per row.

    Documents are linked when 100 * intersection >= threshold * union of their
    sets of ``shingle`` words (A-Z in lower case; fewer words: the sequence as
    a whole).  ``component_id`` is the smallest doc_id reachable; ``kept``
    marks the rows that carry it.

    Null, empty and white texts have no shingles and are linked with nothing.
    Equal texts are always linked, so rows that repeat a doc_id and text share
    its component; a doc_id repeated with another text is another document.
    Null doc_ids take part and are larger than any (a component of nulls alone
    has a null id).  Texts are used whole.  Other columns are ignored; an empty
    table gives no rows.  Memory: a slice of texts, or the longest text.
    """
    ws = Workspace(docs.sparkSession, "near-dedup")
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    slim = ws.store(picked.mapInArrow(_signatures(shingle), "doc_id long, text_hash long, n_shingles long, class binary, sig binary"), "sketches")
    some = slim.where("n_shingles > 0")
    classes = ws.store(some.groupBy("class").agg(F.min("doc_id").alias("first")).withColumn("node", F.monotonically_increasing_id()), "classes")

    # rows stored several times give their node once
    reps = some.join(classes, "class").where(F.col("doc_id").eqNullSafe(F.col("first"))).dropDuplicates(["node"]).select("node", "sig")
    reps = ws.store(reps, "nodes")
    # in a band's bucket every node leads and follows, and nothing is known of its differences
    open_to_all = [F.lit(0).cast("long").alias(c) for c in ("need", "gap", "place")]
    bands_of = reps.mapInArrow(_bands(bands, rows), "bucket long, node long").select("bucket", "node", F.col("node").alias("comp"), *open_to_all, F.lit(True).alias("leads"), F.lit(True).alias("follows"))
    buckets = ws.store(_mixed(bands_of), "buckets")
    wanted = ws.store(buckets.select("node").distinct(), "wanted")
    of_class = classes.join(wanted, "node")
    found = picked.join(of_class, picked.doc_id.eqNullSafe(of_class["first"])).select("node", "class", "text")
    sets = ws.store(found.mapInArrow(_full_sets(shingle), "node long, elements binary").dropDuplicates(["node"]), "sets")
    nodes = ws.store(reps.join(wanted, "node").select("node", "sig"), "signatures")
    labels = _settle(ws, buckets, nodes, sets, threshold)
    ws.drop(reps, buckets, wanted, sets, nodes)

    named = classes.select("class", "first", "node")
    if labels is not None:
        named = named.join(labels, named.node == labels.u, "left").select("class", "first", F.coalesce("v", "node").alias("node"))
    least = named.groupBy("node").agg(F.min("first").alias("component_id"))
    of_class = named.join(least, "node").select("class", "component_id")
    rows_out = slim.select("doc_id", "text_hash", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows_out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, one document of each
    component: the one with the smallest doc_id."""
    groups = near_groups(docs, shingle, threshold).where("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    groups = Workspace(docs.sparkSession, "near-dedup").store(groups, "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    return rows.join(groups, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash")), "left_anti").select("row.*")


def query(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"), shingle=3, threshold=85)
