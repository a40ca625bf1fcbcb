"""Near-duplicate groups: fast similarity sketching, banding, exact check.

Each document's set of word shingles gets a sketch of ``t`` coordinates.  In
round ``i`` every element is hashed to a bin and the least hash of a bin
becomes its coordinate, unless an earlier round filled it; from round ``t`` on
all elements go to the bin ``i - t``, so every coordinate is filled after
``2 t`` rounds (nearly always after two or three).  Bands of coordinates give
buckets; a pair in a bucket is a candidate and is confirmed on the full sets.

Documents with equal sets form one class and only classes are compared, so a
group of copies costs no pairs.  Every class of a bucket is compared with one
hub, the member that shares most buckets (in a group of edited copies that is
the original).  What the hubs do not link may still be linked with each other.
Relative to a common hub h, a set x differs by s(x) = x ^ h, and

    |x ^ y| = |s(x)| + |s(y)| - 2 |s(x) & s(y)|,

so two sets that are alike, of which one is not alike the hub, must share a
known number of difference elements.  Prefix and position filters on these
(few, mostly unique) elements leave hardly any pair to check, and drop none
that is alike.

What is shuffled are mostly hashes: keys of buckets first alone, to find those
that occur twice; a candidate pair's parities before its sets (two sets differ
by at least as many elements as the parities of their elements' slots do).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.llm import common as C

#: 32 bands of 5 coordinates: a pair of similarity 0.8 shares no bucket with probability 3e-6.
BANDS, ROWS = 32, 5
CACHE_WORDS = 400_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64's constants)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int, cache: dict[bytes, int]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text
    of fewer than ``size`` words is one shingle, one without words has none.
    """
    rows = [t.encode().lower().split() if t else [] for t in texts]
    if len(cache) > CACHE_WORDS:
        cache.clear()
    seen: set[bytes] = set()
    for words in rows:
        seen.update(words)
    cache.update((w, xxhash.xxh64_intdigest(w)) for w in seen if w not in cache)
    out = []
    for words in rows:
        if not words:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(size, len(h))
        s = np.full(len(h) - k + 1, (k * _GOLD) & _WRAP, dtype=np.uint64)
        for j in range(k):
            s = mix(s * np.uint64(0x100000001B3) + h[j : len(h) - k + 1 + j])
        s.sort()
        out.append(s[np.r_[True, s[1:] != s[:-1]]])
    return out


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Sketch of each non-empty set, a row of ``t`` coordinates."""
    empty = np.uint64(_WRAP)
    out = np.full((len(sets), t), empty)
    rows = np.arange(len(sets))
    elements, owner = np.concatenate(sets), np.repeat(rows, [len(s) for s in sets])
    for i in range(2 * t):
        h = mix(elements + np.uint64((_GOLD * (i + 1)) & _WRAP))
        value = (np.uint64(i) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        place = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        # earlier rounds have smaller values, so the least is that of the first round to fill the place
        np.minimum.at(out.reshape(-1), owner * t + place, value)
        rows = rows[(out[rows] == empty).any(axis=1)]
        if not len(rows):
            break
        if len(rows) < len(sets):
            open_ = np.zeros(len(sets), dtype=bool)
            open_[rows] = True
            keep = open_[owner]
            if not keep.all():
                elements, owner = elements[keep], owner[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to((np.arange(bands, dtype=np.uint64) + np.uint64(1)) * np.uint64(_GOLD), parts.shape[:2])
    for j in range(rows):
        key = mix(key * np.uint64(0x100000001B3) + parts[:, :, j])
    return key.view(np.int64)


def _words() -> dict[bytes, int]:
    """Hashes of the words that this worker has seen."""
    return C.kept(("hashes of words",), dict)


def set_features(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, text_key, n_shingles, node, keys`` of each row of ``doc_id,
    text``: ``node`` names the set (equal sets, equal names), ``keys`` its buckets."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").to_pylist(), size, _words())
        nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list[np.ndarray | None] = [None] * len(sets)
        if full:
            for i, k in zip(full, band_keys(sketches([sets[i] for i in full], bands * rows), bands, rows), strict=True):
                keys[i] = k
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            names=["doc_id", "text_key", "n_shingles", "node", "keys"])

    return C.map_arrow(docs, fn, "doc_id bigint, text_key bigint, n_shingles bigint, node binary, keys array<bigint>", size_of="text")


def bucket_members(rows: DataFrame, shared: C.Slots) -> DataFrame:
    """``key, node`` of rows ``node, keys``: the keys that ``shared`` holds, and a few others."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, lengths = batch.column("keys").flatten().to_numpy(), batch.column("keys").value_lengths().to_numpy()
        held = shared.hold(keys)
        of_row = np.repeat(np.arange(batch.num_rows), lengths)[held]
        return pa.RecordBatch.from_arrays([pa.array(keys[held], pa.int64()), batch.column("node").take(pa.array(of_row))],
                                          names=["key", "node"])

    return C.map_arrow(rows.select("node", "keys"), fn, "key bigint, node binary", size_of="keys")


def parities(s: np.ndarray) -> bytes:
    """Whether each slot has an odd number of the elements of ``s``: a bit a
    slot, the least power of two of slots that gives an element four."""
    slots = 1 << max(6, (4 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(slots - 1)).view(np.int64), minlength=slots) & 1, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """How many elements two sets of these :func:`parities` differ by at least."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):  # the parities of half as many slots
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``node, shingles, n, parity`` of each row of ``doc_id, text``."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").to_pylist(), size, _words())
        nodes = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
             pa.array([len(s) for s in sets], pa.int64()), pa.array([parities(s) for s in sets], pa.binary())],
            names=["node", "shingles", "n", "parity"])

    return C.map_arrow(docs, fn, "node binary, shingles array<bigint>, n bigint, parity binary", size_of="text")


def one_a_node(rows: DataFrame) -> DataFrame:
    """One row of each ``node`` of ``rows``; only rows of repeated nodes (and a few others) are shuffled for it."""
    repeated = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    some, single = C.split_by(rows, repeated, "node")
    first = some.groupBy("node").agg(*[F.first(c).alias(c) for c in rows.columns if c != "node"])
    return single.unionByName(first)


def perhaps_alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (``a, b``) whose sets may be alike by their parities; none that is alike is missing."""
    each = sets.select("node", "n", "parity")
    for x in ("a", "b"):
        pairs = pairs.join(each.select(*[F.col(c).alias(d) for c, d in zip(each.columns, (x, f"n_{x}", f"parity_{x}"), strict=True)]), x)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        least = map(least_difference, batch.column("parity_a").to_pylist(), batch.column("parity_b").to_pylist())
        least = np.fromiter(least, np.int64, batch.num_rows)
        total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        # |x ^ y| (100 + percent) <= (|x| + |y|) (100 - percent), if the two are alike
        return batch.select(["a", "b"]).filter(pa.array(least * (100 + percent) <= total * (100 - percent)))

    return C.map_arrow(pairs, fn, "a binary, b binary", size_of="parity_a").distinct()


def hub_differences(pairs: DataFrame, percent: int) -> DataFrame:
    """``hub, node, linked, n, s, prefix`` of rows ``hub, node, hub_set,
    node_set``: whether the two are alike, sizes of the node's set and of its
    difference to the hub's, and the first elements of that difference, those
    that only the node has before those that only the hub has.

    The prefix is long enough to share an element with the prefix of every set
    that is alike and has the same hub, unless both are alike the hub.
    """
    t = percent / 100
    c = (1 - t) / (1 + t)  # alike: the sets differ by at most c times their sizes
    # what tasks hand to Python are the differences, not the sets: a hub's would come once for each of its nodes
    own, gone = F.array_except("node_set", "hub_set"), F.array_except("hub_set", "node_set")
    pairs = pairs.select("hub", "node", F.size("hub_set").alias("n_hub"), F.size("node_set").alias("n"), F.size(own).alias("n_own"),
                         F.concat(own, gone).alias("difference"))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, values = batch.column("difference").offsets.to_numpy(), batch.column("difference").values.to_numpy().view(np.uint64)
        n_hub, n, n_own = (batch.column(x).to_numpy().astype(np.int64) for x in ("n_hub", "n", "n_own"))
        s = np.diff(at)
        alike = (n - n_own) * 100 >= (n_hub + n_own) * percent
        least = np.where(alike, s + c * (n_hub - n), s - c * n * (1 + 1 / t)) / 2
        length = s - np.maximum(1, np.ceil(least - 1e-6).astype(np.int64)) + 1
        prefixes = []
        for i in range(batch.num_rows):
            order = [x[np.argsort(mix(x))] for x in np.split(values[at[i] : at[i + 1]], [n_own[i]])]
            prefixes.append(np.concatenate(order)[: length[i]].view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column("hub"), batch.column("node"), pa.array(alike, pa.bool_()), pa.array(n, pa.int64()),
             pa.array(s, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
            names=["hub", "node", "linked", "n", "s", "prefix"])

    return C.map_arrow(pairs, fn, "hub binary, node binary, linked boolean, n bigint, s bigint, prefix array<bigint>", size_of="difference")


def pairs_beside_hubs(differences: DataFrame, root: DataFrame, percent: int) -> DataFrame:
    """``a, b``: the pairs of sets with a common hub that may be alike although
    the links so far do not connect them; none that is alike is missing."""
    t = percent / 100
    c = (1 - t) / (1 + t)
    # hubs with one row, or with rows that all are alike the hub, have no such pair
    hubs = differences.groupBy("hub").agg(F.count(F.lit(1)).alias("rows"), F.bool_and("linked").alias("linked")).where("rows > 1 AND NOT linked")
    hubs = C.stored(hubs.select("hub"), "hubs")
    rows = C.prefiltered(differences, hubs, "hub", bits=C.slot_bits(hubs.count()))
    # differences of alike sets differ by c (n + n_b) at most, and n_b is n / t at most: all but so many elements are shared
    first = F.slice("prefix", 1, F.floor(F.col("n") * c * (1 + 1 / t) + 1e-6).cast("int") + 1)
    rows = rows.withColumn("prefix", first).join(root, "node", "left").withColumn("root", F.xxhash64(F.coalesce("root", "node")))
    rows = rows.select(F.posexplode("prefix").alias("at", "element"), "hub", "node", "linked", "n", "s", "root")
    rows = rows.withColumn("met", F.xxhash64("hub", "element")).drop("hub", "element")
    other = rows.select("met", *[F.col(x).alias(f"{x}_b") for x in ("node", "linked", "n", "s", "root", "at")])
    met = rows.where(~F.col("linked")).join(other, "met").where("root <> root_b AND (linked_b OR node < node_b)")
    met = met.where(F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent)
    # elements still to come on either side must make up the shared ones that the pair needs
    needed = (F.col("s") + F.col("s_b") - c * (F.col("n") + F.col("n_b"))) / 2
    met = met.where(F.least(F.col("s") - F.col("at"), F.col("s_b") - F.col("at_b")) >= needed - 1e-6)
    return met.select(F.greatest("node", "node_b").alias("a"), F.least("node", "node_b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that is not the least of its component in
    the graph of ``links`` (columns ``a``, ``b``).

    Every node takes its least smaller neighbour as parent, parents are
    followed to the end by pointer jumping, and the links between the roots
    found are what the next turn works on.
    """
    edges = C.stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not edges.isEmpty():
        parent = C.stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "parents")
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            if parent.join(up, "root", "left_semi").isEmpty():
                break
            parent = C.stored(parent.join(up, "root", "left").select(
                "node", F.coalesce("higher", "root").alias("root")), "parents")
        labels = parent if labels is None else C.stored(_lifted(labels, parent).unionByName(parent), "labels")
        moved = _lifted(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), parent)
        moved = _lifted(moved.select(F.col("root").alias("node"), F.col("node").alias("root")), parent)
        moved = moved.where("node <> root").select(F.greatest("node", "root").alias("a"), F.least("node", "root").alias("b"))
        edges = C.stored(moved.distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if labels is None else labels


def _lifted(labels: DataFrame, parent: DataFrame) -> DataFrame:
    up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
    return labels.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))


def near_duplicates(docs: DataFrame, shingle_size: int = 5, similarity: float = 0.8, text_col: str = "text",
                    id_col: str = "doc_id", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, text_key, n_shingles, component, component_id, kept`` of every row.

    Two rows are linked when the Jaccard similarity of their shingle sets is
    at least ``similarity``, checked on the full sets; ``component_id`` is the
    least id reachable over links, itself included; ``kept`` marks the row
    with that id; ``component`` names the component and is null without words.  A null or empty text, or one without words, has no shingles
    and is linked with nothing.  Every input row gives one row: repeated rows
    are in one component, a null id is never the least unless all are null.
    """
    spark = docs.sparkSession
    C.ready(spark)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), C.text_or_empty(text_col).alias("text"))
    percent = round(similarity * 100)
    features = C.stored(set_features(docs, shingle_size, bands, rows), "features")
    full = features.where("node is not null")
    classes = C.stored(full.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows")), "classes")
    copied, alone = C.split_by(full, classes.where("rows > 1"), "node")
    copied = copied.join(classes, (copied.node == classes.node) & copied.doc_id.eqNullSafe(classes.rep), "left_semi")
    lead = alone.unionByName(copied)

    # buckets with more than one class; of buckets with the same members, one
    often = C.stored(lead.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
                     .where("rows > 1").select("key"), "keys")
    keyed = C.stored(bucket_members(lead, C.Slots(spark, often, "key", 32)), "keyed")
    members = keyed.withColumn("h", F.xxhash64("node")).groupBy("key").agg(
        F.min("h").alias("x"), F.max("h").alias("y"), F.expr("bit_xor(h)").alias("all"),
        F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("sum"), F.count(F.lit(1)).alias("size"))
    shared = members.where("x <> y").groupBy("x", "y", "all", "sum", "size").agg(
        F.min("key").alias("key"), (F.col("size") * F.count(F.lit(1))).alias("weight")).select("key", "weight")
    buckets = C.stored(keyed.join(shared, "key").distinct(), "buckets")
    # the full sets of their classes, each from the row that leads it
    nodes = buckets.select("node").distinct()
    wanted = C.stored(lead.join(nodes, "node", "left_semi").select("doc_id", "text_key"), "wanted")
    rows = docs.withColumn("text_key", F.xxhash64("text"))
    bits = C.slot_bits(wanted.count(), 32)
    some = C.prefiltered(rows, wanted, "doc_id", "text_key", bits=bits).select("doc_id", "text")
    # a copy may slip through the bitmap: one row a class
    sets = C.stored(full_sets(some, shingle_size), "sets")
    each = one_a_node(sets.select("node", "shingles"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = C.stored(perhaps_alike(pairs, one_a_node(sets.select("node", "n", "parity")), percent), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        few = C.prefiltered(sets.select("node", "shingles"), ends, "node", bits=C.slot_bits(2 * pairs.count(), 32))
        few = few.groupBy("node").agg(F.first("shingles").alias("shingles"))
        a = few.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        b = few.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - both
        return pairs.join(a, "a").join(b, "b").where(both * 100 >= union * percent).select("a", "b").distinct()

    # every class of a bucket against the member that shares most buckets
    weight = buckets.groupBy("node").agg(F.sum("weight").alias("weight"))
    hubs = buckets.drop("weight").join(weight, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("hub"))
    star = buckets.join(hubs, "key").where("node <> hub").select("hub", "node").distinct()
    # both sides rename alike, so that Spark deals the sets out once for the two
    hub_sets = each.select(F.col("node").alias("hub_node"), F.col("shingles").alias("hub_set"))
    node_sets = each.select(F.col("node").alias("set_node"), F.col("shingles").alias("node_set"))
    star = star.join(hub_sets, F.col("hub") == F.col("hub_node")).join(node_sets, F.col("node") == F.col("set_node"))
    differences = C.stored(hub_differences(star.select("hub", "node", "hub_set", "node_set"), percent), "differences")
    links = differences.where("linked").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    root = components(links)
    more = C.stored(confirmed(pairs_beside_hubs(differences, root, percent)), "confirmed")
    root = components(links.unionByName(more))

    least = classes.join(root, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    groups = least.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_node = least.join(groups, "root").select("node", F.col("root").alias("component"), "component_id")
    out = features.join(of_node, "node", "left")
    smallest = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", "component", smallest.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, shingle_size: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each near-duplicate component of ``docs``: the one of the
    least id (of rows that share that id, one); rows without words, which are
    linked with nothing, stay, once each if they are repeated."""
    groups = C.stored(near_duplicates(docs, shingle_size, similarity), "groups").where("kept")
    alone = groups.where("component is null").select("doc_id", "text_key").distinct()
    first = groups.where("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
    keep = alone.unionByName(first.select("k.*"))
    k, k_id, k_key = C.tag("k"), C.tag("id"), C.tag("key")
    keep = keep.select(F.col("doc_id").alias(k_id), F.col("text_key").alias(k_key))
    keyed = docs.withColumn(k, F.xxhash64(C.text_or_empty()))
    out = keyed.join(keep, keyed["doc_id"].cast("bigint").eqNullSafe(F.col(k_id)) & (keyed[k] == F.col(k_key)), "left_semi")
    if not groups.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", k])  # the input repeats rows
    return out.drop(k)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over two-word shingles."""
    out = near_duplicates(C.table(spark, sf_dir, "documents"), shingle_size=2)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 2 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS s
  FROM w, unnest(range(1, greatest(len(ws), 2))) AS t(i) WHERE len(ws) > 0),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
co AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
       GROUP BY ALL),
li AS (SELECT a, b FROM co JOIN sz p ON p.doc_id = a JOIN sz q ON q.doc_id = b
       WHERE 100 * x >= 80 * (p.n + q.n - x)),
un AS (SELECT a, b FROM li UNION SELECT b, a FROM li),
re AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT re.a, un.b FROM re JOIN un ON un.a = re.b),
mi AS (SELECT a, min(b) AS c FROM re GROUP BY a)
SELECT d.doc_id, coalesce(sz.n, 0) AS n_shingles, mi.c AS component_id, d.doc_id = mi.c AS kept
FROM documents d JOIN mi ON mi.a = d.doc_id LEFT JOIN sz ON sz.doc_id = d.doc_id
"""
