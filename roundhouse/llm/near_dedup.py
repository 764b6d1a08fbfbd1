"""Near-duplicate detection by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

Shingles are runs of five words. A shingle weighs tf * idf. Document frequencies are counted over every document in
DF_ROWS tables of 2**20 hashed buckets; what other shingles put into a bucket on average, and three times the chance
deviation of that, is taken off, and the least of a shingle's estimates counts. The tables don't fill up: what remains
as noise is a smaller share of a larger corpus. idf falls from 1 (in one document) to IDF_FLOOR (in every document)
with log(N / df) / log(N). The damping keeps copies in a large group alike: a passage they all share isn't worth less
than four fifths of what tells them apart.

Every document draws HASHES weighted samples; BANDS bands of ROWS samples make its buckets. Documents whose
words are all equal are one node. In a bucket every node is verified against a leader by weighted Jaccard
similarity, then against eight more where components still differ. What is left open is compared in blocks of
BLOCK_NODES nodes and BLOCK_BYTES of shingles inside tasks: in each bucket the nodes outside of its largest component, with each other and with
that component's. Pairs that are connected already are skipped, and only links leave a task. So no group of copies is
expanded into rows of pairs, and a stray node beside a large group costs that group one more row a node.

Candidates whose samples agree in fewer than `agree` of HASHES places are not verified: with AGREE = 50, a pair of
similarity 0.8 does so with a chance of 8.7e-5, one in 11,450. agree=0 verifies every pair that shares a band; a pair
of similarity 0.8 shares none with a chance of 0.17 %.

A document without words (null, empty) is near to none. Rows with a null doc_id take part in counts only.
Repeated rows are one node; of repeated doc_ids one row stays. Extra columns are passed over.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhouse.llm.common import few, forget, slices, small_batches, spans, stored, texts_of
from roundhouse.llm.textgrid import WordGrid, mix, shingles

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 5
HASHES = BANDS * ROWS
AGREE = 50
BLOCK_NODES = 256
#: Bytes of the packed shingles of a block's nodes, as far as these are dealt evenly; a task holds two blocks and their weights.
BLOCK_BYTES = 16 << 20
#: doc_ids of a lookup that may be broadcast, 16 MB; a larger one is joined by a shuffle.
SMALL = 2_000_000
DF_BITS, DF_ROWS, BLOCK = 20, 2, 1 << 10
IDF_FLOOR = 0.8
_LOW = np.uint64((1 << 52) - 1)


def weighted_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) for each distinct shingle, sorted by document and shingle; and a hash of all words in order."""
    grid = WordGrid(texts)
    runs, doc = shingles(grid, WIDTH)
    keys = np.sort((doc.astype(np.uint64) << np.uint64(52)) | (runs >> np.uint64(12)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    place = np.arange(len(runs)) - np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])[doc]
    whole = np.zeros((2, len(texts)), np.uint64)
    if len(runs):
        with np.errstate(over="ignore"):
            begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            for k in (0, 1):
                whole[k, doc[begin]] = np.add.reduceat(mix(runs + mix(place.astype(np.uint64) + np.uint64(7 + k))), begin)
    return (keys[first] >> np.uint64(52)).astype(np.int64), keys[first] & _LOW, counts, whole


def _spans(texts: list[str]):
    """Chunks of at most 4096 documents: their number takes 12 bits of a sort key."""
    for a, b in spans(texts):
        for c in range(a, b, 4096):
            yield c, min(c + 4096, b)


def buckets_of(shingle: np.ndarray, row: int) -> np.ndarray:
    """The bucket of each shingle in one of the DF_ROWS tables; each takes other bits."""
    return ((shingle >> np.uint64(row * DF_BITS)) & np.uint64((1 << DF_BITS) - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per hashed bucket, a row per table, and documents with words, over all rows. Tasks send blocks of counts, summed by block."""

    def count(batches):
        counts, n, waiting, size = np.zeros(DF_ROWS << DF_BITS, np.int64), 0, [], 0

        def flush():
            for row in range(DF_ROWS):
                np.add(counts[row << DF_BITS : (row + 1) << DF_BITS], np.bincount(buckets_of(np.concatenate(waiting), row), minlength=1 << DF_BITS), out=counts[row << DF_BITS : (row + 1) << DF_BITS])

        for batch in slices(batches, 0):
            texts = texts_of(batch.column(0))
            for a, b in _spans(texts):
                doc, shingle, _, _ = weighted_sets(texts[a:b])
                n += len(np.unique(doc))
                waiting.append(shingle)
                size += len(shingle)
                if size >= 1 << 20:
                    flush()
                    waiting, size = [], 0
        if waiting:
            flush()
        blocks = counts.astype(np.int32).reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([blocks[k].tobytes() for k in used], pa.binary()), pa.array([n] + [0] * (len(used) - 1) if len(used) else [], pa.int64())], names=["block", "counts", "n"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        total: dict[int, int] = {}
        for batch in batches:
            for block, counts, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
                total[block] = total.get(block, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary()), pa.array(list(total.values()), pa.int64())], names=["block", "counts", "n"])

    kind = "block int, counts binary, n long"
    rows = docs.select("text").mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).collect()  # 8 MB a table at most
    df = np.zeros((DF_ROWS << DF_BITS) // BLOCK * BLOCK, np.int64).reshape(-1, BLOCK)
    for r in rows:
        df[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return df.reshape(DF_ROWS, -1), sum(r["n"] for r in rows)


def idf_table(df: np.ndarray, n: int) -> np.ndarray:
    """idf per table and bucket. A shingle's own is the largest of its buckets' (see idf_of)."""
    load = df.sum(1, keepdims=True) / df.shape[1]  # what a bucket holds of other shingles, on average
    own = np.clip(df - load - 3 * np.sqrt(load), 1, max(n, 1))
    return (IDF_FLOOR + (1 - IDF_FLOOR) * np.log(max(n, 1) / own) / np.log(max(n, 2))).astype(np.float32)


def idf_of(shingle: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = idf[0][buckets_of(shingle, 0)]
    for row in range(1, DF_ROWS):
        out = np.maximum(out, idf[row][buckets_of(shingle, row)])
    return out


@cache
def _gamma() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution for 16 random bits, and their logarithms."""
    want = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.concatenate([np.geomspace(1e-4, 1, 200_000), np.linspace(1, 40, 400_000)[1:]])
    r = np.interp(want, 1 - np.exp(-x) * (1 + x), x)
    return r.astype(np.float32), np.log(r).astype(np.float32)


@cache
def _seeds() -> np.ndarray:
    return mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def icws(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents that have shingles, and for each of them HASHES consistent weighted samples (Ioffe 2010).

    For element k with weight S and r, c ~ Gamma(2, 1), b ~ U(0, 1) fixed by k and the sample's number:
    t = floor(ln S / r + b) and ln a = ln c - r (t - b + 1); the sample is (k, t) of the least a.
    """
    gamma, log_gamma = _gamma()
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    logs = np.log(weight).astype(np.float32)
    out = np.empty((len(begin), HASHES), np.uint64)
    lanes = np.empty(len(shingle), np.uint64)
    for k, seed in enumerate(_seeds()):
        np.multiply(shingle, seed, out=lanes)
        np.bitwise_xor(lanes, lanes >> np.uint64(31), out=lanes)
        np.multiply(lanes, np.uint64(0x9FB21C651E98DF25), out=lanes)
        np.bitwise_xor(lanes, lanes >> np.uint64(28), out=lanes)
        part = lanes.view(np.uint16).reshape(-1, 4)
        r = gamma.take(part[:, 0])
        b = part[:, 1].astype(np.float32) * np.float32(1 / 65536)
        t = np.floor(logs / r + b)
        a = log_gamma.take(part[:, 2]) - r * (t - b + np.float32(1))
        order = a.view(np.uint32)
        order = np.where(order >> np.uint32(31), ~order, order | np.uint32(0x80000000))
        tag = (lanes >> np.uint64(32)).astype(np.uint32) ^ t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1)
        out[:, k] = np.minimum.reduceat((order.astype(np.uint64) << np.uint64(32)) | tag, begin) & np.uint64(0xFFFFFFFF)
    return doc[begin], out


def band_keys(samples: np.ndarray) -> np.ndarray:
    parts = samples.reshape(len(samples), BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x632BE59BD9B4E019)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            out = mix(out + parts[:, :, k] + np.uint64(k + 1))
    return out


def signatures(docs: DataFrame, idf) -> DataFrame:
    """doc_id, node (a hash of all its words), bands, prints (a byte of each sample) and size (bytes of its packed shingles) of each document with words."""

    def sign(batches):
        for batch in slices(batches, 1):
            ids, texts = batch.column(0), texts_of(batch.column(1))
            for a, b in _spans(texts):
                doc, shingle, tf, whole = weighted_sets(texts[a:b])
                if not len(doc):
                    continue
                own, samples = icws(doc, shingle, tf.astype(np.float32) * idf_of(shingle, idf.value))
                bands = band_keys(samples).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(own + a)),
                        pa.array([x.tobytes() for x in np.ascontiguousarray(whole[:, own].T)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1))),
                        pa.array([x.tobytes() for x in samples.astype(np.uint8)], pa.binary()),
                        pa.array(8 * np.bincount(doc)[own], pa.int64()),
                    ],
                    names=["doc_id", "node", "bands", "prints", "size"],
                )

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, node binary, bands array<long>, prints binary, size long")


def pack(shingle: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """52 bits of the shingle and 12 of its count; larger counts take several entries."""
    if len(tf) and tf.max() > 4095:
        times = (tf + 4094) // 4095
        part = np.full(times.sum(), 4095, np.int64)
        part[np.cumsum(times) - 1] = tf - 4095 * (times - 1)
        shingle, tf = np.repeat(shingle, times), part
    return shingle | (tf.astype(np.uint64) << np.uint64(52))


def unpack(packed: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles and their weights."""
    entries = np.frombuffer(packed, np.uint64)
    shingle, tf = entries & _LOW, (entries >> np.uint64(52)).astype(np.float64)
    begin = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    if len(begin) < len(shingle):
        shingle, tf = shingle[begin], np.add.reduceat(tf, begin)
    return shingle, tf * idf_of(shingle, idf)


def sets(docs: DataFrame) -> DataFrame:
    """doc_id with its packed shingles."""

    def collect(batches):
        for batch in slices(batches, 1):
            ids, texts = batch.column(0), texts_of(batch.column(1))
            for a, b in _spans(texts):
                doc, shingle, tf, _ = weighted_sets(texts[a:b])
                if not len(doc):
                    continue
                begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                end = np.concatenate([begin[1:], [len(doc)]])
                rows = [pack(shingle[i:j], tf[i:j]).tobytes() for i, j in zip(begin, end, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc[begin] + a)), pa.array(rows, pa.binary())], names=["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(collect, "doc_id long, packed binary")


def weighted_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Sum of smaller over sum of larger weights; a, b: sorted shingles, x, y: their weights."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    same = b[at] == a
    least = np.minimum(x[same], y[at[same]]).sum()
    return float(least / (x.sum() + y.sum() - least))


def verified(pairs: DataFrame, packed: DataFrame, idf) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches SIMILARITY."""

    def check(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep, last, left = [], None, None
            for k in range(len(a)):
                if a[k] != last:
                    last, left = a[k], unpack(batch.column(2)[k].as_py(), idf.value)
                keep.append(weighted_jaccard(*left, *unpack(batch.column(3)[k].as_py(), idf.value)) >= SIMILARITY)
            yield pa.RecordBatch.from_arrays([pa.array([v for v, k in zip(c, keep, strict=True) if k], pa.int64()) for c in (a, b)], names=["a", "b"])

    left = packed.select(F.col("doc_id").alias("a"), F.col("packed").alias("p"))
    right = packed.select(F.col("doc_id").alias("b"), F.col("packed").alias("q"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "p", "q").mapInArrow(check, "a long, b long")


def fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every id in links (a, b): comp is the least id connected to it. Alternates large-star and small-star.

    There are at most two nodes per link, which bounds the least neighbours of all nodes: few are broadcast, many are written before they are joined, so that a hub's edges can be split.
    """
    most = 2 * links.count()
    looked_up = F.broadcast if most <= SMALL else lambda df: stored(df, "near-least")
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-edges", most)
    seen = fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = looked_up(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # each node keeps its smaller neighbours: all of them and itself now point at the least
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(looked_up(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        old, edges = edges, stored(small, "near-edges", most)
        forget(old)
        before, seen = seen, fingerprint(edges)
        if seen == before:
            break
    out = edges.select(F.col("u").alias("id"), F.col("v").alias("comp"))
    return out.unionByName(out.select(F.col("comp").alias("id"), "comp").distinct())


def least_leaders(members: DataFrame, parts: int) -> DataFrame:
    """(key, a, comp_a): the least id of each of `parts` hashed parts of every bucket."""
    least = F.min(F.struct("id", "comp")).alias("least")
    return members.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part")).agg(least).select("key", F.col("least.id").alias("a"), F.col("least.comp").alias("comp_a"))


def plausible(pairs: DataFrame, nodes: DataFrame, agree: int) -> DataFrame:
    """The pairs (a, b) whose samples agree in `agree` places at least."""
    if not agree:
        return pairs

    def check(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, HASHES) for k in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= agree))

    left = nodes.select(F.col("id").alias("a"), F.col("prints").alias("x"))
    right = nodes.select(F.col("id").alias("b"), F.col("prints").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def with_components(buckets: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(key, id, comp) of the buckets that hold different components, stored."""
    if comps is None:
        return stored(buckets.withColumn("comp", F.col("id")), "near-members")
    members = buckets.join(few(comps, SMALL), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    open_keys = stored(members.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key"), "near-open-keys")
    return stored(members.join(few(open_keys, SMALL), "key", "left_semi"), "near-members")


def blocks_of(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of open buckets (key, id, comp, size) with prints and bands, once for each pair (i, j) of blocks that has to be compared and holds them.

    A bucket's blocks of nodes outside of its largest component come first; they are compared with each other and with those of the component.
    """
    comps = members.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    sizes = comps.groupBy("key").agg(F.max(F.struct("n", "comp", "b")).alias("most"), F.sum("n").alias("n"), F.sum("b").alias("b"))
    count = lambda n, b: F.greatest(F.ceil(n / BLOCK_NODES), F.ceil(b / BLOCK_BYTES)).cast("int")
    rest = count(F.col("n") - F.col("most.n"), F.col("b") - F.col("most.b"))
    sizes = sizes.select("key", F.col("most.comp").alias("main"), rest.alias("n_rest"), count(F.col("most.n"), F.col("most.b")).alias("n_main"))
    rows = members.join(few(stored(sizes, "near-sizes"), SMALL), "key").withColumn("rest", F.col("comp") != F.col("main"))
    part = lambda n: F.pmod(F.xxhash64("id", F.lit(3)), F.col(n)).cast("int")
    rows = rows.withColumn("block", F.when(F.col("rest"), part("n_rest")).otherwise(F.col("n_rest") + part("n_main")))
    others = F.when(F.col("rest"), F.col("n_rest") + F.col("n_main")).otherwise(F.col("n_rest"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "comp", "block")
    return rows.join(nodes.select("id", "prints", "bands"), "id")


def open_pairs(table: pa.Table, agree: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of plausible pairs in a block group whose components differ and whose first shared band is the group's key."""
    comp, block = table["comp"].to_numpy(), table["block"].to_numpy()
    prints = np.frombuffer(b"".join(table["prints"].to_pylist()), np.uint8).reshape(-1, HASHES)
    bands = np.array(table["bands"].to_pylist(), np.int64).reshape(-1, BANDS)
    key, one = table["key"][0].as_py(), table["i"][0].as_py() == table["j"][0].as_py()
    band = int(np.argmax(bands[0] == key))
    left, right = [], []
    for a in range(len(comp) - 1):
        b = np.arange(a + 1, len(comp))
        keep = comp[b] != comp[a]
        if not one:
            keep &= block[b] != block[a]
        b = b[keep]
        b = b[~(bands[b, :band] == bands[a, :band]).any(1)] if band else b
        b = b[(prints[b] == prints[a]).sum(1) >= agree]
        left.append(np.full(len(b), a))
        right.append(b)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def open_members(table: pa.Table, agree: int) -> pa.Table:
    """The rows of a block group that stand in one of its open pairs."""
    a, b = open_pairs(table, agree)
    return table.take(pa.array(np.unique(np.concatenate([a, b]))))


def block_links(table: pa.Table, idf: np.ndarray, agree: int) -> pa.Table:
    """Verified links of a block group, no more than connect its components."""
    ids, comp = table["id"].to_pylist(), table["comp"].to_pylist()
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    packed, known, links = table["packed"].to_pylist(), {}, []
    for a, b in zip(*(x.tolist() for x in open_pairs(table, agree)), strict=True):
        p, q = find(comp[a]), find(comp[b])
        if p == q:
            continue
        for k in (a, b):
            if k not in known:
                known[k] = unpack(packed[k], idf)
        if weighted_jaccard(*known[a], *known[b]) >= SIMILARITY:
            root[p] = q
            links.append((ids[a], ids[b]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})


def components_of(buckets: DataFrame, nodes: DataFrame, docs: DataFrame, idf, agree: int) -> DataFrame | None:
    """(id, comp) of the nodes that have links: comp is the least id that verified links between candidates connect. None: there are no links.

    The shingles of all nodes that share a bucket are collected in one pass over the texts.
    """
    ids = stored(buckets.select(F.col("id").alias("doc_id")).distinct(), "near-ids")
    packed = stored(sets(docs.join(few(ids, SMALL), "doc_id", "left_semi")), "near-sets")
    comps, links = None, None
    for parts in (1, 8):
        members = with_components(buckets, comps)
        leaders = few(stored(least_leaders(members, parts), "near-leaders"), SMALL)
        pairs = leaders.join(members, "key").where("comp <> comp_a").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()
        pairs = stored(plausible(pairs, nodes, agree), "near-pairs")
        found = stored(verified(pairs, packed, idf), "near-links")
        forget(members, pairs)
        links = found if links is None else links.unionByName(found)
        if not links.isEmpty():
            comps = stored(components(links), "near-components", 2 * links.count())
    kind = "id long, key long, i int, j int, comp long, block int, prints binary, bands array<long>"
    members = with_components(buckets, comps)
    sized = stored(members.join(nodes.select("id", "size"), "id"), "near-sized")
    forget(members)
    rest = blocks_of(sized, nodes).select("id", "key", "i", "j", "comp", "block", "prints", "bands")
    rest = stored(rest.groupBy("key", "i", "j").applyInArrow(lambda t: open_members(t, agree), kind), "near-open")
    forget(sized)
    rows = rest.join(packed.withColumnRenamed("doc_id", "id"), "id")
    found = stored(rows.groupBy("key", "i", "j").applyInArrow(lambda t: block_links(t, idf.value, agree), "a long, b long"), "near-links")
    forget(packed, ids, rest)
    if found.isEmpty():
        return comps
    return stored(components(found if links is None else links.unionByName(found)), "near-components")


def classes(df: DataFrame, agree: int = AGREE) -> DataFrame:
    """(doc_id, class_id) for each doc_id: class_id is the least doc_id of its class; a document near to none is its own class."""
    spark: SparkSession = df.sparkSession
    docs = small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts, n = document_frequencies(docs)
    idf = spark.sparkContext.broadcast(idf_table(counts, n))  # 8 MB
    docs = docs.where("doc_id is not null")
    signed = stored(signatures(docs, idf), "near-signatures")
    named = stored(signed.groupBy("node").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "near-names", n)
    # a text that stands alone is a node by itself; only copies look up who answers for them
    copies = few(stored(named.where("n > 1").select("node", "id"), "near-copies", n), SMALL)
    signed = signed.join(copies, "node", "left").withColumn("id", F.coalesce("id", "doc_id"))
    nodes = stored(signed.where("id = doc_id").select("id", "bands", "prints", "size").dropDuplicates(["id"]), "near-nodes")
    keys = nodes.select(F.explode("bands").alias("key"), "id")
    shared = keys.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("key")
    buckets = stored(keys.join(few(stored(shared, "near-keys"), SMALL), "key", "left_semi"), "near-buckets")
    comps = components_of(buckets, nodes, docs, idf, agree)
    member = signed.select("doc_id", "id").distinct()
    if comps is None:
        member = member.select("doc_id", F.col("id").alias("class_id"))
    else:
        member = member.join(few(comps, SMALL), "id", "left").select("doc_id", F.coalesce("comp", "id").alias("class_id"))
    # rows that share a doc_id are one document: its least class; texts without words have no signature
    member = member.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return docs.select("doc_id").distinct().join(member, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_one(df: DataFrame, agree: int = AGREE) -> DataFrame:
    """The rows of one document per class, the one with the least doc_id, and rows without a doc_id; df's columns."""
    gone = stored(classes(df, agree).where("doc_id <> class_id").select(F.col("doc_id").alias("__gone")), "near-gone")
    rows = df.join(few(gone, SMALL), F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])
