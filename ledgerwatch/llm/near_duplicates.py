"""Near duplicates by MinHash with tensored banding.

Two small collections of band hashes are computed, each band joining a few minhashes. A table key is a pair of one band of
each collection: from 2 * m bands come m * m tables, so that the number of minhashes is about the root of what as many
independent tables need. Documents of one key are candidates; whether they are linked is decided on the full shingle sets.

Equal sets are one representative. Of the bands only those that two representatives share make keys. Candidates are
verified in blocks of bounded size: first each block with itself and with the smallest candidate of its neighbourhood. Where a key
then has members in several components, those outside its largest one visit the blocks of all its members, in chunks of bounded
size. Members of the largest component are not compared with each other again, so a group of copies costs about its size, not its
square; only what isn't linked to the rest is compared with everybody that shares a key. Nothing is capped or dropped.

Results: one row for each row of docs. Null or empty texts have an empty set and are linked with nothing. Rows with a null id
take no part in links: component null, kept. Rows of one id count as one document with several sets. Extra columns don't matter.
An empty table gives no rows. At the threshold exactly, documents are linked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, give_back, id_and_text, mixed, perhaps, shingle_set, word_hashes
from .components import components

BAND = 3
BLOCK_ROWS, BLOCK_SHINGLES, ROWS = 512, 1_000_000, 1000


def bands_for(percent: int, miss: float = 1e-4) -> int:
    """Bands of each collection, so that a pair at the threshold has no common band in it with probability `miss` at most."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** BAND))


def band_hashes(sets: list[np.ndarray], m: int) -> np.ndarray:
    """For each set the 2 * m band hashes; sets must not be empty."""
    rng = np.random.default_rng(20_240_229)
    factors = rng.integers(1, 1 << 63, 2 * m * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(sets), 2 * m), np.uint64)
    for low in range(0, len(sets), 64):
        part = sets[low : low + 64]
        flat = np.concatenate(part)
        at = np.cumsum([0, *(len(x) for x in part[:-1])])
        for k in range(2 * m):
            h = np.zeros(len(part), np.uint64)
            for f in factors[k * BAND : (k + 1) * BAND]:
                x = flat * f
                h = h * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(x ^ (x >> np.uint64(31)), at)
            out[low : low + 64, k] = mixed(h + np.uint64(k))
    return out


def signatures(docs: DataFrame, n: int, m: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands): set_a and set_b are a 128-bit hash of the whole set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(low, ROWS) for b in batches for low in range(0, b.num_rows, ROWS)):
            sets = [shingle_set(word_hashes(t), n) for t in batch.column(1).to_pylist()]
            full = [x for x in sets if len(x)]
            hashes = iter(band_hashes(full, m).astype(np.int64).tolist())
            digest = [xxhash.xxh3_128_intdigest(x.tobytes()) for x in sets]
            half = lambda k: pa.array(np.array([d >> k & (1 << 64) - 1 for d in digest], np.uint64).view(np.int64))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), half(0), half(64), pa.array([next(hashes) if len(x) else None for x in sets], pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_a", "set_b", "bands"])
        give_back()

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def with_sets(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, shingles): the whole sets as little-endian bytes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low in range(0, len(texts), 500):
                yield pa.RecordBatch.from_arrays([batch.column(0)[low : low + 500], pa.array([shingle_set(word_hashes(t), n).tobytes() for t in texts[low : low + 500]], pa.binary())], ["rep", "shingles"])
        give_back()

    return docs.mapInArrow(build, "rep long, shingles binary")


def linked(ids: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all of these sets that are connected by similarity; rows of equal labels are taken as joined already.

    One component is singled out, the largest at the start; every row that isn't in it, or hasn't joined it, is compared with all.
    """
    n = len(ids)
    sizes = np.array([len(x) for x in sets], np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.zeros(codes.max() + 1, bool)
    group = np.unique(labels, return_inverse=True)[1]
    first = int(np.flatnonzero(group == np.argmax(np.bincount(group)))[0])
    out = []
    for x in (first, *range(n)):
        if group[x] == group[first] and (x != first or out):
            continue
        own = codes[at[x] : at[x] + sizes[x]]
        member[own] = True
        common = np.add.reduceat(member[codes].astype(np.int32), at)
        member[own] = False
        for y in np.flatnonzero(100 * common >= percent * (sizes + sizes[x] - common)):
            if group[y] != group[x]:
                out.append((int(ids[x]), int(ids[y])))
                group[group == group[y]] = group[x]
    return out


def verified(rows: DataFrame, percent: int, slices: int) -> DataFrame:
    """Links (a, b) within each group of rows (g, rep, label, shingles); groups are of bounded size."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], int] = {}  # an id may have several sets
        now, links = None, []

        def close() -> None:
            if len(held) > 1:
                rows = sorted(held)
                links.extend(linked(np.array([i for i, _ in rows], np.int64), np.array([held[r] for r in rows]), [np.frombuffer(x, np.uint64) for _, x in rows], percent))
            held.clear()

        for batch in batches:
            for g, rep, label, shingles in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if g != now:
                    close()
                    now = g
                held[rep, shingles] = label
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], ["a", "b"])
        give_back()

    return rows.select("g", "rep", "label", "shingles").repartition(slices, "g").sortWithinPartitions("g").mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs: n-word shingles, linked at `percent` of Jaccard similarity."""
    spark = docs.sparkSession
    slices, scratch = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8), Scratch(spark)
    # sides that grow with the input are merged, so that the plan is the same at every size
    texts, m = id_and_text(docs, id_col, text_col), bands_for(percent)
    signed = scratch.write(signatures(texts, n, m))
    whole = signed.filter("n_shingles > 0 and doc_id is not null")
    reps = whole.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    reps = scratch.write(reps)

    bands = reps.select("rep", F.posexplode("bands").alias("slot", "band"))
    shared = bands.groupBy("slot", "band").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    own = bands.join(shared.hint("merge"), ["slot", "band"]).groupBy("rep").agg(F.collect_list(F.struct("slot", "band")).alias("own"))  # at most 2 * m of each set
    first, second = F.filter("own", lambda x: x["slot"] < m), F.filter("own", lambda x: x["slot"] >= m)
    keys = own.select("rep", F.explode(first).alias("p"), second.alias("second")).select("rep", "p", F.explode("second").alias("q"))
    keys = keys.select(F.xxhash64("p.slot", "p.band", "q.slot", "q.band").alias("key"), "rep")
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("c")).filter("c > 1").drop("c")
    near = scratch.write(keys.join(hubs.hint("merge"), "key"))

    homes = near.groupBy("rep").agg(F.min("hub").alias("home"))
    homes = homes.join(reps.groupBy("rep").agg(F.sum("n_shingles").alias("n_shingles")).hint("merge"), "rep")
    chunks = homes.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("chunks"))
    blocks = homes.join(chunks, "home").select("rep", "home", "n_shingles", F.xxhash64("home", F.pmod(F.xxhash64("rep"), "chunks")).alias("block"))
    blocks = scratch.write(blocks)
    members = scratch.write(blocks.select(F.col("rep").alias("doc_id")).union(blocks.select("home")).distinct())
    needed = perhaps(texts, "doc_id", members).filter("hit").select("row.*").join(members.hint("merge"), "doc_id")  # few texts are moved if few are needed
    sets = scratch.write(with_sets(needed.select("doc_id", "text"), n), "none")

    alone = blocks.select(F.col("block").alias("g"), "rep").union(blocks.select("block", "home")).distinct()
    links = scratch.write(verified(alone.join(sets.hint("merge"), "rep").withColumn("label", F.col("rep")), percent, slices))
    labels = components(links, scratch)
    labelled = blocks.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("rep", "block", "n_shingles", F.coalesce("component", "rep").alias("label"))
    labelled = scratch.write(labelled)
    across = visits(near, labelled)
    links = links.union(scratch.write(verified(across.join(sets.hint("merge"), "rep"), percent, slices)))
    labels = components(links, scratch)

    by_set = reps.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    out = signed.drop("bands").join(by_set.hint("merge"), ["set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return scratch.only(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def visits(near: DataFrame, labelled: DataFrame) -> DataFrame:
    """(g, rep, label) of what is still to be compared: for each key the members outside its largest component, with each block of the key.

    Visitors come in chunks of bounded size; each chunk is a group with the members of the block.
    """
    keyed = near.select("key", "rep").join(labelled, "rep")
    counts = keyed.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("labels")).filter("labels > 1").drop("labels")
    open_keys = keyed.join(main.hint("merge"), "key")
    outside = open_keys.filter("label <> main").select("key", "rep", "label", "n_shingles", F.col("block").alias("own"))
    places = open_keys.select("key", "block").distinct()
    guests = outside.join(places.hint("merge"), "key").filter("block <> own").select("block", "rep", "label", "n_shingles").distinct()
    chunks = guests.groupBy("block").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("chunks"))
    guests = guests.join(chunks.hint("merge"), "block").select(F.xxhash64("block", F.pmod(F.xxhash64("rep"), "chunks")).alias("g"), "rep", "label")
    hosts = labelled.join(chunks.hint("merge"), "block").select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "block", "rep", "label")
    return guests.union(hosts.select(F.xxhash64("block", "chunk"), "rep", "label"))


def deduplicated(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose document is the smallest of its component; a row with a null id stays, repeated rows of a kept id stay."""
    found = near_duplicates(docs, n, percent)
    gone = Scratch(docs.sparkSession).write(found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct())
    marked = perhaps(docs, "doc_id", gone)
    met = marked.filter("hit").join(gone.hint("merge"), F.col("row.doc_id") == F.col("gone"), "left_anti")
    return marked.filter("not hit").unionByName(met).select("row.*")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), n=3, percent=85)


#: The same rows as op2_minhash.
OP2_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS shingle FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 2))) AS i) WHERE len(w) > 0),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_ >= 85 * (x.n + y.n - both_)),
 reach AS (SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT id, b FROM reach JOIN link ON r = a),
 c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY 1)
 SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents JOIN c ON id = doc_id LEFT JOIN n USING (doc_id)"""
