"""SimHash near-duplicates by covering locality-sensitive hashing: no pair within the radius is missed.

Bit i of a fingerprint carries the three-bit vector ``i mod 7 + 1``; the mask of table v
(1 to 7) keeps the bits whose vector has an odd number of bits in common with v.  Two
differing bits span at most two dimensions of three, so some v is orthogonal to both, its
mask hides them, and the two fingerprints meet in that table.  The same for other radii.

Documents of one fingerprint are one node.  Fingerprints that share a bucket with another
one emit, for the hidden bits of that table, themselves and themselves with one bit
flipped: two of them are within two bits exactly if they emit a common value, and at most 65
fingerprints emit the same one.  So the links are exact, no bucket is paired up, and a
bucket of any size costs a fixed number of rows per fingerprint.  (This step is for
radius 2, and gives radius 1 by a check.)  Components come from alternating large and
small stars over the links.

Null and wordless texts have fingerprint 0 and are linked like any other.  Rows of null id
have the component of their fingerprint but never name one (null if there is no other id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import common
from tidegate.operators.skew import join_groups
from tidegate.session import scratch_path

SEED = 42
RADIUS = 2
#: Shingles that are hashed together; a very long text is taken in such parts.
PART = 1 << 16
#: A fingerprint with more than this part of all rows is joined by a broadcast line: at most 1 / share of them.
HOT_SHARE = 1 / 1000


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The bits that each table keeps."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bit b is set if it is set in over half of the hashes of the text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    size = max(1, len(words) - shingle + 1)
    sums = np.zeros(64, np.int64)
    for first in range(0, size, PART):
        part = words[first : min(size, first + PART) + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle))) if len(part) >= shingle else [part]
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64)
        full = -(-len(hashes) // 255) * 255  # 255 ones fit into a byte
        padded = np.zeros(full, "<u8")
        padded[: len(hashes)] = hashes
        bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(sums * 2 > size, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, keep: list[str | Column] = ()) -> DataFrame:
    """The columns of ``keep`` and ``fp``, the fingerprint as a signed long."""
    common.prepared(docs.sparkSession)
    rows = docs.select(*keep, common.text_bytes(text).alias("__text"))
    kept = rows.drop("__text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(fingerprint(x.as_py(), shingle)) for x in batch.column("__text")]
            carried = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*carried.columns, pa.array(found, pa.int64())], [*carried.schema.names, "fp"])

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "fp long"]))


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a``, ``b`` (a > b) that join the fingerprints of column ``fp`` within the radius; every such pair is
    linked directly or over a fingerprint that is within the radius of both."""
    if radius != 2:
        raise ValueError("links are made for a radius of two bits")
    tables = masks(radius)
    keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(tables)))
    placed = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    shared = placed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("t", "key")
    met = placed.join(shared, ["t", "key"], "left_semi").select("t", "fp")
    flips = F.array(*(F.array(*(F.lit(_signed(f)) for f in [0, *(1 << i for i in range(64) if not m >> i & 1)])) for m in tables))
    near = met.select("fp", F.explode(F.element_at(flips, F.col("t") + 1)).alias("flip"))
    near = near.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).distinct()
    balls = near.groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)  # at most 65 each
    pairs = balls.select(F.array_min("fps").alias("b"), F.explode("fps").alias("a"))
    return pairs.where("a != b").select("a", "b").distinct()


def _written(df: DataFrame, name: str) -> DataFrame:
    df.write.parquet(at := scratch_path(df.sparkSession, name))
    return df.sparkSession.read.parquet(at)


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) for every node of links a > b that is not the root."""
    edges = _written(edges, "edges")
    before = _digest(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = _written(small.where("a != b").distinct(), "edges")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, keep: list[str | Column] = ()) -> DataFrame:
    """Per row: ``doc_id``, ``keep``, ``fp``, ``root`` (a fingerprint that names the group), ``component_id``."""
    prints = _written(fingerprints(docs, text, shingle, [F.col(doc_id).alias("doc_id"), *keep]), "fingerprints")
    kept = [c for c in prints.columns if c != "fp"]
    nodes = _written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "nodes")
    roots = components(links(nodes.select("fp")))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left")
    named = named.select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = _written(named.join(ids, "root").select("fp", "n", "root", "component_id"), "components")
    total = named.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = named.where(F.col("n") > total * HOT_SHARE).select("fp", "root", "component_id", F.lit(True).alias("hot"))
    marked = prints.join(F.broadcast(hot), "fp", "left")  # 1 / HOT_SHARE lines at most
    common_ones = marked.where("hot").select(*kept, "fp", "root", "component_id")
    others = marked.where("hot is null").select(*kept, "fp").join(named.where(F.col("n") <= total * HOT_SHARE).select("fp", "root", "component_id"), "fp")
    return common_ones.unionByName(others)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` (16 hexadecimal digits), ``component_id`` (the smallest id reachable)."""
    out = _grouped(docs, doc_id, text, shingle)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """Of every group of linked texts one row of the smallest id.  Rows of null id stay.

    A row goes for its own text, whatever else its id stands on: two different texts of one id both stay.  Of rows
    that are alike in id and text one stays.
    """
    own = {"__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit(11), F.col(text))}  # an id and its text, in 128 bits
    found = _grouped(docs, doc_id, text, shingle, [c.alias(n) for n, c in own.items()]).where("doc_id is not null")
    key = ["doc_id", *own]
    texts = _written(found.groupBy(*key, "root").agg(F.count(F.lit(1)).alias("rows")), "texts")
    best = texts.groupBy("root").agg(F.min(F.struct(*key)).alias("best"), F.count(F.lit(1)).alias("n"))
    judged = join_groups(texts, _written(best, "best"), ["root"], "n", key)
    judged = _written(judged.select(*key, "rows", (F.struct(*key) == F.col("best")).alias("stays")), "judged")

    def same(frame: DataFrame):
        return (marked["__id"] == frame["doc_id"]) & (marked["__t1"] == frame["__t1"]) & (marked["__t2"] == frame["__t2"])

    marked = docs.withColumns({"__id": F.col(doc_id), **own})
    gone, again = judged.where("not stays").select(*key), judged.where("stays and rows > 1").select(*key)
    kept = marked.join(gone, same(gone), "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if not again.limit(1).count():
        return kept.select(*columns)
    once, twice = kept.join(again, same(again), "left_anti"), kept.join(again, same(again), "left_semi")
    return once.select(*columns).unionByName(twice.dropDuplicates(["__id", *own]).select(*columns))
