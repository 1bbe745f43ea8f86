"""Hard negatives: rows of another label that score just below an anchor's positives, by zone maps over a Hilbert curve.

Vectors are whole numbers and a score is an inner product, so everything is exact.  Rows are sorted
along a Hilbert curve through the dimensions that vary most and stored as Parquet, ``BLOCK_ROWS``
vectors to a block with the least and greatest value of every dimension and of the label, and
``RUN_BLOCKS`` blocks to a run, which has such a zone map too.  Interval arithmetic bounds
the scores that an anchor can have in a run or block; it is read only if these overlap
what the anchor still looks for, and if its labels can be the ones looked for.

Positives and negatives are both found in two steps.  First every run answers for its own
anchors, which lie near their best rows on the curve; that gives the least score worth having.  Then anchors,
in blocks, meet the zone maps of the runs, also in blocks, and go to the runs that they need; there the zone maps
of the blocks are asked again, the most promising first.  Each task keeps the best of a run, so a few rows
per anchor and run are shuffled.  Bounds are tight where vectors lie in clusters; among vectors that are nearly random in
many dimensions they are not, and then every run is read for every anchor: the result is the same.

Rows take no part whose label, id or vector is null, that hold a null or non-finite
component, or have another length than most (of equally frequent lengths the shorter counts).  Rows equal in all
three columns count once; of an id with several vectors or labels each row counts, and none
is another's positive or negative as they are not "other" rows.  Ties go to the smaller id (of one
id to the smaller label, then place).  Without anchors, positives or rows in a window there is no
row; an empty table gives none.  Scores are exact as long as they fit into a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm import common
from tidegate.llm.running import written

#: Vectors of a block, blocks of a run; lines or zone maps that meet in one group; lines that search a run together.
BLOCK_ROWS, RUN_BLOCKS, MEET, LINES = 256, 64, 2048, 8192
#: Dimensions of the curve and bits of each; together at most 62.
CURVE_DIMENSIONS, CURVE_BITS = 10, 6
#: Scores that a task holds at a time, and found rows it holds before it sorts out the best.
SCORES, HELD = 1 << 21, 1 << 19

_ZONE = "low array<long>, high array<long>, least long, most long"
_BLOCK = f"run long, block int, ids binary, labels binary, anchors binary, vecs binary, {_ZONE}"
#: Who asks: an anchor (``key`` tells rows of one id apart), its home run, and windows of scores, of which ``least`` rises.
_ASKED = "key long, anchor long, label long, vec binary, home long"
_FOUND = "key long, slot int, id long, id_label long, score long, place long"
_FOUND_TYPES = {"key": pa.int64(), "slot": pa.int32(), "id": pa.int64(), "id_label": pa.int64(), "score": pa.int64(), "place": pa.int64()}


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below ``2**bits`` (Skilling's transform, for all rows at once)."""
    x = cells.astype(np.int64).T.copy()
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(n):
            flip = (x[i] & q) > 0
            t = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(flip, x[0] ^ (q - 1), x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), top
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _packed(matrix: np.ndarray) -> bytes:
    """Whole numbers, as narrow as they can be; the first byte says how wide."""
    most = int(max(matrix.max(initial=0), -matrix.min(initial=0) - 1))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return bytes([width]) + matrix.astype(f"<i{width}").tobytes()


def _unpacked(cell: bytes, size: int) -> np.ndarray:
    return np.frombuffer(cell, f"<i{cell[0]}", offset=1).reshape(-1, size)


def _longs(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def scores(asked: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Inner products of all asked with all held vectors: as doubles while these are exact, else as longs."""
    most = float(np.abs(asked.astype(float)).max(initial=0)) * float(np.abs(held.astype(float)).max(initial=0)) * asked.shape[1]
    kind = np.float64 if most < 2**53 else np.int64
    return asked.astype(kind) @ held.astype(kind).T


def bounds(asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that each asked vector can have with a vector in each box."""
    up, down = np.maximum(asked, 0).astype(float), np.minimum(asked, 0).astype(float)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    slack = 1e-9 * np.maximum(np.abs(least), np.abs(most))  # doubles may round sums of very large components
    return least - slack, most + slack


def _usable(rows: DataFrame) -> tuple[DataFrame, int]:
    """Distinct rows ``id``, ``label``, ``vec`` that take part, and the number of components."""
    whole = rows.where("id is not null and label is not null and vec is not null").where(~F.exists("vec", lambda x: x.isNull()))
    most = whole.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if most is None:
        return whole, 0
    return whole.where(F.size("vec") == most["size"]).distinct(), most["size"]


def _spread(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The dimensions of the curve, and the fences between which they are cut into cells."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            own = _longs(batch.column("vec"), width).astype(float)
            n, total, square = n + len(own), total + own.sum(axis=0), square + (own * own).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"d": np.arange(width), "n": np.full(width, n), "s": total, "q": square})

    found = rows.select("vec").mapInArrow(sums, "d long, n long, s double, q double").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    table = found.toPandas().sort_values("d")  # one line per dimension
    mean = (table["s"] / table["n"]).to_numpy()
    deviation = np.sqrt(np.maximum((table["q"] / table["n"]).to_numpy() - mean**2, 0))
    chosen = np.sort(np.argsort(-deviation, kind="stable")[:CURVE_DIMENSIONS])
    return chosen, mean[chosen] - 2 * deviation[chosen], 4 * deviation[chosen] + 1e-9


def blocks(rows: DataFrame, width: int) -> DataFrame:
    """Stored blocks of rows ``id``, ``label``, ``vec``, ``is_anchor`` along the curve, with their zone maps."""
    chosen, low, span = _spread(rows, width)
    fields = "id long, label long, vec array<long>, is_anchor boolean"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _longs(batch.column("vec"), width)[:, chosen]
            cells = np.clip((own - low) / span * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells, CURVE_BITS))], [*batch.schema.names, "key"])

    keyed = written(rows.select("id", "label", "vec", "is_anchor").mapInArrow(place, f"{fields}, key long"), "curve")
    order = ["key", "id", "label", "vec"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, waiting, size = TaskContext.get().partitionId(), 0, [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            vecs, labels, anchors = _longs(table.column("vec"), width), table.column("label").to_numpy(), table.column("is_anchor").to_numpy()
            row = {"run": (part << 32) + made // RUN_BLOCKS, "block": made % RUN_BLOCKS, "ids": table.column("id").to_numpy().tobytes(), "labels": labels.tobytes(),
                   "anchors": anchors.tobytes(), "vecs": _packed(vecs), "low": vecs.min(axis=0), "high": vecs.max(axis=0), "least": labels.min(), "most": labels.max()}
            return pa.RecordBatch.from_pylist([row], _arrow_schema())

        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size < BLOCK_ROWS:
                continue
            table = pa.Table.from_batches(waiting)
            while size >= BLOCK_ROWS:
                yield block(table.slice(0, BLOCK_ROWS))
                table, size, made = table.slice(BLOCK_ROWS), size - BLOCK_ROWS, made + 1
            waiting = table.to_batches()
        if size:
            yield block(pa.Table.from_batches(waiting))

    return written(ordered.mapInArrow(cut, _BLOCK), "blocks")


def _arrow_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema([("run", pa.int64()), ("block", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "anchors", "vecs")),
                      ("low", longs), ("high", longs), ("least", pa.int64()), ("most", pa.int64())])


def zone_maps(held: DataFrame, width: int) -> DataFrame:
    """The zone map of every run, from those of its blocks."""

    def join(table: pa.Table) -> pa.Table:
        low, high = _longs(table.column("low"), width).min(axis=0), _longs(table.column("high"), width).max(axis=0)
        row = {"run": table.column("run")[0].as_py(), "low": low, "high": high,
               "least": table.column("least").to_numpy().min(), "most": table.column("most").to_numpy().max()}
        return pa.Table.from_pylist([row], pa.schema([f for f in _arrow_schema() if f.name in row]))

    return written(held.select("run", "low", "high", "least", "most").groupBy("run").applyInArrow(join, f"run long, {_ZONE}"), "zones")


def _anchors(held: DataFrame, width: int) -> DataFrame:
    """The anchors with their vectors and home runs."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(row["anchors"], bool))
                vecs = _unpacked(row["vecs"], width)[at]
                yield pa.RecordBatch.from_pydict({
                    "key": _places(row["run"], row["block"], at), "anchor": np.frombuffer(row["ids"], np.int64)[at], "label": np.frombuffer(row["labels"], np.int64)[at],
                    "vec": pa.array([_packed(v) for v in vecs], pa.binary()), "home": np.full(len(at), row["run"], np.int64)})

    return written(held.select("run", "block", "ids", "labels", "anchors", "vecs").mapInArrow(pick, _ASKED), "anchors")


def _places(run: int, block: int, rows: np.ndarray) -> np.ndarray:
    """A number for every row of the blocks: partition, run in it, block, row."""
    return (((run >> 32) << 40) + (((run & 0xFFFFFFFF) * RUN_BLOCKS + block) * BLOCK_ROWS) + rows).astype(np.int64)


class _Lines:
    """Lines that look for rows, with a window per slot."""

    def __init__(self, table: pa.Table, width: int):
        self.key, self.anchor, self.label = (table.column(c).to_numpy() for c in ("key", "anchor", "label"))
        self.vecs = np.concatenate([_unpacked(x.as_py(), width) for x in table.column("vec")]) if table.num_rows else np.zeros((0, width), np.int64)
        slots = len(table.column("least")[0]) if table.num_rows else 1
        self.least, self.most = (table.column(c).combine_chunks().flatten().to_numpy().reshape(-1, slots).copy() for c in ("least", "most"))

    def fits(self, zone_least: np.ndarray, zone_most: np.ndarray, same: bool) -> np.ndarray:
        """Whether a zone can hold labels that are looked for."""
        label = self.label[:, None]
        return (zone_least <= label) & (label <= zone_most) if same else (zone_least != label) | (zone_most != label)

    def needs(self, low: np.ndarray, high: np.ndarray, fits: np.ndarray) -> np.ndarray:
        """Lines times zones times slots: whether scores within the bounds can lie in the window."""
        window = (high[:, :, None] >= self.least[:, None, :]) & (low[:, :, None] <= self.most[:, None, :]) & (self.least <= self.most)[:, None, :]
        return window & fits[:, :, None]


def _best(found: list[tuple[np.ndarray, ...]], k: int) -> list[tuple[np.ndarray, ...]]:
    """Of found rows (line, slot, id, label, score, place) the first ``k`` of every line and slot."""
    columns = [np.concatenate(c) for c in zip(*found)]
    line, slot, ids, labels, score, place = columns
    by = np.lexsort((place, labels, ids, -score, slot, line))
    group = common.runs(line[by] * 64 + slot[by])
    rank = np.arange(len(by)) - np.repeat(group, np.diff(np.append(group, len(by))))
    return [tuple(c[by[rank < k]] for c in columns)]


def _search_run(rows: list[dict], lines: _Lines, same: bool, k: int, width: int) -> list[tuple[np.ndarray, ...]]:
    """The best ``k`` rows of a run for every line and slot.  Blocks are read only where their bounds say so."""
    low, high = bounds(lines.vecs, *(np.array([r[c] for r in rows]).reshape(-1, width) for c in ("low", "high")))
    fits = lines.fits(*(np.array([r[c] for r in rows])[None] for c in ("least", "most")), same)
    found, held = [], 0
    for b in np.argsort(-np.where(fits, high, -np.inf).max(axis=0, initial=-np.inf), kind="stable"):
        needed = lines.needs(low[:, [b]], high[:, [b]], fits[:, [b]])[:, 0]
        wanted = np.flatnonzero(needed.any(axis=1))
        if not len(wanted):
            continue
        row = rows[b]
        ids, labels, vecs = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), _unpacked(row["vecs"], width)
        for part in np.array_split(wanted, -(-len(wanted) * len(ids) // SCORES)):
            value = scores(lines.vecs[part], vecs)
            ok = ((labels[None] == lines.label[part, None]) == same) & (ids[None] != lines.anchor[part, None])
            for slot in range(lines.least.shape[1]):
                inside = ok & (value >= lines.least[part, slot, None]) & (value <= lines.most[part, slot, None])
                if len(ids) > k:  # only what reaches the k-th best of the block, ties included
                    kth = np.partition(np.where(inside, value, -np.inf), len(ids) - k, axis=1)[:, len(ids) - k]
                    lines.least[part, slot] = np.maximum(lines.least[part, slot], kth)
                    inside &= value >= kth[:, None]
                at, col = np.nonzero(inside)
                if not len(at):
                    continue
                new = (part[at], np.full(len(at), slot), ids[col], labels[col], value[at, col].astype(np.int64), _places(row["run"], row["block"], col))
                found += _best([new], k)
                held += len(found[-1][0])
        if held > HELD:
            found = _best(found, k)
            held = len(found[0][0])
    return _best(found, k) if found else []


def _visit(asked: DataFrame, held: DataFrame, same: bool, k: int, width: int) -> DataFrame:
    """Stored found rows of asked lines with the ``run`` that each is to search."""
    asked = written(asked, "asked")
    slices = asked.groupBy("run").agg(F.ceil(F.count(F.lit(1)) / LINES).cast("int").alias("slices"))
    slices = written(slices, "slices")
    lines = asked.join(slices, "run").withColumn("slice", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int")).drop("slices")
    rows = held.drop("anchors").join(slices, "run").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")

    def search(own: pa.Table, blocks_: pa.Table) -> pa.Table:
        table = _Lines(own, width)
        found = _search_run(blocks_.to_pylist(), table, same, k, width) if own.num_rows and blocks_.num_rows else []
        if not found:
            return pa.table({c: pa.array([], t) for c, t in _FOUND_TYPES.items()})
        line, *rest = found[0]
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(_FOUND_TYPES.items(), (table.key[line], *rest))})

    group = ["run", "slice"]
    return written(lines.groupBy(*group).cogroup(rows.groupBy(*group)).applyInArrow(search, _FOUND), "found")


def _reach(asked: DataFrame, zones: DataFrame, same: bool, width: int) -> DataFrame:
    """The asked lines with every ``run`` but their home that may hold rows for them.  Lines and zone maps meet in groups."""
    n_pieces, n_slices = (max(1, -(-x.count() // MEET)) for x in (zones, asked))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    lines = asked.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(n_slices)).cast("int")).withColumn("piece", every(n_pieces))
    maps = zones.withColumn("piece", F.pmod(F.xxhash64("run"), F.lit(n_pieces)).cast("int")).withColumn("slice", every(n_slices))

    def meet(own: pa.Table, maps_: pa.Table) -> pa.Table:
        table, run = _Lines(own, width), maps_.column("run").to_numpy()
        at, to = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if own.num_rows and maps_.num_rows:
            low, high = bounds(table.vecs, *(_longs(maps_.column(c), width) for c in ("low", "high")))
            fits = table.fits(*(maps_.column(c).to_numpy()[None] for c in ("least", "most")), same)
            fits &= own.column("home").to_numpy()[:, None] != run[None]
            needed = np.zeros(fits.shape, bool)
            for slot in range(table.least.shape[1]):  # one slot at a time bounds the memory
                window = (high >= table.least[:, slot, None]) & (low <= table.most[:, slot, None])
                needed |= window & fits & (table.least[:, slot] <= table.most[:, slot])[:, None]
            at, to = np.nonzero(needed)
        return own.drop_columns(["slice", "piece"]).take(pa.array(at)).append_column("run", pa.array(run[to], pa.int64()))

    group = ["slice", "piece"]
    fields = f"{_ASKED}, least array<double>, most array<double>, run long"
    return lines.groupBy(*group).cogroup(maps.groupBy(*group)).applyInArrow(meet, fields)


def _first(found: DataFrame, k: int) -> DataFrame:
    """Found rows with their ``rank``, up to ``k``, per key and slot."""
    order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "id", "id_label", "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(asked: DataFrame, held: DataFrame, zones: DataFrame, same: bool, k: int, width: int) -> DataFrame:
    """The first ``k`` rows of every asked line and slot: those of its home run, then of all runs that can hold better ones."""
    near = _visit(asked.withColumn("run", F.col("home")), held, same, k, width)
    known = near.groupBy("key", "slot").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    known = known.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.col("kth").cast("double")))).alias("kth"))
    raised = asked.join(known, "key", "left")
    least = F.transform("least", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("kth", i), x)))
    raised = written(raised.select(*(c for c in asked.columns if c != "least"), F.coalesce(F.when(F.col("kth").isNotNull(), least), F.col("least")).alias("least")), "raised")
    far = _visit(_reach(raised.select(*asked.columns), zones, same, width), held, same, k, width)
    return written(_first(near.unionByName(far), k), "best")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, vec_id: str = "vec_id",
         vector: str = "embedding", label: str | Column = "label") -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of another label that score from ``low`` to ``high`` hundredths of
    the positive's score: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vector`` is an array of whole numbers, or a column expression that makes one; a null in it, and a null array, take no part.
    """
    spark = common.prepared(vectors.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    vector = F.col(vector) if isinstance(vector, str) else vector
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), vector.cast("array<long>").alias("vec"),
                          F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = written(rows, "vectors")
    rows, width = _usable(rows)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not width:
        return spark.createDataFrame([], out)
    held = blocks(rows, width)
    zones, anchors = zone_maps(held, width), _anchors(held, width)
    endless = float("inf")
    asked = anchors.withColumns({"least": F.array(F.lit(-endless)), "most": F.array(F.lit(endless))})
    best = _search(asked, held, zones, True, positives, width)
    positive = best.select("key", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # Windows in whole numbers, an empty one for a place that no positive has.
    windows = positive.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("slot", "positive_score"))).alias("p"))
    score = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.try_element_at("p", i))
    windows = windows.select("key", F.transform(score, lambda p: F.coalesce(F.ceil(p * low / 100).cast("double"), F.lit(endless))).alias("least"),
                             F.transform(score, lambda p: F.coalesce(F.floor(p * high / 100).cast("double"), F.lit(-endless))).alias("most"))
    asked = written(anchors.join(windows, "key").select(*anchors.columns, "least", "most"), "windows")
    found = _search(asked, held, zones, False, negatives, width)
    pairs = found.join(positive, ["key", "slot"]).join(anchors.select("key", "anchor"), "key")
    return pairs.select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
