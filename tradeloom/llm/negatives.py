"""Hard negatives by anchor spanning-tree bounds.

Scores are inner products of whole numbers, ``floor(256 * x)`` per component, so results are exact.

Anchors are dealt into panels, and every panel is ordered as a minimum spanning tree of the anchors'
distances.  All rows lie in blocks, and every panel meets every block: a block scores the root of the
tree exactly and walks down.  By Cauchy-Schwarz the score of a child differs from its parent's by at
most edge length times the norm of the row, so bounds of the parent bound the child.  Only rows whose
bounds overlap the window that is asked for are scored again; the others pass their bounds on.

1.  Positives: the window of an anchor opens at the fifth largest lower bound of its label.
2.  Negatives: every positive sets a window; rows of other labels outside all of them are never scored.

Each block hands on its best few per anchor, which Spark merges by ranking.  Panels and blocks are
bounded by parameters, so a task holds one of each.  Panels go to the blocks by a join on the panel's
number, which Spark turns into a broadcast only if their size allows it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's.
LEAST, MOST = 30, 90
BLOCK_ROWS, PANEL_ROWS = 2048, 1024
#: Components are cut off here, beyond any embedding, so that sums stay in 64 bits.
_LARGEST = 1 << 26
_NO_ID = np.iinfo(np.int64).max

_BLOCK = "block long, ids binary, rows binary, labels binary, vectors binary, width int"
_ANCHOR = "panel int, id long, row long, label long, vector binary"
_PANEL = "panel int, a_ids binary, a_rows binary, a_labels binary, a_vectors binary, a_width int, parents binary, edges binary"
_POSITIVE = "panel int, at int, anchor_row long, anchor_id long, positive_row long, positive_id long, score long"
_NEGATIVE = (
    "anchor_row long, anchor_id long, positive_rank int, positive_id long, positive_score long, "
    "negative_row long, negative_id long, negative_score long"
)


def _matrix(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(-1, width)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _quantized(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whole components, short vectors filled up with zeros, and which vectors count."""
    n = len(vectors)
    good = ~vectors.is_null().to_numpy(zero_copy_only=False)
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    numbers = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes nan
    sizes = np.where(good, np.diff(offsets), 0)
    width = max(1, int(sizes.max(initial=0)))
    place = np.arange(width)[None, :]
    inside = place < sizes[:, None]
    x = np.zeros((n, width))
    x[inside] = numbers[(offsets[:-1, None] + place)[inside]]
    good &= np.isfinite(x).all(axis=1)
    x[~good] = 0
    return np.clip(np.floor(x * 256), -_LARGEST, _LARGEST).astype(np.int32), good


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, as blocks of numbers; a row's number is the same in every later read."""
    part, count = TaskContext.get().partitionId() << 40, 0
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            cut = batch.slice(start, BLOCK_ROWS)
            x, good = _quantized(cut.column(2))
            keep = np.flatnonzero(good)
            rows = part + count + np.arange(cut.num_rows)
            count += cut.num_rows
            if not len(keep):
                continue
            ids = cut.column(0).fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
            labels = cut.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            values = [[int(rows[keep[0]])], *[[a[keep].tobytes()] for a in (ids, rows, labels, x)], [x.shape[1]]]
            types = [pa.int64(), *[pa.binary()] * 4, pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], ["block", "ids", "rows", "labels", "vectors", "width"])


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of points: an order from the root on, the place of each one's parent in it, and edge lengths."""
    n = len(x)
    x = x.astype(np.float64)
    squares = (x * x).sum(axis=1)
    centre = x.mean(axis=0)
    at = int(np.argmin(((x - centre) ** 2).sum(axis=1)))
    order, parents, edges = [at], [-1], [0.0]
    near, via, free = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    free[at] = False
    for k in range(1, n):
        d = np.maximum(squares + squares[at] - 2 * (x @ x[at]), 0)
        closer = d < near
        near[closer], via[closer] = d[closer], k - 1
        at = int(np.argmin(np.where(free, near, np.inf)))
        free[at] = False
        order.append(at)
        parents.append(int(via[at]))
        edges.append(float(np.sqrt(((x[at] - x[order[via[at]]]) ** 2).sum())))
    return np.array(order), np.array(parents), np.array(edges)


def _panel(key: tuple, anchors: pa.Table) -> pa.Table:
    """The anchors of a panel as a tree; parents stand before their children."""
    found = sorted(zip(*[anchors.column(c).to_pylist() for c in ("row", "id", "label", "vector")], strict=True))
    width = max(len(f[3]) for f in found) // 4
    x = np.zeros((len(found), width), np.int32)
    for i, f in enumerate(found):
        v = np.frombuffer(f[3], np.int32)
        x[i, : len(v)] = v
    order, parents, edges = spanning_tree(x)
    rows, ids, labels = (np.array([f[k] for f in found], np.int64)[order] for k in range(3))
    data = [ids.tobytes(), rows.tobytes(), labels.tobytes(), x[order].tobytes()]
    types = [pa.int32(), *[pa.binary()] * 4, pa.int32(), *[pa.binary()] * 2]
    values = [key[0].as_py(), *data, width, parents.astype(np.int64).tobytes(), edges.tobytes()]
    names = ["panel", "a_ids", "a_rows", "a_labels", "a_vectors", "a_width", "parents", "edges"]
    return pa.table([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)


class Walk:
    """Scores of one panel's anchors against one block, from parents to children."""

    def __init__(self, panel: dict, block: dict) -> None:
        a, b = _matrix(panel["a_vectors"], panel["a_width"]), _matrix(block["vectors"], block["width"])
        width = min(a.shape[1], b.shape[1])  # what one side lacks counts as zero
        norms = b.astype(np.float64)
        self.norms = np.sqrt((norms * norms).sum(axis=1))
        a, b = a[:, :width], b[:, :width]
        top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
        kind = np.float64 if top < 2**53 else np.int64  # both exact
        self.a, self.b = a.astype(kind), b.astype(kind)
        self.ids, self.rows, self.labels = _longs(block["ids"]), _longs(block["rows"]), _longs(block["labels"])
        self.anchor_ids, self.anchor_rows, self.anchor_labels = (_longs(panel[c]) for c in ("a_ids", "a_rows", "a_labels"))
        self.parents, self.edges = _longs(panel["parents"]), np.frombuffer(panel["edges"], np.float64)
        self.open = np.bincount(self.parents[1:], minlength=len(self.parents))
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.rescored = 0

    def scores(self, i: int, at: np.ndarray) -> np.ndarray:
        self.rescored += len(at)
        return (self.b[at] @ self.a[i]).astype(np.int64)

    def anchors(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Place, lower and upper bounds of every anchor; who scores rows writes their scores into both."""
        for i, parent in enumerate(self.parents.tolist()):
            if parent < 0:
                low = self.scores(i, np.arange(len(self.b))).astype(np.float64)
                high = low.copy()
            else:
                # One unit makes up for rounding of lengths and norms.
                reach = self.edges[i] * self.norms * (1 + 1e-9) + 1
                low, high = self.bounds[parent]
                low, high = low - reach, high + reach
                self.open[parent] -= 1
                if not self.open[parent]:
                    del self.bounds[parent]
            yield i, low, high
            if self.open[i]:
                self.bounds[i] = low, high

    def rescore(self, i: int, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        exact = self.scores(i, at)
        low[at] = high[at] = exact
        return exact

    def first(self, at: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        """Positions of the n best: by score, then id, then row."""
        if len(scores) > n:
            near = np.flatnonzero(scores >= np.partition(scores, -n)[-n])
            return near[np.lexsort((self.rows[at[near]], self.ids[at[near]], -scores[near]))][:n]
        return np.lexsort((self.rows[at], self.ids[at], -scores))


def block_positives(panel: dict, block: dict) -> list[tuple]:
    """Per anchor the best rows of its label in a block."""
    walk, out = Walk(panel, block), []
    for i, low, high in walk.anchors():
        at = np.flatnonzero((walk.labels == walk.anchor_labels[i]) & (walk.rows != walk.anchor_rows[i]))
        if len(at) > POSITIVES:
            at = at[high[at] >= np.partition(low[at], -POSITIVES)[-POSITIVES]]
        if not len(at):
            continue
        scores = walk.rescore(i, at, low, high)
        for k in walk.first(at, scores, POSITIVES).tolist():
            j = at[k]
            out.append((panel["panel"], i, walk.anchor_rows[i], walk.anchor_ids[i], walk.rows[j], walk.ids[j], scores[k]))
    return out


def block_negatives(panel: dict, block: dict) -> list[tuple]:
    """Per anchor and positive the best rows of other labels in a block whose score is in the window."""
    asked: dict[int, list] = {}
    for w in panel["windows"]:
        asked.setdefault(w["at"], []).append((w["positive_rank"], w["positive_id"], w["score"]))
    walk, out = Walk(panel, block), []
    for i, low, high in walk.anchors():
        windows = [(*w, -(-LEAST * w[2] // 100), MOST * w[2] // 100) for w in asked.get(i, [])]
        windows = [w for w in windows if w[3] <= w[4]]
        if not windows:
            continue
        least, most = min(w[3] for w in windows), max(w[4] for w in windows)
        at = np.flatnonzero((high >= least) & (low <= most) & (walk.labels != walk.anchor_labels[i]))
        if not len(at):
            continue
        scores = walk.rescore(i, at, low, high)
        for rank, positive, score, bottom, top in windows:
            inside = np.flatnonzero((scores >= bottom) & (scores <= top))
            if not len(inside):
                continue
            held = at[inside]
            for k in walk.first(held, scores[inside], NEGATIVES).tolist():
                j = held[k]
                out.append((walk.anchor_rows[i], walk.anchor_ids[i], rank, positive, score, walk.rows[j], walk.ids[j], scores[inside[k]]))
    return out


def _each(work, names: list[str], types: list[pa.DataType]):
    """Run a function over pairs of a panel and a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                found = work(pair, pair)
                if found:
                    columns = zip(*found, strict=True)
                    arrays = [
                        pa.array([None if name.endswith("_id") and v == _NO_ID else int(v) for v in column], kind)
                        for name, kind, column in zip(names, types, columns, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _schema(text: str) -> tuple[list[str], list[pa.DataType]]:
    pairs = [p.split() for p in text.split(",")]
    return [p[0] for p in pairs], [pa.int32() if p[1] == "int" else pa.int64() for p in pairs]


def _best(found: DataFrame, keys: list[str], score: str, who: str, n: int, rank: str) -> DataFrame:
    order = [F.desc(score), F.asc_nulls_last(f"{who}_id"), F.asc(f"{who}_row")]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn(rank, place).where(F.col(rank) <= n)


def hard_negatives(vectors: DataFrame, every: int = 100) -> DataFrame:
    """Hard negatives of the rows whose ``vec_id`` is divisible by ``every``.

    ``vectors`` has ``vec_id, embedding, label``.  Rows with a null label, a null vector or a null or
    non-finite component take no part.  Returns ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``: per anchor the 5 best rows of its label are positives, and per
    positive the 10 best rows of other labels with ``30 * positive_score <= 100 * negative_score <=
    90 * positive_score``.  Ties go to the smaller id, then to the earlier row; a null id is last and
    no anchor.  Rows with one id are rows of their own, so each may be another's positive.  Where vectors differ
    in length, what is missing counts as zero.  An empty vector scores zero.  Components are cut off
    at +-2^18.  Further columns are ignored.  No anchors, or an empty table, give no rows.
    """
    taken = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull())
    taken = taken.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    panels_n = max(1, -(-taken.where(F.col("vec_id") % every == 0).count() // PANEL_ROWS))
    blocks = stored(taken.mapInArrow(_blocks, _BLOCK), "negatives")

    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids, rows, labels = (_longs(block[c]) for c in ("ids", "rows", "labels"))
                x = _matrix(block["vectors"], block["width"])
                at = np.flatnonzero((ids % every == 0) & (ids != _NO_ID)).tolist()
                # In turn, from a panel on that differs by block.
                panel = [(block["block"] // BLOCK_ROWS * 7919 + k) % panels_n for k in range(len(at))]
                arrays = [pa.array(panel, pa.int32()), *[pa.array(v[at], pa.int64()) for v in (ids, rows, labels)], pa.array([x[i].tobytes() for i in at], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["panel", "id", "row", "label", "vector"])

    panels = stored(blocks.mapInArrow(anchors_of, _ANCHOR).groupBy("panel").applyInArrow(_panel, _PANEL), "negatives")
    everywhere = blocks.withColumn("panel", F.explode(F.sequence(F.lit(0), F.lit(panels_n - 1))))

    found = everywhere.join(panels, "panel").mapInArrow(_each(block_positives, *_schema(_POSITIVE)), _POSITIVE)
    positives = stored(_best(found, ["anchor_row"], "score", "positive", POSITIVES, "positive_rank"), "negatives")
    window = F.struct("at", "positive_rank", F.coalesce("positive_id", F.lit(int(_NO_ID))).alias("positive_id"), "score")
    windows = positives.groupBy("panel").agg(F.collect_list(window).alias("windows"))
    pairs = everywhere.join(panels.join(windows, "panel"), "panel")
    found = pairs.mapInArrow(_each(block_negatives, *_schema(_NEGATIVE)), _NEGATIVE)
    best = _best(found, ["anchor_row", "positive_rank"], "negative_score", "negative", NEGATIVES, "rank")
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(vectors: DataFrame) -> DataFrame:
    """The table with the label of every seventh id moved on by one."""
    moved = (F.col("label") + 1) % 10
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label")))
