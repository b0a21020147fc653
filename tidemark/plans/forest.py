"""Random forests whose rows and trees both stay tables.

MLlib sends a histogram of every node and feature through a shuffle at every level,
and keeps all nodes on the driver. Deep forests spend nearly all their time there.
Here rows become short binary codes, once. Nodes with many rows are split from
summed histograms, as there; a node of at most ``whole_rows`` rows is handed to one
task, which grows all that is below it. A tree is one or more rows of a written
table, and no tree ever is on the driver.

Trees are asked per distinct row of codes, by tasks that each hold some of the
trees and see all the codes. Shares are whole numbers, so their sums do not depend
on the order in which tasks end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ranking import fresh
from tidemark.plans.trees import WHOLE_SHARE, Candidates, Shape, Tree, best_of, goes_right, grown, shares
from tidemark.session import materialize

#: Bins of a numeric feature, as in MLlib.
BINS = 32
#: Rows that one task may hold.
WHOLE_ROWS = 1_000_000
CHUNK_ROWS = 16_384
#: Nodes whose histograms one pass takes, and trees whose rows one shuffle holds.
WAVE_NODES, WAVE_TREES = 1_024, 16
#: Bytes of trees that a task holds while it asks them.
GROUP_BYTES = 32_000_000
TREE = ("column", "cut", "left", "leaves")
PARTS = "part int, tree int, path binary, " + ", ".join(f"{name} binary" for name in TREE)

#: From the root to a node: (column, cut, whether right) of each step.
Path = tuple[tuple[int, int, bool], ...]


def binary(rows: np.ndarray) -> pa.Array:
    """A binary value per element of a structured array."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())])


def number_cuts(df: DataFrame, columns: Sequence[str], *more: Column) -> tuple[list[list[float]], Row]:
    """Cuts between the bins of each column: between all values if they are few, else quantiles of all rows and the least value.

    ``more`` aggregates are worked out in the same pass.
    """
    quoted = {c: F.col(f"`{c}`").cast("double") for c in columns}
    probs = [i / BINS for i in range(1, BINS)]
    facts = [fn(quoted[c]).alias(f"{name}:{c}") for c in columns for name, fn in (("n", F.approx_count_distinct), ("low", F.min), ("high", F.max))]
    facts += [F.percentile_approx(quoted[c], probs, 10_000).alias(f"q:{c}") for c in columns]
    found = df.agg(F.lit(1), *facts, *more).first()
    few = [c for c in columns if found[f"n:{c}"] <= 2 * BINS]
    values = df.agg(*[F.array_sort(F.collect_set(quoted[c])).alias(c) for c in few]).first().asDict() if few else {}
    cuts = []
    for c in columns:
        own = values.get(c)
        if own is not None and len(own) <= BINS:
            cuts.append([(a + b) / 2 for a, b in zip(own, own[1:], strict=False)])
        else:
            cuts.append(sorted({x for x in (found[f"low:{c}"], *(found[f"q:{c}"] or ())) if x is not None and x < found[f"high:{c}"]}))
    return cuts, found


def coded(columns: Sequence[str], cuts: list[list[float]], shape: Shape, classes: Sequence[int] = (), label: str | None = None, weight: str | None = None) -> Column:
    """The binary code of a row; with ``label`` and ``weight`` as a row to train with."""
    dtype = shape.row if label is None else shape.training_row
    numeric = len(cuts)

    @F.arrow_udf("binary")
    def of(values: pa.Array) -> pa.Array:
        parts = [x.to_numpy(zero_copy_only=False) for x in values.flatten()]
        rows = np.zeros(len(values), dtype)
        for i, edges in enumerate(cuts):
            if np.isnan(parts[i]).any():
                raise ValueError(f"feature {columns[i]} has NaN")
            rows["bins"][:, i] = np.searchsorted(np.array(edges), parts[i])
        for i in range(len(shape.sizes)):
            rows["codes"][:, i] = parts[numeric + i]
        if label is not None:
            rows["label"], rows["weight"] = np.searchsorted(classes, parts[-2]), parts[-1]
        return binary(rows)

    wanted = [*columns, *([label, weight] if label is not None else [])]
    return of(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(wanted)]))


def chunks_of(rows: DataFrame, width: int) -> DataFrame:
    """Rows of one binary column as a written table of chunks; equal tables give equal chunks."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, waiting = TaskContext.get().partitionId(), 0, []

        def chunk() -> pa.RecordBatch:
            data = b"".join(waiting)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "place": pa.array([place], pa.int32()), "n": [len(data) // width], "rows": [data]})

        for batch in batches:
            own = batch.column(0).to_pylist()
            for at in range(0, len(own), CHUNK_ROWS):
                room = CHUNK_ROWS - len(waiting)
                waiting += own[at : at + room]
                if len(waiting) == CHUNK_ROWS:
                    yield chunk()
                    place, waiting = place + 1, []
                waiting += own[at + room : at + CHUNK_ROWS]
        if waiting:
            yield chunk()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = rows.columns[0]
    sorted_rows = rows.repartition(parts, name).sortWithinPartitions(name)
    return materialize(sorted_rows.mapInArrow(chunked, "part int, place int, n bigint, rows binary"), "forest-rows")


def times_drawn(seed: int, tree: int, part: int, place: int, n: int) -> np.ndarray:
    """How often the bootstrap of a tree takes each row of a chunk."""
    return np.random.default_rng([seed, tree, part, place]).poisson(1.0, n)


def inside(m: np.ndarray, path: Path, numeric: int) -> np.ndarray:
    """Which rows a path leads through."""
    here = np.ones(len(m), bool)
    for column, cut, right in path:
        here &= goes_right(m[:, column], column, cut, numeric) == right
    return here


def part_row(part: int, tree: int, path: Path, body: Tree) -> dict:
    found = {"part": part, "tree": tree, "path": np.array(path, np.int32).tobytes()}
    return found | {name: getattr(body, name).tobytes() for name in TREE}


def parts_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"part": pa.int32(), "tree": pa.int32()}
    names = rows[0].keys()
    return pa.RecordBatch.from_pydict({name: pa.array([row[name] for row in rows], kinds.get(name, pa.binary())) for name in names})


class ForestClassifier(Estimator):
    """Trees on ``numbers`` and on every known value of the ``codes`` columns (``sizes`` values each), as after one-hot encoding.

    Each tree takes every row as often as a Poisson draw says, and tries the
    square root of the features at each node.
    """

    def __init__(
        self,
        numbers: Sequence[str],
        codes: Sequence[str],
        sizes: Sequence[int],
        label: str,
        weight: str,
        trees: int,
        depth: int = 30,
        min_leaf: int = 1,
        seed: int = 42,
        whole_rows: int = WHOLE_ROWS,
    ):
        super().__init__()
        self.numbers, self.codes, self.sizes = list(numbers), list(codes), list(sizes)
        self.label, self.weight, self.trees, self.depth = label, weight, trees, depth
        self.min_leaf, self.seed, self.whole_rows = min_leaf, seed, whole_rows

    def _fit(self, dataset: DataFrame) -> ForestModel:
        # Written, so that the joins of the codes are worked out once.
        wanted = [*self.numbers, *self.codes, self.label, self.weight]
        dataset = materialize(dataset.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in wanted]), "forest-input")
        cuts, facts = number_cuts(dataset, self.numbers, F.collect_set(self.label).alias("classes"), F.count("*").alias("rows"))
        classes, rows = sorted(map(int, facts["classes"])), facts["rows"]
        if not classes:
            raise ValueError("no rows to learn from")
        shape = Shape(tuple(len(c) + 1 for c in cuts), tuple(self.sizes), len(classes))
        code = coded([*self.numbers, *self.codes], cuts, shape, classes, self.label, self.weight)
        chunks = chunks_of(dataset.select(code.alias("row")), shape.training_row.itemsize)
        table = self._whole(chunks, shape) if rows <= self.whole_rows else self._far(chunks, shape)
        size = sum((F.length(name) for name in TREE[1:]), F.length(TREE[0]))
        sizes = [r["size"] for r in sorted(table.select("part", size.alias("size")).collect())]
        return ForestModel(self.numbers, self.codes, self.sizes, cuts, classes, self.trees, sizes, table)

    def _grower(self, shape: Shape):
        drawn = min(shape.features, max(1, math.ceil(math.sqrt(shape.features))))
        seed, depth, least = self.seed, self.depth, self.min_leaf

        def grow(rows: np.ndarray, times: np.ndarray, tree: int, part: int, path: Path) -> Tree:
            taken = times > 0 if times.any() else np.ones(len(rows), bool)
            rows, times = rows[taken], np.maximum(times[taken], 1)
            rng = np.random.default_rng([seed, tree, part, len(path), 1])
            return grown(shape, shape.matrix(rows), rows["label"].astype(np.int64), rows["weight"], times, drawn, least, depth - len(path), rng)

        return grow

    def _whole(self, chunks: DataFrame, shape: Shape) -> DataFrame:
        """Trees that a task each grows from all rows."""
        spark, seed, grow = chunks.sparkSession, self.seed, self._grower(shape)
        found = sorted(chunks.collect(), key=lambda r: (r["part"], r["place"]))  # whole_rows short rows at most
        shared = spark.sparkContext.broadcast(([(r["part"], r["place"], r["n"]) for r in found], b"".join(r["rows"] for r in found)))
        del found

        def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, data = shared.value
            rows = np.frombuffer(data, shape.training_row)
            for batch in batches:
                for tree in batch.column(0).to_pylist():
                    times = np.concatenate([times_drawn(seed, tree, *key) for key in keys])
                    yield parts_batch([part_row(tree, tree, (), grow(rows, times, tree, tree, ()))])

        tasks = min(self.trees, 4 * spark.sparkContext.defaultParallelism)
        table = materialize(spark.range(0, self.trees, 1, tasks).mapInArrow(trees, PARTS), "forest")
        shared.unpersist()
        return table

    def _far(self, chunks: DataFrame, shape: Shape) -> DataFrame:
        """Trees whose upper nodes are split from histograms of all chunks, until one task can hold what is below."""
        spark = chunks.sparkSession
        ready: list[tuple[int, Path]] = []
        done: list[tuple[int, Path, Tree]] = []
        waiting: list[tuple[int, Path]] = [(tree, ()) for tree in range(self.trees)]
        while waiting:
            wave, waiting = waiting[:WAVE_NODES], waiting[WAVE_NODES:]
            for (tree, path), split in zip(wave, self._splits(chunks, shape, wave), strict=True):
                if split["column"] < 0:
                    totals = np.frombuffer(split["totals"])[None, :]
                    leaf = Tree(*(np.array([x], np.int32) for x in (-1, 0, 0)), shares(totals))
                    done.append((tree, path, leaf))
                    continue
                for right, n in ((False, split["left_rows"]), (True, split["right_rows"])):
                    child = (tree, (*path, (split["column"], split["cut"], right)))
                    large = n > self.whole_rows and len(child[1]) < self.depth
                    (waiting if large else ready).append(child)
        ready.sort()
        tables, part = [], 0
        trees = sorted({tree for tree, _ in ready})
        for at in range(0, len(trees), WAVE_TREES):
            own = set(trees[at : at + WAVE_TREES])
            nodes = [(tree, path) for tree, path in ready if tree in own]
            tables.append(self._below(chunks, shape, nodes, part))
            part += len(nodes)
        if done:
            rows = [part_row(part + i, *node) for i, node in enumerate(sorted(done, key=lambda x: x[:2]))]
            tables.append(spark.createDataFrame([tuple(map(_plain, row.values())) for row in rows], PARTS))
        table = tables[0]
        for other in tables[1:]:
            table = table.unionByName(other)
        return materialize(table, "forest") if len(tables) > 1 else table

    def _splits(self, chunks: DataFrame, shape: Shape, nodes: list[tuple[int, Path]]) -> list[dict]:
        """For each node its best split, and how many rows go each way."""
        seed, least, numeric, classes = self.seed, self.min_leaf, len(shape.bins), shape.classes
        drawn = min(shape.features, max(1, math.ceil(math.sqrt(shape.features))))
        tried = []
        for tree, path in nodes:
            rng = np.random.default_rng([seed, tree, 2, *(x for step in path for x in map(int, step))])
            column, value = shape.column_cut(np.sort(shape.drawn(rng, 1, drawn)[0]))
            tried.append(list(zip(column.tolist(), value.tolist(), strict=True)))
        width = max(2, *shape.bins) if shape.bins else 2
        by_tree = [(tree, [i for i, _ in own]) for tree, own in groupby(sorted(enumerate(nodes), key=lambda x: x[1][0]), key=lambda x: x[1][0])]

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # By node: weights of the classes, rows and bootstrapped rows, of each bin of each feature tried.
            sums: dict[int, np.ndarray] = {}
            first = None
            for batch in batches:
                for part, place, n, data in zip(*(batch.column(x).to_pylist() for x in ("part", "place", "n", "rows")), strict=True):
                    first = (part, place) if first is None else first
                    rows = np.frombuffer(data, shape.training_row)
                    m = shape.matrix(rows)
                    for tree, own in by_tree:
                        times = times_drawn(seed, tree, part, place, n)
                        for i in own:
                            here = np.flatnonzero(inside(m, nodes[i][1], numeric) & (times > 0))
                            if not len(here):
                                continue
                            into = sums.setdefault(i, np.zeros((drawn, width, classes + 2)))
                            label, count = rows["label"][here], times[here]
                            for f, (column, value) in enumerate(tried[i]):
                                bins = m[here, column] if column < numeric else (m[here, column] == value).astype(np.int64)
                                into[f, :, :classes] += np.bincount(bins * classes + label, rows["weight"][here] * count, width * classes).reshape(width, classes)
                                into[f, :, classes] += np.bincount(bins, minlength=width)
                                into[f, :, classes + 1] += np.bincount(bins, count, width)
            for i, found in sums.items():
                yield pa.RecordBatch.from_pydict({"node": pa.array([i], pa.int32()), "part": pa.array([first[0]], pa.int32()), "place": pa.array([first[1]], pa.int32()), "sums": [found.tobytes()]})

        def choose(table: pa.Table) -> pa.Table:
            table = table.sort_by([("part", "ascending"), ("place", "ascending")])
            node = table.column("node")[0].as_py()
            total = sum(np.frombuffer(x).reshape(drawn, width, classes + 2) for x in table.column("sums").to_pylist())
            whole = total[0].sum(axis=0)
            found = []
            for f, (column, value) in enumerate(tried[node]):
                upto = total[f].cumsum(axis=0) if column < numeric else total[f, :1]
                cut = np.arange(len(upto)) if column < numeric else np.array([value])
                found.append(Candidates(np.zeros(len(upto), np.int64), np.full(len(upto), column), cut, upto[:, :classes], upto[:, classes + 1]))
            column, cut = (int(x[0]) for x in best_of(found, whole[None, :classes], whole[None, classes + 1], least))
            left = 0
            if column >= 0:
                f = next(i for i, x in enumerate(tried[node]) if x[0] == column and (column < numeric or x[1] == cut))
                left = int(total[f, : cut + 1 if column < numeric else 1, classes].sum())
            row = {"node": pa.array([node], pa.int32()), "column": pa.array([column], pa.int32()), "cut": pa.array([cut], pa.int32())}
            return pa.table(row | {"left_rows": [left], "right_rows": [int(whole[classes]) - left], "totals": [whole[:classes].tobytes()]})

        sums = chunks.mapInArrow(measure, "node int, part int, place int, sums binary")
        found = sums.groupBy("node").applyInArrow(choose, "node int, column int, cut int, left_rows bigint, right_rows bigint, totals binary")
        by_node = {r["node"]: r.asDict() for r in found.collect()}  # one short row a node
        return [by_node[i] for i in range(len(nodes))]

    def _below(self, chunks: DataFrame, shape: Shape, nodes: list[tuple[int, Path]], first: int) -> DataFrame:
        """Everything below some nodes, each grown by one task from the rows that reach it."""
        seed, numeric, grow = self.seed, len(shape.bins), self._grower(shape)
        by_tree = [(tree, [i for i, _ in own]) for tree, own in groupby(enumerate(nodes), key=lambda x: x[1][0])]

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, place, n, data in zip(*(batch.column(x).to_pylist() for x in ("part", "place", "n", "rows")), strict=True):
                    rows = np.frombuffer(data, shape.training_row)
                    m = shape.matrix(rows)
                    for tree, own in by_tree:
                        times = times_drawn(seed, tree, part, place, n)
                        for i in own:
                            here = np.flatnonzero(inside(m, nodes[i][1], numeric) & (times > 0))
                            if len(here):
                                key = {x: pa.array([v], pa.int32()) for x, v in (("node", i), ("part", part), ("place", place))}
                                yield pa.RecordBatch.from_pydict(key | {"times": [times[here].astype(np.int64).tobytes()], "rows": [rows[here].tobytes()]})

        def below(table: pa.Table) -> pa.Table:
            table = table.sort_by([("part", "ascending"), ("place", "ascending")])
            i = table.column("node")[0].as_py()
            rows = np.frombuffer(b"".join(table.column("rows").to_pylist()), shape.training_row)
            times = np.frombuffer(b"".join(table.column("times").to_pylist()), np.int64)
            tree, path = nodes[i]
            return pa.Table.from_batches([parts_batch([part_row(first + i, tree, path, grow(rows, times, tree, first + i, path))])])

        dealt = chunks.mapInArrow(deal, "node int, part int, place int, times binary, rows binary")
        return materialize(dealt.groupBy("node").applyInArrow(below, PARTS), "forest")


def _plain(value):
    return bytearray(value) if isinstance(value, bytes) else value


class ForestModel(Transformer, MLWritable, MLReadable):
    """Adds ``probability`` (by class from 0 to the largest) and ``prediction``, the likeliest class and of equals the smallest."""

    def __init__(
        self,
        numbers: Sequence[str] = (),
        codes: Sequence[str] = (),
        sizes: Sequence[int] = (),
        cuts: Sequence[Sequence[float]] = (),
        classes: Sequence[int] = (),
        trees: int = 0,
        part_bytes: Sequence[int] = (),
        table: DataFrame | None = None,
    ):
        super().__init__()
        self.numbers, self.codes, self.sizes = list(numbers), list(codes), list(sizes)
        self.cuts, self.classes, self.trees = [list(c) for c in cuts], list(classes), trees
        self.part_bytes, self.table = list(part_bytes), table

    @property
    def shape(self) -> Shape:
        return Shape(tuple(len(c) + 1 for c in self.cuts), tuple(self.sizes), len(self.classes))

    def _groups(self, parallel: int) -> list[int]:
        """Group of each part: about as many bytes in each, and of a size that a task can hold."""
        total = sum(self.part_bytes)
        groups = min(len(self.part_bytes), max(2 * parallel, math.ceil(total / GROUP_BYTES)))
        before = np.concatenate([[0], np.cumsum(self.part_bytes)[:-1]])
        return np.unique((before * groups // total).astype(int), return_inverse=True)[1].tolist()

    def scores(self, keys: DataFrame) -> DataFrame:
        """Distinct row codes with the sum over all trees of the shares of each class, as columns s0, s1 and so on."""
        name, shape = keys.columns[0], self.shape
        groups = self._groups(keys.sparkSession.sparkContext.defaultParallelism)
        count = max(groups) + 1
        body = ["path", *TREE]
        trees = self.table.select(
            F.get(F.array(*map(F.lit, groups)), F.col("part")).alias("group"), F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("key"), *body
        )
        asked = keys.select(F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("group"), F.lit(1).alias("kind"), F.col(name).alias("key"), *[F.lit(None).cast("binary").alias(x) for x in body])
        sums = [f"s{i}" for i in range(shape.classes)]

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, held = -1, []
            for batch in batches:
                group, kind = (batch.column(x).to_numpy() for x in ("group", "kind"))
                edges = np.flatnonzero(np.diff(group * 2 + kind)) + 1
                for start, end in zip([0, *edges], [*edges, len(group)], strict=True):
                    part = batch.slice(start, end - start)
                    if group[start] != own:
                        own, held = group[start], []
                    if not kind[start]:
                        for row in part.select(body).to_pylist():
                            steps = [(int(c), int(v), bool(r)) for c, v, r in np.frombuffer(row["path"], np.int32).reshape(-1, 3)]
                            arrays = [np.frombuffer(row[x], np.int32) for x in TREE]
                            held.append((steps, Tree(*arrays[:3], arrays[3].reshape(-1, shape.classes))))
                        continue
                    keyed = part.column("key")
                    m = shape.matrix(np.frombuffer(b"".join(keyed.to_pylist()), shape.row))
                    total = np.zeros((len(m), shape.classes), np.int64)
                    for path, tree in held:
                        if path:
                            here = np.flatnonzero(inside(m, path, len(shape.bins)))
                            total[here] += tree.answers(m[here], len(shape.bins))
                        else:
                            total += tree.answers(m, len(shape.bins))
                    yield pa.RecordBatch.from_arrays([keyed, *(pa.array(x) for x in total.T)], [name, *sums])

        # Trees first, then the codes to ask them.
        dealt = trees.unionByName(asked).repartitionById(count, F.col("group")).sortWithinPartitions("group", "kind")
        found = dealt.mapInArrow(ask, f"`{name}` binary, " + ", ".join(f"{s} bigint" for s in sums))
        return found.groupBy(name).agg(*[F.sum(s).alias(s) for s in sums])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = fresh(dataset, "_forest_row")
        rows = dataset.withColumn(name, coded([*self.numbers, *self.codes], self.cuts, self.shape))
        scores = self.scores(rows.select(name).distinct())
        sums = [F.col(f"s{i}") for i in range(len(self.classes))]
        most = F.greatest(*sums) if len(sums) > 1 else sums[0]
        shares = {c: s / F.lit(float(self.trees * WHOLE_SHARE)) for c, s in zip(self.classes, sums, strict=True)}
        likeliest = F.get(F.array(*[F.lit(float(c)) for c in self.classes]), (F.array_position(F.array(*sums), most) - 1).cast("int"))
        vector = F.array(*[shares.get(c, F.lit(0.0)) for c in range(max(self.classes) + 1)])
        answers = scores.select(name, array_to_vector(vector).alias("probability"), likeliest.alias("prediction"))
        return rows.join(answers, name, "left").drop(name)

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


FACTS = ("numbers", "codes", "sizes", "cuts", "classes", "trees", "part_bytes")


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802 - the name Spark calls
        facts = {name: getattr(self.model, name) for name in FACTS}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=facts)
        self.model.table.write.parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.active()
        facts = DefaultParamsReader.loadMetadata(path, spark)
        model = ForestModel(*(facts[name] for name in FACTS), spark.read.schema(PARTS).parquet(f"{path}/trees"))
        model._resetUid(facts["uid"])
        return model
