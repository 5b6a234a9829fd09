"""Random forests grown in blocks of trees.

A large forest is a set of small ones: each block has its own seed and a part of
the trees, and the forest's class probabilities are the mean of its blocks',
weighted by their trees. A fit keeps the split statistics of a block only, and
tasks look up where a row stands in every tree in a cache of node ids
(checkpointed to the shared folder now and then) in place of receiving the
trees grown so far.

Rows are kept in partitions of ``ROWS_PER_PARTITION``. Statistics of a split are
shuffled once per partition and node, so a small table in few partitions costs
least; its blocks then run beside each other, until the cores are in use.

Features of the risk model are years, codes and flags, so many rows are equal. Equal
rows are a cell (:func:`cells`: features, label, number of rows), and trees are grown
over the cells, each from its own bootstrap. A bootstrap gives each row a Poisson(1)
number, so the rows of a cell together have a Poisson(n) one: the trees are distributed
as those over rows, and the fit no longer grows with the copies of a cell. Up to
``CELLS_PER_TASK`` cells, tasks grow whole trees (:mod:`strata.operators.trees`). Of more
cells, every tree is a fit of its own where at least ``ROWS_PER_CELL`` rows share one, and
blocks are fitted to the rows otherwise.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from strata.operators import trees as whole_trees
from strata.session import ensure_checkpoint_dir

TREES_PER_BLOCK = 38
ROWS_PER_PARTITION = 250_000
PARALLEL_BLOCKS = 8
CHECKPOINT_INTERVAL = 10
ROWS_PER_CELL = 4
#: Cells that a task holds, as codes, to grow whole trees; the driver sends them out.
CELLS_PER_TASK = 250_000
CLASSES_PER_TASK = 32
PARALLEL_TREES = 12


@dataclass(frozen=True)
class Forest:
    """Blocks of trees over a ``features`` vector; ``labels[i]`` names class ``i``."""

    blocks: tuple[RandomForestClassificationModel, ...] | tuple[whole_trees.Block, ...]
    labels: tuple[str, ...]

    @property
    def trees(self) -> int:
        return sum(b.getNumTrees for b in self.blocks)

    def importances(self, features: list[str]) -> list[tuple[str, float]]:
        """Mean impurity decrease per feature over all trees, adding up to 1."""
        total = [0.0] * len(features)
        for block in self.blocks:
            for i, v in enumerate(block.featureImportances.toArray()):
                total[i] += float(v) * block.getNumTrees
        whole = sum(total) or 1.0
        return [(f, v / whole) for f, v in zip(features, total, strict=True)]

    def scored(self, df: DataFrame, out: str = "prediction", probabilities: str = "probabilities") -> DataFrame:
        """``df`` with class probabilities (in the order of ``labels``) and the
        likeliest label, the first of equally likely ones."""
        if isinstance(self.blocks[0], whole_trees.Block):
            found = df.withColumn(probabilities, whole_trees.probabilities(
                df.sparkSession, self.blocks, vector_to_array("features")))
            return self._likeliest(found, out, probabilities)
        names = []
        for i, block in enumerate(self.blocks):
            names.append(f"_block{i}")
            df = block.copy().setRawPredictionCol("").setPredictionCol("").setProbabilityCol(names[-1]).transform(df)
        share = [b.getNumTrees / self.trees for b in self.blocks]
        classes = [sum((vector_to_array(n)[k] * s for n, s in zip(names[1:], share[1:], strict=True)),
                       vector_to_array(names[0])[k] * share[0]) for k in range(len(self.labels))]
        return self._likeliest(df.withColumn(probabilities, F.array(*classes)).drop(*names), out, probabilities)

    def _likeliest(self, found: DataFrame, out: str, probabilities: str) -> DataFrame:
        best = F.array_position(probabilities, F.array_max(probabilities)).cast("int")
        return found.withColumn(out, F.element_at(F.array(*map(F.lit, self.labels)), best))


def memory_mb(spark) -> int:
    """Split statistics that one task may hold: a third of a core's share of the
    heap, between 32 and 512 MB."""
    conf = spark.sparkContext.getConf()
    if spark.sparkContext.master.startswith("local"):
        heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory() / (1 << 20)
        cores = spark.sparkContext.defaultParallelism
    else:
        heap = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(
            conf.get("spark.executor.memory", "1g"))
        cores = int(conf.get("spark.executor.cores", "1"))
    return int(max(32, min(512, heap / (3 * max(cores, 1)))))


def partitioned(df: DataFrame, n_rows: int) -> DataFrame:
    """``df`` in as many partitions as its rows need, never more than it has."""
    parts = max(1, math.ceil(n_rows / ROWS_PER_PARTITION))
    return df.coalesce(parts) if parts < df.rdd.getNumPartitions() else df


def cells(rows: DataFrame, features: list[str], folds: int = 0) -> DataFrame:
    """Distinct ``(*features, label)`` with ``n``, their number of rows, ``cell``, a hash
    of both, and ``n_<fold>``, the rows in each of ``folds``."""
    keys = [*features, "label"]
    per = [F.count(F.when(F.col("fold") == f, 1)).alias(f"n_{f}") for f in range(folds)]
    found = rows.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.count(F.lit(1)).alias("n"), *per)
    return found.withColumn("cell", F.xxhash64(*(F.col(f"`{k}`") for k in keys)))


def by_cells(n_rows: int, n_cells: int) -> bool:
    """Whether trees are grown over cells: where a task holds them all, or where they are
    few for their rows and blocks would not take all rows in one partition."""
    return n_cells <= CELLS_PER_TASK or (n_rows > ROWS_PER_PARTITION and n_rows >= ROWS_PER_CELL * n_cells)


def _draws(seed: int, trees: int):
    def drawn(batches):
        for batch in batches:
            n = batch.column(batch.schema.names.index("n")).to_numpy()
            if len(n):
                first = batch.column(batch.schema.names.index("cell"))[0].as_py()
                draws = np.random.default_rng([seed, first & (2**63 - 1)]).poisson(n[:, None], (len(n), trees))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * trees), pa.array(draws.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "draws"])
    return drawn


def _joined(fits: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """Forests of one tree each as one forest."""
    jvm, gateway = SparkContext._active_spark_context._jvm, SparkContext._gateway
    kinds = jvm.org.apache.spark.ml.classification
    trees = gateway.new_array(kinds.DecisionTreeClassificationModel, len(fits))
    for i, fit in enumerate(fits):
        trees[i] = fit.trees[0]._java_obj
    forest = kinds.RandomForestClassificationModel(trees, fits[0].numFeatures, fits[0].numClasses)
    forest.set("numTrees", len(fits))
    return RandomForestClassificationModel(forest)


def grown_over_cells(train: DataFrame, features: list[str], labels: list[str], trees: int, depth: int, seed: int,
                     n_cells: int) -> Forest:
    """:func:`grown` over cells (``features``, ``label_idx``, ``weight`` of a row, ``n``, ``cell``).
    Where a task does not hold all cells, the bootstraps of a block of trees are drawn at
    once and held in memory with the cells."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    sizes = [min(TREES_PER_BLOCK, trees - done) for done in range(0, trees, TREES_PER_BLOCK)]
    if n_cells <= CELLS_PER_TASK and len(labels) <= CLASSES_PER_TASK:
        found = whole_trees.forest_of(train, features, len(labels), trees, depth, seed)
        ends = np.cumsum(sizes)
        return Forest(tuple(whole_trees.Block(tuple(found[e - n:e])) for e, n in zip(ends, sizes, strict=True)), tuple(labels))
    parts = max(1, math.ceil(n_cells / ROWS_PER_PARTITION))
    # In one order: a run over the same rows draws the same bootstraps.
    train = train.repartition(parts, "cell").sortWithinPartitions("cell", "label_idx")
    with_draws = StructType([*train.schema.fields, StructField("draws", ArrayType(LongType()))])
    classes = F.col("label_idx").alias("label_idx", metadata=train.schema["label_idx"].metadata)
    base = RandomForestClassifier(
        featuresCol="features", labelCol="label_idx", weightCol="weight", numTrees=1, bootstrap=False, maxDepth=depth,
        featureSubsetStrategy="sqrt", impurity="gini", maxMemoryInMB=memory_mb(spark))
    workers = max(1, min(PARALLEL_TREES, spark.sparkContext.defaultParallelism // parts))

    def block(number: int) -> RandomForestClassificationModel:
        first = seed + 7919 * number
        bags = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(
            train.mapInArrow(_draws(first, sizes[number]), with_draws))
        bags = bags.select("features", classes, "weight", "draws").persist()
        bags.count()

        def one(tree: int):
            bag = bags.select("features", "label_idx", (F.col("weight") * F.col("draws")[tree]).alias("weight"))
            return base.copy().setSeed(first + 104729 * (tree + 1)).fit(bag.filter("weight > 0"))

        try:
            with ThreadPoolExecutor(max_workers=workers) as pool:
                return _joined(list(pool.map(inheritable_thread_target(spark)(one), range(sizes[number]))))
        finally:
            bags.unpersist()

    return Forest(tuple(block(i) for i in range(len(sizes))), tuple(labels))


def grown(train: DataFrame, labels: list[str], trees: int, depth: int, seed: int) -> Forest:
    """Forest over ``train`` (``features``, ``label_idx``, ``weight``), which the caller keeps in memory."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    sizes = [min(TREES_PER_BLOCK, trees - done) for done in range(0, trees, TREES_PER_BLOCK)]
    parts, cores = train.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism
    base = RandomForestClassifier(
        featuresCol="features", labelCol="label_idx", weightCol="weight", maxDepth=depth, featureSubsetStrategy="sqrt",
        impurity="gini", maxMemoryInMB=memory_mb(spark), cacheNodeIds=True, checkpointInterval=CHECKPOINT_INTERVAL)

    def one(block):
        return base.copy().setNumTrees(sizes[block]).setSeed(seed + 7919 * block).fit(train)

    with ThreadPoolExecutor(max_workers=max(1, min(PARALLEL_BLOCKS, cores // parts, len(sizes)))) as pool:
        return Forest(tuple(pool.map(inheritable_thread_target(spark)(one), range(len(sizes)))), tuple(labels))
