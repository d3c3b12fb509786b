"""Graph features: random walks, walk embeddings, clusters and a hyperbolic embedding, as joins and aggregates.

No step collects all neighbours of a node. They stand in lists of bounded length in a seeded order, and a walker picks a place,
so a hub's lists are spread by the join key (node, list) like any other rows.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.keys import md5_order
from rankloom.operators.skew import has_hot_group, hash_positions, hot_limit
from rankloom.operators.state import TableModel
from rankloom.session import LEAST_PACKED, durable, ensure_checkpoint_dir, pin_state
from rankloom.sources.readers import both_directions

PIN_EVERY = 5  # joins between two reliable checkpoints
EDGES_PER_TASK = 1 << 19
#: Neighbours in one row of a list; a node of more has several.
LIST_EDGES = 1 << 12
SIZE_BUCKETS = 1 << 12


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def _has_hub(edges: DataFrame) -> bool:
    """Has a node more edges than one task may sort? Nodes are counted by some thousand buckets first, as there may be as many nodes
    in each task as rows; only if a bucket is above the limit, it may hold such a node."""
    limit = hot_limit(edges)
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    buckets = ends.groupBy(F.pmod(F.xxhash64("node"), F.lit(SIZE_BUCKETS)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return not buckets.where(F.col("n") > limit).isEmpty() and has_hot_group(both_directions(edges), ["src"])


def neighbour_lists(edges: DataFrame, seed: int = 0) -> DataFrame:
    """Rows ``src, chunk, degree, known, dsts``: the neighbours of a node in the seeded hash order, ``LIST_EDGES`` a row, how many
    there are, and how many of them are not null."""
    if _has_hub(edges):
        both = both_directions(edges)
        sizes = both.groupBy("src").agg(F.count(F.lit(1)).alias("degree"), F.count("dst").alias("known"))
        sizes = sizes.withColumnRenamed("src", "_src")
        placed = hash_positions(both, ["src"], ["dst"], seed, "_pos").withColumn("place", F.col("_pos") - 1)
        placed = placed.join(sizes, F.col("src").eqNullSafe(F.col("_src")))
    else:  # one exchange: a node's edges are made distinct, ordered and put together where they are
        both = _turned(edges).repartition("src").distinct()
        node = Window.partitionBy("src")
        place = F.row_number().over(node.orderBy(md5_order(seed, ["dst"]), "dst")) - 1
        placed = both.select("src", "dst", place.alias("place"), F.count(F.lit(1)).over(node).alias("degree"),
                             F.count("dst").over(node).alias("known"))
    chunk = F.floor(F.col("place") / LIST_EDGES).cast("int").alias("chunk")
    return placed.groupBy("src", chunk, "degree", "known").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "dst"))), lambda e: e["dst"]).alias("dsts"))


def _turned(edges: DataFrame) -> DataFrame:
    """Each edge in both directions; repeated ones come repeated."""
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select(F.explode(F.array(F.struct("src", "dst"), back)).alias("e")).select("e.src", "e.dst")


class _Steps:
    """What a step of the walks looks up: the neighbour lists, dealt and sorted for that once, and the nodes of several lists."""

    def __init__(self, edges: DataFrame, seed: int, numbers: DataFrame | None = None):
        edges = edges.select("src", "dst").persist()
        dealt = -(-2 * edges.count() // EDGES_PER_TASK)
        lists = neighbour_lists(edges, seed)
        if numbers is not None:
            lists = lists.join(numbers.withColumnRenamed("node", "_node"), F.col("src").eqNullSafe(F.col("_node"))).drop("_node")
        self.lists = lists.repartition(max(LEAST_PACKED, dealt), "src", "chunk").sortWithinPartitions("src", "chunk").persist()
        self.lists.count()
        edges.unpersist()
        hubs = self.lists.where(f"degree > {LIST_EDGES} AND chunk = 0").select(
            F.col("src").alias("_hub"), F.col("degree").alias("_degree"), F.col("known").alias("_known"))
        self.hubs = None if hubs.isEmpty() else pin_state(hubs)

    def starts(self, walks: int) -> DataFrame:
        nodes = self.lists.where("chunk = 0 AND known > 0")
        return nodes.select(F.col("src").alias("start"), F.explode(F.sequence(F.lit(1), F.lit(walks))).alias("walk"))

    def propose(self, at: DataFrame, salts: list, first: bool = False) -> DataFrame:
        """Each walker with the neighbour ``dst`` that its hash picks. ``first``: among those that are not null."""
        at = at.withColumn("_draw", F.xxhash64(*map(F.lit, salts), F.col("start"), F.col("walk")))
        among = F.lit(1)
        if self.hubs is not None:
            at = at.join(self.hubs, F.col("node") == F.col("_hub"), "left")
            among = F.coalesce("_known" if first else "_degree", among)
        # Not a constant where there are no hubs: it would go from the join's keys, and the lists be dealt anew for each step.
        at = at.withColumn("_chunk", F.floor(F.pmod("_draw", among) / LIST_EDGES).cast("int")).drop("_hub", "_degree", "_known")
        met = at.join(self.lists, (F.col("node") == F.col("src")) & (F.col("_chunk") == F.col("chunk")))
        place = F.pmod("_draw", F.col("known" if first else "degree")) % LIST_EDGES
        found = met.withColumn("dst", F.get("dsts", place.cast("int"))).where("dst IS NOT NULL")
        return found.drop("_draw", "_chunk", "src", "chunk", "degree", "known", "dsts")

    def unpersist(self) -> None:
        self.lists.unpersist()


def random_walks(edges: DataFrame, length: int, walks: int, seed: int = 0, p: float = 1.0, q: float = 1.0) -> DataFrame:
    """G1: ``walks`` walks of ``length`` nodes from every node, as ``start, walk, path``. Repeats exactly for a seed.

    ``p`` and ``q`` are the return and in-out weights of a second-order walk, by rejection sampling.
    """
    # Every step of the walks looks lists up: they are kept as they are dealt and sorted for that, and not dealt again.
    steps = _Steps(edges, seed)
    try:
        at = steps.starts(walks).select("start", "walk", F.array("start").alias("path"), F.col("start").alias("node"))
        for t in range(1, length):
            at = _uniform_step(at, steps, [seed, t], t == 1) if p == q == 1.0 else _biased_step(at, steps, seed, t, p, q)
            if t % PIN_EVERY == 0 and t + 1 < length:
                at = durable(at)
        return durable(at.select("start", "walk", "path"))
    finally:
        steps.unpersist()


def numbered_walks(edges: DataFrame, numbers: DataFrame, length: int, walks: int, seed: int = 0) -> DataFrame:
    """The walks of :func:`random_walks` as ``path``s of the nodes' numbers (``node, id``). A step meets its node's number where it
    looks the neighbours up, so that names need not be carried and looked up afterwards."""
    steps = _Steps(edges, seed, numbers)
    try:
        none = F.array().cast("array<int>")
        at = steps.starts(walks).select("start", "walk", none.alias("path"), F.col("start").alias("node"))
        for t in range(1, length):
            at = steps.propose(at, [seed, t], t == 1).select(
                "start", "walk", F.array_append("path", F.col("id")).alias("path"), F.col("dst").alias("node"))
            if t % PIN_EVERY == 0 and t + 1 < length:
                at = durable(at)
        return durable(at.join(numbers, "node").select(F.array_append("path", F.col("id")).alias("path")))
    finally:
        steps.unpersist()


def _moved(proposed: DataFrame) -> DataFrame:
    return proposed.select(
        "start", "walk", F.array_append("path", F.col("dst")).alias("path"), F.col("dst").alias("node"),
    )


def _uniform_step(at: DataFrame, steps: _Steps, salts: list, first: bool) -> DataFrame:
    return _moved(steps.propose(at, salts, first))


def _biased_step(at: DataFrame, steps: _Steps, seed: int, t: int, p: float, q: float) -> DataFrame:
    """Propose uniformly, accept in proportion to the weight, and propose again for the rejected walkers only."""
    if t == 1:
        return _uniform_step(at, steps, [seed, t, 0], True)
    ceiling = max(1.0, 1.0 / p, 1.0 / q)
    known = steps.lists.select(F.col("src").alias("_before"), F.explode("dsts").alias("dst"), F.lit(True).alias("_near"))
    done, pending, attempt = None, at, 0
    while True:
        tried = steps.propose(pending, [seed, t, attempt]).withColumn("_before", F.element_at("path", -2))
        tried = tried.join(known, ["_before", "dst"], "left")
        weight = (
            F.when(F.col("dst") == F.col("_before"), 1.0 / p).when(F.col("_near"), 1.0).otherwise(1.0 / q) / ceiling
        )
        draw = F.pmod(F.xxhash64(F.lit("accept"), F.lit(seed), F.lit(t), F.lit(attempt), "start", "walk"),
                      F.lit(1_000_003)) / F.lit(1_000_003.0)
        tried = durable(tried.withColumn("_ok", draw < weight))
        accepted = _moved(tried.where("_ok"))
        done = accepted if done is None else done.unionByName(accepted)
        pending = tried.where(~F.col("_ok")).select("start", "walk", "path", "node")
        if pending.isEmpty():
            return done
        attempt += 1


WALKS_PER_TASK = 20_000
MAX_VECTOR_CELLS = (1 << 31) // 8


def walk_embedding(
    edges: DataFrame, dimensions: int = 2, length: int = 20, walks: int = 1000, seed: int = 0, window: int = 5,
    p: float = 1.0, q: float = 1.0, max_iter: int = 1,
) -> DataFrame:
    """G1: skip-gram vectors ``node, vec`` of the walks; the vocabulary is the node set.

    Tasks are fitted on about ``WALKS_PER_TASK`` walks each, never fewer than two. The vocabulary with its vectors is held
    as one array, as Spark's skip-gram has it; a graph beyond that is an error here (the hyperbolic embedding has no such
    limit).
    """
    nodes = nodes_of(edges).count()
    if nodes * dimensions > MAX_VECTOR_CELLS:
        raise ValueError(f"{nodes} nodes of {dimensions} dimensions do not fit one skip-gram vocabulary: use walk_factors")
    partitions = max(2, -(-nodes * walks // WALKS_PER_TASK))
    paths = random_walks(edges, length, walks, seed, p, q).select(F.col("path").cast("array<string>").alias("path"))
    model = Word2Vec(
        vectorSize=dimensions, windowSize=window, minCount=0, maxIter=max_iter, seed=seed, numPartitions=partitions,
        maxSentenceLength=max(length, 1000), inputCol="path", outputCol="_v",
    ).fit(paths)
    return model.getVectors().select(F.col("word").alias("node"), vector_to_array("vector").alias("vec"))


def _each_meeting(walks: DataFrame, window: int) -> DataFrame:
    size = F.size("path")
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.lit(window), size - 1)), lambda d: F.arrays_zip(
        F.slice("path", F.lit(1), size - d).alias("a"), F.slice("path", d + 1, size - d).alias("b"))))
    return walks.where(size > 1).select(F.explode(pairs).alias("p")).select("p.a", "p.b").where("a <> b")


def meetings(walks: DataFrame, window: int = 5) -> DataFrame:
    """``a, b, n``: how often two nodes, ``a < b``, stand within ``window`` steps of each other on a path."""
    return _each_meeting(walks, window).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.count(F.lit(1)).alias("n"))


def meeting_totals(walks: DataFrame, window: int = 5) -> DataFrame:
    """``a, t``: how often a node meets others. From the paths, as a task has fewer nodes of paths than of pairs."""
    ends = _each_meeting(walks, window).select(F.explode(F.array("a", "b")).alias("a"))
    return ends.groupBy("a").agg(F.count(F.lit(1)).alias("t"))


def cooccurrences(walks: DataFrame, window: int = 5) -> DataFrame:
    """``a, b, n``: how often two nodes stand within ``window`` steps of each other on a path, in both directions. Nodes that meet
    themselves do not count."""
    met = meetings(walks, window)
    return met.unionAll(met.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))


def positive_information(counts: DataFrame, once: bool = False, totals: DataFrame | None = None) -> DataFrame:
    """``a, b, n`` and ``weight``, the pointwise mutual information of two nodes where it is above zero. ``once``: each pair stands
    in the table in one direction only. ``totals``: the nodes' own counts ``a, t``, if they are known."""
    if totals is None:
        ends = counts.select(F.explode(F.array("a", "b") if once else F.array("a")).alias("a"), "n")
        totals = ends.groupBy("a").agg(F.sum("n").alias("t"))
    everything = totals.agg(F.sum("t").alias("all"))  # one row
    joined = counts.join(totals, "a").join(totals.select(F.col("a").alias("b"), F.col("t").alias("u")), "b").crossJoin(
        F.broadcast(everything))
    weight = F.log(F.col("n") * F.col("all") / F.col("t") / F.col("u"))
    return joined.select("a", "b", "n", weight.alias("weight")).where("weight > 0")


def walk_factors(
    edges: DataFrame, dimensions: int = 8, length: int = 20, walks: int = 10, seed: int = 0, window: int = 5, p: float = 1.0,
    q: float = 1.0, max_iter: int = 10, alpha: float = 10.0, penalty: float = 0.01,
) -> DataFrame:
    """G1 for graphs of any size: vectors ``node, vec`` from the factorised mutual information of nodes that walks meet together.

    Nothing is held on the driver and no task has the vocabulary: counts are an aggregate, and the factors are found by
    alternating least squares over blocks of nodes, where a pair's information is how sure it is that they belong together and
    pairs that never met count as apart. Node numbers are whole numbers of 32 bits, so two thousand million nodes are the end.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    numbers = durable(hash_positions(nodes_of(edges), [], ["node"], seed, "_pos").select("node", (F.col("_pos") - 1).cast("int").alias("id")))
    # Numbers in place of names, and each pair once: what is counted, kept and joined is as narrow as it can be.
    if p == q == 1.0:
        numbered = numbered_walks(edges, numbers, length, walks, seed)
    else:
        paths = random_walks(edges, length, walks, seed, p, q)
        placed = paths.select("start", "walk", F.posexplode("path").alias("at", "node")).join(numbers, "node")
        numbered = placed.groupBy("start", "walk").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("at", "id"))), lambda e: e["id"]).alias("path"))
    rated = positive_information(meetings(numbered, window), once=True, totals=meeting_totals(numbered, window)).select(
        F.col("a").alias("i"), F.col("b").alias("j"), F.col("weight").cast("float").alias("weight")).persist()
    try:
        both = rated.unionAll(rated.select(F.col("j").alias("i"), F.col("i").alias("j"), "weight"))
        # A node belongs with itself as surely as with its surest neighbour; else nodes that belong together would be told apart by it.
        own = both.groupBy("i").agg(F.max("weight").alias("weight")).select("i", F.col("i").alias("j"), "weight")
        return _factorised(both.unionAll(own), numbers, dimensions, max_iter, alpha, penalty, seed)
    finally:
        rated.unpersist()


def _factorised(rated: DataFrame, numbers: DataFrame, dimensions: int, max_iter: int, alpha: float, penalty: float, seed: int) -> DataFrame:
    fitted = ALS(rank=dimensions, maxIter=max_iter, implicitPrefs=True, alpha=alpha, regParam=penalty, userCol="i", itemCol="j",
                 ratingCol="weight", seed=seed, checkpointInterval=5).fit(rated)
    found = fitted.userFactors.select("id", F.col("features").cast("array<double>").alias("vec"))
    zero = F.array(*[F.lit(0.0)] * dimensions)  # a node that never met another one
    return numbers.join(found, "id", "left").select("node", F.coalesce("vec", zero).alias("vec"))


def cluster_nodes(vectors: DataFrame, k: int = 6, seed: int = 0) -> DataFrame:
    """``node, cluster`` by k-means on the node vectors."""
    points = vectors.select("node", array_to_vector("vec").alias("features"))
    return KMeans(k=k, seed=seed).fit(points).transform(points).select("node", F.col("prediction").alias("cluster"))


# --- hyperbolic embedding -------------------------------------------------------------------------------------------

BALL = 1.0 - 1e-5


# The formulas are written as SQL text: one expression per output column instead of a call per arithmetic operator.

def _dot(a: str, b: str, size: int) -> str:
    return "(" + " + ".join(f"{a}{i} * {b}{i}" for i in range(size)) + ")"


def _cols(prefix: str, size: int) -> list[Column]:
    return [F.col(f"{prefix}{i}") for i in range(size)]


def _with_moments(df: DataFrame, size: int) -> DataFrame:
    """Add what the distance of the points u and v and its gradients share; ``_e`` is exp(-distance)."""
    gap = " + ".join(f"(u{i} - v{i}) * (u{i} - v{i})" for i in range(size))
    df = df.selectExpr("*", f"1 - {_dot('u', 'u', size)} AS _aa", f"1 - {_dot('v', 'v', size)} AS _bb",
                       f"{_dot('u', 'v', size)} AS _ab", f"({gap}) AS _gap")
    df = df.selectExpr("*", "greatest(1 + 2 * _gap / (_aa * _bb), 1.0D) AS _gamma")
    return df.selectExpr("*", "exp(-acosh(_gamma)) AS _e")


def _distance_gradient(x: str, y: str, alpha: str, beta: str, size: int) -> list[str]:
    """Euclidean gradient of the hyperbolic distance with respect to x, in closed form."""
    scale = f"4 / ({beta} * sqrt(greatest(_gamma * _gamma - 1, 1e-12D)))"
    along = f"(2 - {beta} - 2 * _ab) / ({alpha} * {alpha})"  # (|y|^2 - 2<x,y> + 1) / alpha^2
    return [f"{scale} * ({along} * {x}{i} - {y}{i} / {alpha})" for i in range(size)]


def poincare_embedding(
    edges: DataFrame, size: int = 2, epochs: int = 50, negative: int = 2, alpha: float = 0.1, seed: int = 0,
    burn_in: float = 0.1,
) -> DataFrame:
    """Hyperbolic coordinates ``node, vec`` in which connected nodes lie close.

    Each epoch is one batch: every edge meets ``negative`` seeded-hash samples that are not its neighbours, the softmax
    gradient of its distances is formed as columns, contributions are averaged per node (combined map-side, so a hub
    costs no more than another node) and the step is projected back into the ball. The share ``burn_in`` of the epochs
    goes at a tenth of the rate.
    """
    edges = pin_state(edges.select("src", "dst").distinct())
    nodes = hash_positions(nodes_of(edges), [], ["node"], seed, "_pos")
    start = [
        (F.pmod(F.xxhash64(F.lit(seed), F.lit(i), F.col("node")), F.lit(2001)) / 1_000_000.0 - 0.001).alias(f"x{i}")
        for i in range(size)
    ]
    points = pin_state(nodes.select("node", (F.col("_pos") - 1).alias("slot"), *start))
    n_nodes = points.count()
    near = pin_state(both_directions(edges))
    for epoch in range(epochs):
        rate = alpha / 10 if epoch < burn_in * epochs else alpha
        moved = _poincare_epoch(points, edges, near, n_nodes, size, negative, rate, seed, epoch)
        points = pin_state(moved, known_rows=n_nodes)
    return points.select("node", F.array(*_cols("x", size)).alias("vec"))


def _samples(edges: DataFrame, points: DataFrame, near: DataFrame, n_nodes: int, negative: int, salts: list
             ) -> DataFrame:
    """Rows ``src, dst, other, j``: the edge's own target (j=0) and its sampled non-neighbours."""
    slot = F.pmod(F.xxhash64(*map(F.lit, salts), F.col("src"), F.col("dst"), F.col("j")), F.lit(n_nodes))
    drawn = edges.withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(negative)))).withColumn("slot", slot)
    drawn = drawn.join(points.select("slot", F.col("node").alias("other")), "slot").where("other <> src")
    drawn = drawn.join(near.select("src", F.col("dst").alias("other")), ["src", "other"], "left_anti")
    return edges.select("src", "dst", F.col("dst").alias("other"), F.lit(0).alias("j")).unionByName(
        drawn.select("src", "dst", "other", "j")
    )


def _poincare_epoch(points, edges, near, n_nodes, size, negative, rate, seed, epoch) -> DataFrame:
    meets = _samples(edges, points, near, n_nodes, negative, [seed, epoch])
    u = points.select(F.col("node").alias("src"), *[F.col(f"x{i}").alias(f"u{i}") for i in range(size)])
    v = points.select(F.col("node").alias("other"), *[F.col(f"x{i}").alias(f"v{i}") for i in range(size)])
    placed = _with_moments(meets.join(u, "src").join(v, "other"), size)
    # At most 1 + negative rows share an edge, so this window is small whatever the degree of the nodes.
    total = F.sum("_e").over(Window.partitionBy("src", "dst"))
    # d loss / d distance: 1 - softmax for the true target, -softmax for a sample.
    pulled = placed.withColumn("_pull", F.when(F.col("j") == 0, 1.0).otherwise(0.0) - F.col("_e") / total)

    def contribution(node: str, grad: list[str]) -> str:
        parts = ", ".join(f"'g{i}', _pull * ({g})" for i, g in enumerate(grad))
        return f"named_struct('node', {node}, {parts})"

    at_u = contribution("src", _distance_gradient("u", "v", "_aa", "_bb", size))
    at_v = contribution("other", _distance_gradient("v", "u", "_bb", "_aa", size))
    parts = pulled.selectExpr(f"explode(array({at_u}, {at_v})) AS c")
    # Points and contributions meet in one aggregate instead of a join: a node's own row carries its place, the
    # contribution rows its gradient.
    here = points.select("node", "slot", *_cols("x", size), *[F.lit(None).cast("double").alias(f"g{i}") for i in range(size)])
    pulls = parts.select("c.node", F.lit(None).cast("bigint").alias("slot"),
                         *[F.lit(None).cast("double").alias(f"x{i}") for i in range(size)],
                         *[F.col(f"c.g{i}").alias(f"g{i}") for i in range(size)])
    met = here.unionByName(pulls).groupBy("node").agg(
        F.max("slot").alias("slot"), *[F.max(f"x{i}").alias(f"x{i}") for i in range(size)],
        *[F.coalesce(F.avg(f"g{i}"), F.lit(0.0)).alias(f"g{i}") for i in range(size)],
    )
    lift = f"pow(1 - {_dot('x', 'x', size)}, 2) / 4"
    moved = met.selectExpr("node", "slot", *[f"x{i} - {rate}D * {lift} * g{i} AS y{i}" for i in range(size)])
    norm = f"sqrt({_dot('y', 'y', size)})"
    inside = f"CASE WHEN {norm} >= {BALL}D THEN {BALL}D / {norm} ELSE 1.0D END"
    return moved.selectExpr("node", "slot", *[f"y{i} * {inside} AS x{i}" for i in range(size)])


def poincare_loss(vectors: DataFrame, edges: DataFrame, negative: int = 5, seed: int = 1) -> DataFrame:
    """Mean softmax loss of the edges against fresh samples, for watching the fit."""
    size = len(vectors.first()["vec"])
    points = hash_positions(vectors, [], ["node"], seed, "_pos").select(
        "node", (F.col("_pos") - 1).alias("slot"), *[F.col("vec")[i].alias(f"x{i}") for i in range(size)]
    )
    meets = _samples(edges, points, both_directions(edges), vectors.count(), negative, ["loss", seed])
    u = points.select(F.col("node").alias("src"), *[F.col(f"x{i}").alias(f"u{i}") for i in range(size)])
    v = points.select(F.col("node").alias("other"), *[F.col(f"x{i}").alias(f"v{i}") for i in range(size)])
    per_edge = _with_moments(meets.join(u, "src").join(v, "other"), size).groupBy("src", "dst").agg(
        (F.max(F.when(F.col("j") == 0, F.col("_e"))) / F.sum("_e")).alias("share")
    )
    return per_edge.agg(F.avg(-F.log("share")).alias("loss"))


# --- attaching node features to rows --------------------------------------------------------------------------------

class AttachEmbedding(TableModel):
    """G4/J9 as a stage: the coordinates of each row's item, one column per dimension.

    ``handleInvalid='error'`` raises on an item without a vector, ``'keep'`` gives zeros.
    """

    inputCol = Param(Params._dummy(), "inputCol", "item column", TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "prefix of the coordinate columns", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "dimensions", TypeConverters.toInt)
    handleInvalid = Param(Params._dummy(), "handleInvalid", "'error' or 'keep'", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="encoder", prefix="f_item_dim", size=2, handleInvalid="error"):
        super().__init__()
        self._setDefault(inputCol="encoder", prefix="f_item_dim", size=2, handleInvalid="error")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, vectors: DataFrame, item: str, size: int, prefix: str = "f_item_dim", handle_invalid: str = "error"):
        table = pin_state(vectors.select(F.col("node").cast("string").alias("node"), "vec"))
        return cls(inputCol=item, prefix=prefix, size=size, handleInvalid=handle_invalid).with_tables(vectors=table)

    def _transform(self, dataset):
        item = self.getOrDefault("inputCol")
        side = self.tables["vectors"].select(F.col("node").alias("_node"), F.col("vec").alias("_vec"))
        out = dataset.join(side, F.col(item).cast("string") == F.col("_node"), "left")
        if self.getOrDefault("handleInvalid") == "error":
            message = F.concat(F.lit("no vector for item "), F.coalesce(F.col(item).cast("string"), F.lit("null")))
            missing = F.raise_error(message).cast("double")
        else:
            missing = F.lit(0.0)
        prefix = self.getOrDefault("prefix")
        cells = {
            f"{prefix}{i + 1}": F.when(F.col("_vec").isNotNull(), F.col("_vec")[i]).otherwise(missing)
            for i in range(self.getOrDefault("size"))
        }
        return out.withColumns(cells).drop("_node", "_vec")
