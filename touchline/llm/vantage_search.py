"""Nearest neighbours by inner product with a vantage-point tree per shard.

One more component, sqrt(M² - |x|²) with M the largest length of all vectors, puts every vector on a sphere; queries get
0 there. Then a larger inner product is a smaller Euclidean distance, and the triangle inequality holds.

A top tree, fitted on a bounded sample, deals all vectors into cells; a cell is cut into shards of a fixed number of
rows, so that no number of copies makes a shard large. A task gets one shard and one block of queries, builds the
shard's vantage-point tree and searches it for all queries of the block side by side. A query first searches its own
cell; its k-th distance there bounds which other cells it has to visit and what it looks at in them.

The far side of a node is skipped if ``factor`` times the distance to the border between the sides is more than the
query's k-th distance so far. With factor 1 that is the triangle inequality and the search is exact; a larger factor
skips more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.rows import small_batches
from touchline.session import cut_lineage

K = 20
FACTOR = 1.25
SAMPLE = 4096  # vectors the top tree is fitted on, at most; fewer where vectors are long
NUMBERS = 1 << 19  # components of a shard or of a block of queries, at most (one row at least)
LEAF = 64  # vectors of a leaf
CHUNK = 128  # vectors compared at once; leaves of equal vectors may be larger

_FOUND = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_FOUND_SQL = "query BIGINT, vec_id BIGINT, score DOUBLE"


def _matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled with 0."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = np.asarray(vectors.flatten(), dtype=np.float64)
    sizes = np.asarray(vectors.value_lengths(), dtype=np.int64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _on_sphere(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the component that makes all of them ``longest`` long."""
    rest = np.maximum(longest * longest - np.einsum("nd,nd->n", vectors, vectors), 0)
    return np.hstack([vectors, np.sqrt(rest)[:, None]])


def _distance(squares: np.ndarray | float, products: np.ndarray, square: float) -> np.ndarray:
    return np.sqrt(np.maximum(squares + square - 2 * products, 0))


class Tree:
    """A vantage-point tree over points of one length.

    A node is (vantage point, border, inner, outer): points of the inner side are at most ``border`` away from the
    vantage point, those of the outer side at least. A leaf is the array of its points' numbers.
    """

    def __init__(self, points: np.ndarray, longest: float, leaf: int):
        self.points, self.square, self.leaf = points, longest * longest, leaf
        self.root = self._node(np.arange(len(points)))

    def _from(self, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        return _distance(self.square, self.points[rows] @ point, self.square)

    def _node(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        vantage = self.points[rows[np.argmax(self._from(rows, self.points[rows[0]]))]]
        away = self._from(rows, vantage)
        border = np.partition(away, len(away) // 2)[len(away) // 2]
        inner = away <= border
        if inner.all():
            inner = away < border
        if not inner.any():
            return rows
        return vantage, float(border), self._node(rows[inner]), self._node(rows[~inner])

    def cells(self) -> int:
        """Number the leaves in place: each becomes its number. Returns how many there are."""
        count = 0

        def number(node):
            nonlocal count
            if isinstance(node, tuple):
                return *node[:2], number(node[2]), number(node[3])
            count += 1
            return count - 1

        self.root = number(self.root)
        return count


def _home(root, points: np.ndarray, squares: np.ndarray, square: float) -> np.ndarray:
    """The cell each point is dealt into."""
    cell = np.zeros(len(points), np.int32)

    def walk(node, rows):
        if not isinstance(node, tuple):
            cell[rows] = node
            return
        vantage, border, inner, outer = node
        near = _distance(squares[rows], points[rows] @ vantage, square) <= border
        for side, some in ((inner, rows[near]), (outer, rows[~near])):
            if len(some):
                walk(side, some)

    walk(root, np.arange(len(points)))
    return cell


class Queries:
    """A block of queries and the best rows each has found so far."""

    def __init__(self, vectors: np.ndarray, numbers: np.ndarray, least: np.ndarray, longest: float, k: int, factor: float):
        self.vectors, self.numbers, self.longest, self.k, self.factor = vectors, numbers, longest, k, factor
        self.squares = np.einsum("nd,nd->n", vectors, vectors)
        self.points = np.hstack([vectors, np.zeros((len(vectors), 1))])
        # Rounding of a product of two vectors, and of a distance made from one.
        self.blur = 4e-16 * (vectors.shape[1] + 4) * np.sqrt(self.squares) * longest
        self.slack = 1e-6 * longest
        self.least = least
        self.scores = np.full((len(vectors), k), -np.inf)
        self.ids = np.zeros((len(vectors), k), np.int64)
        self.unknown = np.zeros((len(vectors), k), bool)

    def kth(self, who: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[who, -1], self.least[who])

    def reached(self, who: np.ndarray, gap: np.ndarray) -> np.ndarray:
        """Who has to look at points that lie at least ``gap`` away."""
        bound = _distance(self.squares[who], self.kth(who), self.longest**2)
        return self.factor * gap <= bound + self.slack

    def cells(self, node, who: np.ndarray, out: list[list[int]]) -> None:
        """Add the cells below a node of the top tree that each query has to visit."""
        if not isinstance(node, tuple):
            for i in who.tolist():
                out[i].append(node)
            return
        vantage, border, inner, outer = node
        away = _distance(self.squares[who], self.points[who] @ vantage, self.longest**2)
        for side, gap in ((inner, away - border), (outer, border - away)):
            some = who[self.reached(who, np.maximum(gap, 0))]
            if len(some):
                self.cells(side, some, out)

    def search(self, tree: Tree, shard: "Shard") -> None:
        def visit(node, who):
            if not len(who):
                return
            if not isinstance(node, tuple):
                for start in range(0, len(node), CHUNK):
                    self.compare(who, node[start : start + CHUNK], shard)
                return
            vantage, border, inner, outer = node
            away = _distance(self.squares[who], self.points[who] @ vantage, self.longest**2)
            inside = away <= border
            visit(inner, who[inside])
            visit(outer, who[~inside])
            far = self.reached(who, np.abs(away - border))
            visit(outer, who[inside & far])
            visit(inner, who[~inside & far])

        visit(tree.root, np.arange(len(self.vectors)))

    def compare(self, who: np.ndarray, rows: np.ndarray, shard: "Shard") -> None:
        """Take the given rows of a shard among the best of some queries where they belong."""
        likely = self.vectors[who] @ shard.vectors[rows].T >= (self.kth(who) - self.blur[who])[:, None]
        query, row = np.nonzero(likely & (shard.numbers[rows][None, :] != self.numbers[who][:, None]))
        if not len(query):
            return
        query, row = who[query], rows[row]
        # Summed component by component: equal vectors get equal scores wherever they are compared.
        score = np.zeros(len(query))
        for i in range(self.vectors.shape[1]):
            score += self.vectors[query, i] * shard.vectors[row, i]
        kept = score >= self.kth(query)
        query, row, score = query[kept], row[kept], score[kept]
        touched = np.unique(query)
        owner = np.concatenate([query, np.repeat(touched, self.k)])
        scores = np.concatenate([score, self.scores[touched].ravel()])
        ids = np.concatenate([shard.ids[row], self.ids[touched].ravel()])
        unknown = np.concatenate([shard.unknown[row], self.unknown[touched].ravel()])
        order = np.lexsort((ids, unknown, -scores, owner))
        starts = np.searchsorted(owner[order], touched)
        best = order[starts[:, None] + np.arange(self.k)]
        self.scores[touched], self.ids[touched], self.unknown[touched] = scores[best], ids[best], unknown[best]

    def found(self) -> pa.Table:
        query, place = np.nonzero(np.isfinite(self.scores))
        return pa.Table.from_arrays(
            [
                pa.array(self.numbers[query]),
                pa.array(self.ids[query, place], mask=self.unknown[query, place]),
                pa.array(self.scores[query, place]),
            ],
            schema=_FOUND,
        )


class Shard:
    def __init__(self, rows: pa.Table, width: int):
        self.vectors = _matrix(rows["vector"], width)
        self.numbers = rows["row"].to_numpy()
        self.unknown = np.asarray(rows["vec_id"].is_null())
        self.ids = rows["vec_id"].fill_null(0).to_numpy()


def usable(vector: Column) -> Column:
    """Whether a vector is known, not zero, and all its components are known and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    factor: float = FACTOR,
    numbers: int = NUMBERS,
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row of ``vectors`` that is a query.

    ``vectors`` holds vec_id and embedding; nearness is the inner product in doubles, summed in the order of the
    components, and equal scores go by vec_id, NULL ids last. Every row but the query's own is a candidate, also rows
    with the same id or vector. Vectors that aren't :func:`usable` take no part; of two vectors, the shorter one counts
    as filled with 0. Other columns are ignored; an empty table gives no rows.

    The top tree is fitted on at most ``sample`` rows, those with the smallest hash of their id and vector.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    known = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.monotonically_increasing_id().alias("row"),
    ).where(usable(F.col("vector")))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    n, n_queries, width, longest = known.agg(
        F.count(F.lit(1)), F.count_if("is_query"), F.max(F.size("vector")), F.sqrt(F.max(square))
    ).first()
    width, longest = width or 1, longest or 0.0
    height = max(1, numbers // width)  # rows of a shard, or of a block of queries
    n_blocks = max(1, -(-n_queries // height))
    drawn = known.orderBy(F.xxhash64("vec_id", "vector"), "row").limit(max(1, min(sample, 8 * numbers // width)))
    fitted = _matrix(drawn.select("vector").toArrow()["vector"], width)
    cells = max(1, min(n // height, len(fitted) // 16))
    top = Tree(_on_sphere(fitted, longest), longest, max(1, -(-len(fitted) // cells)))
    cells = top.cells()
    root = top.root

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _on_sphere(_matrix(batch["vector"], width), longest)
            home = _home(root, points, np.full(len(points), longest**2), longest**2)
            yield batch.append_column("cell", pa.array(home))

    kind = vectors.schema["embedding"].dataType.simpleString()
    schema = f"vec_id BIGINT, vector {kind}, is_query BOOLEAN, row BIGINT, cell INT"
    rows = cut_lineage(known.mapInArrow(deal, schema))
    sizes = dict(rows.groupBy("cell").count().collect())  # a row per cell, and cells are bounded
    shards = F.get(F.array(*[F.lit(max(1, -(-sizes.get(cell, 0) // height))) for cell in range(cells)]), F.col("cell"))
    dealt = rows.select("vec_id", "vector", "row", "cell", F.pmod(F.xxhash64("row"), shards).alias("shard"))
    queries = rows.where("is_query").select(
        F.col("row").alias("query"),
        F.col("vector").alias("asked"),
        F.col("cell").alias("at"),
        F.pmod(F.xxhash64("row"), F.lit(n_blocks)).alias("block"),
    )

    def search(routed: DataFrame) -> DataFrame:
        """The best rows of each shard of the cells the queries are routed to; at most k rows a query and shard."""
        tiles = routed.select(F.col("cell").alias("_cell"), "block").distinct()
        left = dealt.join(tiles, F.col("cell") == F.col("_cell")).drop("_cell")
        right = routed.select(
            "query", "asked", "least", F.col("cell").alias("_cell"), F.col("block").alias("_block"),
            F.explode(F.sequence(F.lit(0).cast("long"), (shards - 1).cast("long"))).alias("_shard"),
        )

        def run(some: pa.Table, asking: pa.Table) -> pa.Table:
            if not some.num_rows or not asking.num_rows:
                return _FOUND.empty_table()
            shard = Shard(some, width)
            block = Queries(
                _matrix(asking["asked"], width), asking["query"].to_numpy(), asking["least"].to_numpy(), longest, k, factor
            )
            block.search(Tree(_on_sphere(shard.vectors, longest), longest, LEAF), shard)
            return block.found()

        return (
            left.groupBy("cell", "shard", "block")
            .cogroup(right.groupBy("_cell", "_shard", "_block"))
            .applyInArrow(run, _FOUND_SQL)
        )

    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    nothing = F.lit(float("-inf")).alias("least")
    first = cut_lineage(best(search(queries.select("query", "asked", "block", F.col("at").alias("cell"), nothing))))
    kth = first.where(F.col("rank") == k).select(F.col("query").alias("_query"), F.col("score").alias("least"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                block = Queries(
                    _matrix(batch["asked"], width), batch["query"].to_numpy(), batch["least"].to_numpy(), longest, k, factor
                )
                out = [[] for _ in range(batch.num_rows)]
                block.cells(root, np.arange(batch.num_rows), out)
                yield batch.append_column("cells", pa.array(out, pa.list_(pa.int32())))

    bounded = queries.join(kth, F.col("query") == F.col("_query"), "left").select(
        "query", "asked", "at", "block", F.coalesce("least", nothing).alias("least")
    )
    routed = bounded.mapInArrow(
        route, f"query BIGINT, asked {kind}, at INT, block BIGINT, least DOUBLE, cells ARRAY<INT>"
    ).select("query", "asked", "at", "block", "least", F.explode("cells").alias("cell"))
    others = cut_lineage(routed.where(F.col("cell") != F.col("at")).drop("at"))
    ranked = best(first.drop("rank").unionByName(search(others)))
    names = rows.where("is_query").select(F.col("row").alias("_query"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, F.col("query") == F.col("_query")).select("query_id", "rank", "vec_id", "score")
