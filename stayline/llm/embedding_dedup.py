"""Near-duplicate vectors by product quantisation, reranked by their exact cosine.

Equal vectors count once, with their number. A bounded sample gives the centres of the
coarse lists and, from what is left after the nearest centre, codes for each part of
the dimensions. Every vector then gets its list, its codes and the length of the error
its codes leave.

Two unit vectors of cosine ``c`` are ``r = sqrt(2 - 2 c)`` apart, so a partner of ``x``
can lie in the list of another centre only if ``x`` is within ``r`` of the plane between
that centre and its own. In many dimensions ``r`` points along that one direction hardly
ever: seen from any fixed direction it has a deviation of ``r / sqrt(d)``, ``d`` the
dimensions that the sample really fills. Lists within ``PROBE`` deviations are probed;
``probe=None`` probes all within ``r``, which finds every pair. Inside a list nothing
more is lost: table look-ups give the distance from ``x`` to what a member's codes stand
for, and only if it exceeds ``r`` by more than the member's error the member is left out.
The rest are compared by exact cosine, in doubles.

Each pair is met once: a vector probes its own list and those of higher number. Lists
are cut into blocks of members and of probing vectors, and a task compares one block
with another. It returns one row for each linked vector: how many it met, and the
group it is in as far as the task can see. No pairs leave a task.

Defined results: vectors that are NULL, empty, all zero or hold NULL or non-finite
components link with nothing; vectors of different length do not link; repeated rows
are vectors of their own; a NULL ``vec_id`` keeps its row, and names a group only if no
row of it has an id (then ``component_id`` is NULL). ``kept`` compares NULL as a value.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import arrow_schema, written

SAMPLE_VALUES = 16_000_000  # numbers in the sample the centres and codes are fitted on, at most
SAMPLE_ROWS = 32_768  # and vectors, unless more lists need more
PER_LIST, MAX_LISTS = 256, 16_384
PARTS, CODES = 8, 256
BLOCK, PROBE_BLOCK = 1024, 4096  # members and probing vectors that a task compares
PROBE = 3.0  # deviations of a partner that probes allow for; README has the recall
SLACK = 1e-6  # added to bounds, for what rounding may take


class Codebook(NamedTuple):
    """Centres of the lists (lists, n), codes of the parts (parts, codes, width), and how
    many dimensions the vectors fill."""
    centres: object
    codes: object
    filled: float


def _nearest(points, centres):
    """Number of the nearest centre and squared distances, a slice at a time."""
    import numpy as np

    own = np.sum(centres * centres, axis=1)
    number = np.empty(len(points), dtype=np.int64)
    for a in range(0, len(points), 4096):
        part = points[a:a + 4096]
        number[a:a + 4096] = np.argmin(own - 2 * part @ centres.T, axis=1)
    return number


def _means(points, k: int, rounds: int):
    """k-means from evenly chosen points; an empty cluster keeps its centre."""
    import numpy as np

    centres = points[np.linspace(0, len(points) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        number = _nearest(points, centres)
        count = np.bincount(number, minlength=k)
        order = np.argsort(number, kind="stable")
        met = np.flatnonzero(count)
        start = (np.cumsum(count) - count)[met]
        centres[met] = np.add.reduceat(points[order], start) / count[met, None]
    return centres


def _split(points, parts: int):
    """The dimensions in ``parts`` runs, padded with zeros: (parts, rows, width)."""
    import numpy as np

    rows, n = points.shape
    width = -(-n // parts)
    padded = np.zeros((rows, parts * width))
    padded[:, :n] = points
    return padded.reshape(rows, parts, width).transpose(1, 0, 2)


def _table(column) -> object:
    """An Arrow column of equally long lists as rows of doubles."""
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(vectors):
    """Rows of length 1; huge and tiny values are scaled first."""
    import numpy as np

    rows = np.array(vectors, dtype=np.float64)
    rows /= np.max(np.abs(rows), axis=1, keepdims=True)
    return rows / np.sqrt(np.sum(rows * rows, axis=1, keepdims=True))


def fit(vectors: DataFrame, count: int, size: int, per_list: int = PER_LIST) -> Codebook:
    """Centres and codes from a sample of ``vector``; ``count`` vectors of ``size`` numbers.

    The sample is the first by a hash of the vector; it is bounded by ``SAMPLE_VALUES``,
    and a single task learns from it.
    """
    lists = max(1, min(count // per_list, MAX_LISTS, SAMPLE_VALUES // size // 16))
    n_rows = min(SAMPLE_VALUES // size + 1, max(SAMPLE_ROWS, 16 * lists))
    sample = vectors.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(n_rows)
    schema = "centres binary, codes binary, n_codes int, filled double"
    target = arrow_schema(schema)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        rows = [_table(b.column(0)) for b in batches if b.num_rows]
        if not rows:
            return
        points = _unit(np.concatenate(rows))
        # (sum of variances)^2 / sum of their squares, over the principal directions
        spread = np.cov(points, rowvar=False, bias=True).reshape(size, size)
        filled = np.trace(spread) ** 2 / max(np.sum(spread * spread), 1e-300)
        centres = _means(points, min(lists, len(points)), 8)
        rest = points - centres[_nearest(points, centres)]
        codes = np.stack([
            _means(np.ascontiguousarray(p), min(CODES, len(p)), 6) for p in _split(rest, PARTS)
        ])
        yield pa.RecordBatch.from_pylist([
            {"centres": centres.tobytes(), "codes": codes.tobytes(), "n_codes": codes.shape[1],
             "filled": float(max(filled, 1.0))}
        ], schema=target)

    import numpy as np

    row = sample.repartition(1).mapInArrow(learn, schema).first()
    return Codebook(
        np.frombuffer(row.centres).reshape(-1, size),
        np.frombuffer(row.codes).reshape(PARTS, row.n_codes, -1), row.filled,
    )


def assign(vectors: DataFrame, book: Codebook, reach: float) -> DataFrame:
    """``node, n, vector`` with ``list``, ``codes``, ``error`` and the lists to ``probe``:
    its own, and those of higher number whose planes are within ``reach``."""
    kind = vectors.schema["vector"].dataType.simpleString()
    schema = (
        f"node bigint, n bigint, vector {kind}, list int, codes binary, error double, "
        "probe array<int>"
    )
    target = arrow_schema(schema)
    shared = vectors.sparkSession.sparkContext.broadcast(book)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        centres, codes, _ = shared.value
        own = np.sum(centres * centres, axis=1)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                points = _unit(_table(part.column(2)))
                far = np.maximum(own - 2 * points @ centres.T + 1, 0)
                home = np.argmin(far, axis=1)
                best = far[np.arange(len(points)), home]
                # Within reach of the plane between both centres; the first test is cheap and wider.
                near = np.sqrt(far) <= np.sqrt(best)[:, None] + 2 * reach + SLACK
                row, other = np.nonzero(near & (np.arange(len(centres)) > home[:, None]))
                apart = np.sqrt(np.sum((centres[other] - centres[home[row]]) ** 2, axis=1))
                reached = far[row, other] - best[row] <= 2 * apart * reach + SLACK
                row, other = row[reached], other[reached]
                probes = [[int(h)] for h in home]
                for r, o in zip(row.tolist(), other.tolist(), strict=True):
                    probes[r].append(o)
                rest = points - centres[home]
                code = np.empty((len(points), len(codes)), dtype=np.uint8)
                left = np.zeros(len(points))
                for p, piece in enumerate(_split(rest, len(codes))):
                    code[:, p] = _nearest(piece, codes[p])
                    left += np.sum((piece - codes[p][code[:, p]]) ** 2, axis=1)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:3], pa.array(home, pa.int32()),
                    pa.array([c.tobytes() for c in code], pa.binary()), pa.array(np.sqrt(left)),
                    pa.array(probes, target.field("probe").type),
                ], schema=target)

    return vectors.select("node", "n", "vector").mapInArrow(work, schema)


def _groups(a, b, size: int):
    """Smallest place of each place's group under the links ``a``-``b``."""
    import numpy as np

    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for side in (a, b):
            np.minimum.at(new, side, low)
            np.minimum.at(new, root[side], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _compare(book: Codebook, list_no: int, members: dict, probing: dict, cosine: float, radius: float):
    """Places of linked pairs: members against probing vectors, those of one block once."""
    import numpy as np

    codes = members["codes"]
    centre = book.centres[list_no]
    found = []
    for start in range(0, len(probing["unit"]), 256):
        unit = probing["unit"][start:start + 256]
        square = np.zeros((len(unit), len(codes)))
        for p, piece in enumerate(_split(unit - centre, len(book.codes))):
            table = (
                np.sum(piece * piece, axis=1)[:, None] - 2 * piece @ book.codes[p].T
                + np.sum(book.codes[p] ** 2, axis=1)
            )
            square += table[:, codes[:, p]]
        close = np.sqrt(np.maximum(square, 0)) <= radius + members["error"] + SLACK
        close &= ~probing["inside"][start:start + 256, None] | (
            probing["node"][start:start + 256, None] < members["node"]
        )
        q, m = np.nonzero(close)
        for at in range(0, len(q), 65_536):
            a, b = q[at:at + 65_536], m[at:at + 65_536]
            exact = np.einsum("ij,ij->i", unit[a], members["unit"][b]) >= cosine
            found.append((a[exact] + start, b[exact]))
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([none, *side]) for side in zip(*found, strict=True)) if found else (none, none)


MET = "node bigint, links bigint, root bigint"


def _linked(book_of, cosine: float, radius: float):
    """One block of members against one of probing vectors: rows of ``MET``."""
    schema = arrow_schema(MET)

    def work(table: pa.Table) -> pa.Table:
        import numpy as np

        def side(rows: pa.Table) -> dict:
            return {
                "node": rows["node"].to_numpy(), "n": rows["n"].to_numpy(),
                "unit": _unit(_table(rows["vector"])),
                "inside": rows["inside"].to_numpy(),
            }

        is_member = table["member"].to_numpy()
        members, probing = table.filter(pa.array(is_member)), table.filter(pa.array(~is_member))
        if not len(members) or not len(probing):
            return schema.empty_table()
        m, q = side(members), side(probing)
        m["codes"] = np.frombuffer(
            b"".join(members["codes"].to_pylist()), dtype=np.uint8
        ).reshape(len(members), -1)
        m["error"] = members["error"].to_numpy()
        a, b = _compare(book_of.value, table["list"][0].as_py(), m, q, cosine, radius)
        # Both sides in one numbering by node, as a vector may be on both.
        nodes, place = np.unique(np.concatenate([q["node"], m["node"]]), return_inverse=True)
        weight = np.zeros(len(nodes), dtype=np.int64)
        weight[place] = np.concatenate([q["n"], m["n"]])
        left, right = place[a], place[b + len(q["node"])]
        links = np.zeros(len(nodes), dtype=np.int64)
        np.add.at(links, left, weight[right])
        np.add.at(links, right, weight[left])
        root = _groups(left, right, len(nodes))
        met = np.flatnonzero(links)
        return pa.Table.from_arrays(
            [pa.array(nodes[met]), pa.array(links[met]), pa.array(nodes[root[met]])], schema=schema
        )

    return work


def links(
    vectors: DataFrame, size: int, count: int, cosine: float, probe: float | None = PROBE
) -> DataFrame:
    """``node, links, root`` of vectors of one size: numbers of vectors met, and links
    ``node``-``root`` that connect the same groups as all pairs."""
    radius = (2 - 2 * cosine) ** 0.5
    book = fit(vectors, count, size)
    reach = radius if probe is None else radius * min(1.0, probe / book.filled ** 0.5)
    placed = written(assign(vectors, book, reach), "placed")
    # As many rows as there are lists: at most MAX_LISTS.
    sizes = F.broadcast(
        placed.select("list", F.explode("probe").alias("to")).groupBy("to").agg(
            F.count("*").alias("probing"), F.sum((F.col("to") == F.col("list")).cast("int")).alias("members")
        )
        .select(
            F.col("to").alias("list"),
            F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("probing") / PROBE_BLOCK).cast("int").alias("probe_blocks"),
        )
    )
    hashed = F.xxhash64("node")
    own = placed.join(sizes, "list").withColumn("block", F.pmod(hashed, "blocks").cast("int"))
    members = own.select(
        "list", "block",
        F.explode(F.sequence(F.lit(0), F.col("probe_blocks") - 1)).alias("probe_block"),
        F.lit(True).alias("member"), F.lit(False).alias("inside"), "node", "n", "vector", "codes",
        "error",
    )
    to = own.select("node", "n", "vector", F.col("list").alias("home"), "block", F.explode("probe").alias("list"))
    mine = F.col("home") == F.col("list")
    probing = to.withColumnRenamed("block", "home_block").join(sizes, "list").where("blocks > 0").select(
        "list",
        F.explode(F.sequence(
            F.when(mine, F.col("home_block")).otherwise(0), F.col("blocks") - 1
        )).alias("block"),
        F.pmod(F.xxhash64("node", F.lit(1)), "probe_blocks").cast("int").alias("probe_block"),
        F.lit(False).alias("member"), mine.alias("is_home"), "home_block", "node", "n", "vector",
    ).select(
        "list", "block", "probe_block", "member",
        (F.col("is_home") & (F.col("home_block") == F.col("block"))).alias("inside"),
        "node", "n", "vector", F.lit(None).cast("binary").alias("codes"),
        F.lit(None).cast("double").alias("error"),
    )
    shared = vectors.sparkSession.sparkContext.broadcast(book)
    return members.unionByName(probing).groupBy("list", "block", "probe_block").applyInArrow(
        _linked(shared, cosine, radius), MET
    )


def near_duplicates(
    embeddings: DataFrame, cosine: float = 0.95, probe: float | None = PROBE
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = embeddings.select("vec_id", F.col("embedding").alias("vector"))
    number = F.col("vector")
    sound = F.coalesce(
        (F.size(number) > 0)
        & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(number, lambda x: x != 0), F.lit(False),
    )
    distinct = written(
        rows.where(sound).groupBy("vector")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    sizes = distinct.groupBy(F.size("vector").alias("size")).count().collect()  # one for each length
    none = embeddings.sparkSession.createDataFrame([], MET)
    met = written(reduce(DataFrame.union, [
        links(distinct.where(F.size("vector") == row["size"]), row["size"], row["count"], cosine, probe)
        for row in sizes
    ], none), "vector-links")
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(met.selectExpr("node AS a", "root AS b"))
    member = written(
        distinct.join(counts, "node", "left").join(groups, "node", "left").select(
            "vector", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        ), "vector-groups",
    )
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = member.join(named, "root").select("vector", "n_links", "component_id")
    linked = rows.where(sound).join(facts, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where(~sound).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
