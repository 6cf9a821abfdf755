"""Near-duplicate embeddings by lattice hashing.

A table projects the unit vector on ``lattices`` x 8 random normal directions, scales it and
decodes each eight numbers to the nearest point of the E8 lattice; the points together are
the vector's home cell. It also visits the ``probes`` cells that are next nearest, each a
step to one of the 240 shortest lattice vectors in some of the points. Two vectors are
candidates where one's home is a cell that the other lives in or visits, in any table.

Groups of near copies are not paired off. Equal vectors are one representative with a weight.
A few rounds of leaders (the first representative of a home cell) then gather balls: all
members lie within half the threshold's angle of their leader, so they link with each other
for certain. Candidates are pairs of balls. The angle between two leaders, less and plus the
radii, decides most of them; then each member's angle to the other leader; what is left is
compared member by member in blocks of bounded size, which return counts and no pairs. Each
link that is counted was decided by its cosine in double precision or by the triangle
inequality of angles with a margin far above rounding.

Skew: cells, and the blocks of members, are split by hash beyond ``CELL_ROWS`` rows, every part
of a cell meeting every other, so no task holds a whole hot cell and no link is lost. Shuffled
rows carry the vector as one byte a component with its exact rounding error, which only ever
admits more candidates. Components come from links of balls, since members link to leaders.

Edge cases: a vector that is null, empty, all zeros or holds a null, NaN or infinite component
links with nothing and is its own component; vectors of different lengths never link; each
row is a vector of its own, so repeated rows link; a null id takes part but is a component's
id only if no member has another, and is not kept; an empty table gives an empty result;
columns besides the two named are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.llm.common import small_batches, stable
from changelake.llm.neighbours import usable
from changelake.llm.simhash import components

THRESHOLD = 0.9
TABLES = 10
LATTICES = 2
PROBES = 7
SCALE = 0.5
#: Rounds of leaders that gather balls.
ROUNDS = 3
#: Rows of a cell, and of a block of members, that one task compares at once.
CELL_ROWS = 4_096
#: Lattice neighbours of one point that combined probes are made of.
STEPS = 8
MARGIN = 1e-9


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = [np.bincount([i, j], [a, b], 8) for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    half = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + half)


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: of D8 (integers of even sum) or D8 plus one half."""
    def nearest_d8(y):
        near = np.rint(y)
        gap = y - near
        worst = np.abs(gap).argmax(axis=1)
        odd = np.flatnonzero(near.sum(axis=1) % 2)
        near[odd, worst[odd]] += np.where(gap[odd, worst[odd]] >= 0, 1, -1)
        return near
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def cells(units: np.ndarray, tables: int = TABLES, lattices: int = LATTICES, probes: int = PROBES,
          scale: float = SCALE, seed: int = 11) -> np.ndarray:
    """Cell keys of unit vectors, shape (rows, tables, 1 + probes), the home first. A key is a
    64-bit hash of the table, the vectors' length and the lattice points."""
    rng = np.random.default_rng([seed, units.shape[1]])
    steps, n = shortest_vectors(), len(units)
    keys = np.empty((n, tables, 1 + probes), np.uint64)
    for t in range(tables):
        x = (units @ rng.normal(size=(units.shape[1], 8 * lattices)) * scale).reshape(n * lattices, 8)
        salt = rng.integers(0, 2 ** 64, (lattices, 8), np.uint64) | np.uint64(1)
        start = rng.integers(0, 2 ** 64, dtype=np.uint64)
        home = decode(x)
        dearer = 2 - 2 * (x - home) @ steps.T           # squared distance added by each step
        first = np.argpartition(dearer, STEPS, axis=1)[:, :STEPS]
        rows = np.arange(len(x))[:, None]
        cost = np.concatenate([np.zeros((len(x), 1)), dearer[rows, first]], axis=1).reshape(n, lattices, STEPS + 1)
        moved = np.concatenate([home[:, None], home[:, None] + steps[first]], axis=1).reshape(n, lattices, STEPS + 1, 8)
        hashed = ((2 * moved).astype(np.int64).view(np.uint64) * salt[None, :, None, :]).sum(axis=3, dtype=np.uint64)
        total, mixed = cost[:, 0], hashed[:, 0]
        for k in range(1, lattices):
            total = (total[:, :, None] + cost[:, k][:, None, :]).reshape(n, -1)
            mixed = (mixed[:, :, None] + hashed[:, k][:, None, :]).reshape(n, -1)
        total[:, 0] = -1                                # the home cell is always the first
        best = np.argsort(total, axis=1, kind="stable")[:, :1 + probes]
        keys[:, t, :best.shape[1]] = _spread(mixed[np.arange(n)[:, None], best] + start)
        keys[:, t, best.shape[1]:] = keys[:, t, :1]
    return keys


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _matrices(column: pa.Array):
    """(rows, matrix) for each length of vector among the rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes, flat = column.value_lengths().to_numpy(), column.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[starts[rows][:, None] + np.arange(size)].astype(np.float64)


def _units(matrix: np.ndarray) -> np.ndarray:
    wide = matrix / np.abs(matrix).max(axis=1, keepdims=True)     # no overflow, no underflow
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def cell_keys(tables: int, lattices: int, probes: int, scale: float):
    """Column function: vector -> its keys, table by table."""

    @F.arrow_udf("array<bigint>")
    def keys(vectors: pa.Array) -> pa.Array:
        out = np.empty((len(vectors), tables * (1 + probes)), np.int64)
        for rows, matrix in _matrices(vectors):
            for a in range(0, len(rows), 1000):
                part = rows[a:a + 1000]
                found = cells(_units(matrix[a:a + 1000]), tables, lattices, probes, scale)
                out[part] = found.reshape(len(part), -1).view(np.int64)
        return pa.FixedSizeListArray.from_arrays(out.ravel(), out.shape[1]).cast(pa.list_(pa.int64()))

    return keys


@F.arrow_udf(T.DoubleType())
def cosine(left: pa.Array, right: pa.Array) -> pa.Array:
    """Cosine of two vectors of one length, in double precision."""
    out = np.full(len(left), np.nan)
    for (rows, a), (_, b) in zip(_matrices(left), _matrices(right)):
        out[rows] = (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    return pa.array(out)


@F.arrow_udf(T.BinaryType())
def byte_vector(vectors: pa.Array) -> pa.Array:
    """The unit vector, a signed byte a component, after the norm of its rounding error."""
    out = [b""] * len(vectors)
    for rows, matrix in _matrices(vectors):
        units = _units(matrix)
        small = np.rint(units * 127).astype(np.int8)
        error = np.linalg.norm(units - small / 127.0, axis=1)
        for i, e, s in zip(rows.tolist(), error, small):
            out[i] = e.tobytes() + s.tobytes()
    return pa.array(out, pa.binary())


def _angle(cos: str | Column) -> Column:
    return F.acos(F.greatest(F.least(F.col(cos) if isinstance(cos, str) else cos, F.lit(1.0)), F.lit(-1.0)))


def _balls(reps: DataFrame, width: int, reach: float) -> DataFrame:
    """(rep, ball, turn): each representative's leader and the angle to it; its own leader at 0 if alone."""
    parts, rest = [], reps.select("rep", "v", "keys")
    for t in range(ROUNDS):
        # F.get: a row's home cell in this round's table.
        keyed = rest.withColumn("key", F.get("keys", F.lit(t * width)))
        leaders = keyed.groupBy("key").agg(F.min(F.struct("rep", "v")).alias("leader"), F.count(F.lit(1)).alias("n")) \
            .where("n > 1").select("key", F.col("leader.rep").alias("ball"), F.col("leader.v").alias("lv"))
        near = keyed.join(leaders, "key", "left").withColumn("cos", F.when(
            F.size("v") == F.size("lv"), cosine("v", F.when(F.size("v") == F.size("lv"), F.col("lv")).otherwise(F.col("v")))))
        near = stable(near.select("rep", "v", "keys", "ball", F.when(F.col("rep") == F.col("ball"), F.lit(0.0))
                                  .otherwise(_angle("cos")).alias("turn")))
        inside = near.where(F.col("turn") <= reach)
        shared = inside.groupBy("ball").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("ball").alias("taken"))
        joined = stable(near.join(shared, (near.ball == shared.taken) & (near.turn <= reach), "left"))
        parts.append(joined.where("taken IS NOT NULL").select("rep", "ball", "turn"))
        rest = joined.where("taken IS NULL").select("rep", "v", "keys")
    parts.append(rest.select("rep", F.col("rep").alias("ball"), F.lit(0.0).alias("turn")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _split(rows: DataFrame, left: Column, right: Column, limit: int, tag: str) -> DataFrame:
    """Rows dealt to blocks (i, j) of their group so that each left row (side 0) meets each right
    row (side 1) of it once. ``rows`` has n, the group's number of rows; ``tag`` is an id to deal by."""
    parts = F.ceil(F.col("n") / limit).cast("int")
    own = F.pmod(F.xxhash64(tag), parts.cast("bigint")).cast("int")
    every = F.sequence(F.lit(0), parts - 1)
    lefts = rows.where(left).withColumn("side", F.lit(0)).withColumn("i", own).withColumn("j", F.explode(every))
    rights = rows.where(right).withColumn("side", F.lit(1)).withColumn("j", own).withColumn("i", F.explode(every))
    return lefts.unionByName(rights)


def _near_in_cells(threshold: float):
    """Blocks of cells, sorted -> pairs of balls that may hold a link, by the byte vectors."""
    limit = math.acos(threshold)

    def compare(rows: pa.Table) -> pa.Table:
        """Whole blocks. Pairs of small blocks are gathered together, large ones multiplied."""
        group = rows["group"].to_numpy()
        side, ball, radius = (rows[c].to_numpy() for c in ("side", "ball", "radius"))
        raw = rows["bytes"].to_pylist()
        size = len(raw[0])
        both = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, size)
        error = np.ascontiguousarray(both[:, :8]).view(np.float64)[:, 0]
        small = np.ascontiguousarray(both[:, 8:]).view(np.int8).astype(np.float32)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        low, high = (np.searchsorted(group[right], group[left], s) for s in ("left", "right"))
        found = []

        def keep(p, q, dots):
            reach = np.minimum(limit + radius[p] + radius[q], np.pi)
            near = (dots / (127.0 * 127.0) >= np.cos(reach) - 1.1 * (error[p] + error[q] + 1e-4)) & (ball[p] != ball[q])
            found.append(np.stack([ball[p][near], ball[q][near]], axis=1))

        few = np.flatnonzero(high - low <= 64)
        ends = np.cumsum((high - low)[few])
        a = 0
        while a < len(few):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 50_000, "right")))
            own, n = few[a:b], (high - low)[few[a:b]]
            p = np.repeat(left[own], n)
            q = right[np.repeat(low[own] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            keep(p, q, np.einsum("ij,ij->i", small[p], small[q]))
            a = b
        many = np.flatnonzero(high - low > 64)
        for first in np.unique(low[many]):
            mine = many[low[many] == first]
            others = right[first:high[mine[0]]]
            for k in range(0, len(mine), 256):
                own = left[mine[k:k + 256]]
                p, q = np.repeat(own, len(others)), np.tile(others, len(own))
                keep(p, q, (small[own] @ small[others].T).ravel())
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0) if found else np.empty((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    def numbered(rows: pa.Table) -> pa.Table:
        marks = [rows[c].to_numpy() for c in ("key", "i", "j", "size")]
        new = np.concatenate([[False], np.logical_or.reduce([m[1:] != m[:-1] for m in marks])])
        return rows.append_column("group", pa.array(np.cumsum(new)))

    def near(batches):
        held: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            rows = held if batch is None else pa.Table.from_batches([batch]) if held is None \
                else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if rows is None or not rows.num_rows:
                continue
            rows = numbered(rows)
            # The last block may go on in the next batch.
            whole = rows.num_rows if batch is None else int(np.searchsorted(rows["group"].to_numpy(), rows["group"][-1].as_py()))
            held = rows.slice(whole).drop_columns(["group"])
            if whole:
                done, sizes = rows.slice(0, whole), rows["size"].to_numpy()[:whole]
                for size in np.unique(sizes):
                    yield from compare(done.filter(pa.array(sizes == size))).to_batches()

    return near


def _count_links(threshold: float):
    """A block of members of two balls -> links counted for each member, by exact cosines."""

    def count(table: pa.Table) -> pa.Table:
        side, rep, weight = (table[c].to_numpy() for c in ("side", "rep", "weight"))
        rows = [np.flatnonzero(side == s) for s in (0, 1)]
        tally, a, b = np.zeros(len(rep), np.int64), table["a"][0].as_py(), table["b"][0].as_py()
        if len(rows[0]) and len(rows[1]):
            size = len(table["v"][0])
            v = table["v"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, size)
            norm = np.sqrt((v * v).sum(axis=1))
            for k in range(0, len(rows[0]), 256):
                own = rows[0][k:k + 256]
                linked = v[own] @ v[rows[1]].T / (norm[own][:, None] * norm[rows[1]][None, :]) >= threshold
                tally[own] += linked @ weight[rows[1]]
                tally[rows[1]] += weight[own] @ linked
        some = np.flatnonzero(tally)
        return pa.table({"rep": pa.array(rep[some], pa.int64()), "links": pa.array(tally[some], pa.int64()),
                         "a": pa.array([a] * len(some), pa.int64()), "b": pa.array([b] * len(some), pa.int64())})

    return count


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, tables: int = TABLES, lattices: int = LATTICES,
                    probes: int = PROBES, scale: float = SCALE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per input row: ``id_col``, n_links, component_id, kept."""
    small_batches(vectors.sparkSession, 4000)
    limit, width = math.acos(threshold), 1 + probes
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), usable(vector_col).alias("ok"))
    kinds = rows.where("ok").groupBy("v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("weight"))
    reps = stable(kinds.withColumn("rep", F.monotonically_increasing_id())
                  .withColumn("keys", cell_keys(tables, lattices, probes, scale)("v")))
    home = _balls(reps, width, limit / 2 - 1e-3)
    members = stable(home.join(reps, "rep"))
    balls = stable(members.groupBy("ball").agg(F.max("turn").alias("radius"), F.sum("weight").alias("mass"),
                                               F.min("first").alias("first"), (F.count(F.lit(1)) > 1).alias("shared"))
                   .join(reps.select(F.col("rep").alias("ball"), "v"), "ball"))

    # Where balls live and which cells they visit; members of a ball share its rows.
    sketch = balls.select("ball", "radius", byte_vector("v").alias("bytes"))
    at = members.join(balls.where("shared").select("ball", "shared"), "ball", "left") \
        .select("ball", "shared", F.posexplode("keys").alias("pos", "key")).withColumn("home", F.col("pos") % width == 0)
    at = at.where("shared IS NULL").select("key", "ball", "home").unionByName(
        at.where("shared").groupBy("key", "ball").agg(F.max("home").alias("home")))
    sizes = at.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("lived")).where("n > 1 AND lived")
    met = at.join(sizes.select("key", "n"), "key").join(sketch, "ball")
    blocks = _split(met, F.col("home"), F.lit(True), cell_rows, "ball") \
        .select("key", "i", "j", F.octet_length("bytes").alias("size"), "side", "ball", "radius", "bytes")
    pairs = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "size", "side") \
        .mapInArrow(_near_in_cells(threshold), "a bigint, b bigint").distinct()

    # The leaders' exact angle settles most pairs; b is the ball with the smaller radius.
    one, two = (balls.select(F.col("ball").alias(x), F.col("radius").alias(f"r{x}"), F.col("mass").alias(f"m{x}"),
                             F.col("v").alias(f"v{x}")) for x in "ab")
    apart = pairs.join(one, "a").join(two, "b").withColumn("cos", cosine("va", "vb"))
    radii, gap = F.col("ra") + F.col("rb"), _angle("cos")
    exact = radii == 0
    sure = F.when(exact, F.col("cos") >= threshold).otherwise(gap + radii <= limit - MARGIN)
    never = F.when(exact, F.col("cos") < threshold).otherwise(gap - radii > limit + MARGIN)
    swap = F.col("ra") < F.col("rb")
    big, small = (F.when(swap, F.col(x)).otherwise(F.col(y)) for x, y in (("b", "a"), ("a", "b")))
    judged = stable(apart.where(~never).select(big.alias("a"), small.alias("b"), "ma", "mb", swap.alias("swap"), sure.alias("sure")))
    whole = judged.where("sure").select("a", "b", F.when(F.col("swap"), F.col("mb")).otherwise(F.col("ma")).alias("ma"),
                                        F.when(F.col("swap"), F.col("ma")).otherwise(F.col("mb")).alias("mb"))
    by_ball = whole.select(F.col("a").alias("ball"), F.col("mb").alias("links")) \
        .unionByName(whole.select(F.col("b").alias("ball"), F.col("ma").alias("links")))

    # Members of a against b's leader: all of b, none of it, or to be compared one by one.
    other = balls.select(F.col("ball").alias("b"), F.col("v").alias("vb"), F.col("radius").alias("rb"), F.col("mass").alias("mb"))
    single = judged.where("NOT sure").select("a", "b").join(members.withColumnRenamed("ball", "a"), "a").join(other, "b") \
        .withColumn("cos", cosine("v", "vb"))
    turn = _angle("cos")
    verdict = F.when(F.col("rb") == 0, F.when(F.col("cos") >= threshold, "all").otherwise("none")) \
        .when(turn + F.col("rb") <= limit - MARGIN, "all").when(turn - F.col("rb") > limit + MARGIN, "none").otherwise("some")
    single = stable(single.select("a", "b", "rep", "v", "weight", "mb", verdict.alias("verdict")).where("verdict <> 'none'"))
    all_of = single.where("verdict = 'all'")
    by_rep = all_of.select("rep", F.col("mb").alias("links"))
    by_ball = by_ball.unionByName(all_of.groupBy("a", "b").agg(F.sum("weight").alias("links")).select(F.col("b").alias("ball"), "links"))
    band = single.where("verdict = 'some'").select("a", "b", "rep", "v", "weight", F.lit(True).alias("asks"))
    inner = band.select("a", "b").distinct().join(members.withColumnRenamed("ball", "b"), "b") \
        .select("a", "b", "rep", "v", "weight", F.lit(False).alias("asks"))
    block = band.unionByName(inner)
    counts = block.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    counted = stable(_split(block.join(counts, ["a", "b"]), F.col("asks"), ~F.col("asks"), cell_rows, "rep")
                     .select("a", "b", "i", "j", "side", "rep", "v", "weight").groupBy("a", "b", "i", "j")
                     .applyInArrow(_count_links(threshold), "rep bigint, links bigint, a bigint, b bigint"))
    by_rep = by_rep.unionByName(counted.select("rep", "links"))

    edges = whole.select("a", "b").unionByName(all_of.select("a", "b")).unionByName(counted.select("a", "b")).distinct()
    roots = components(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    rooted = balls.select("ball", "mass", "first").join(roots.withColumnRenamed("node", "ball"), "ball", "left") \
        .withColumn("root", F.coalesce("root", "ball"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    from_ball = by_ball.groupBy("ball").agg(F.sum("links").alias("ball_links"))
    per_ball = rooted.join(smallest, "root").join(from_ball, "ball", "left") \
        .select("ball", "component", (F.col("mass") - 1 + F.coalesce("ball_links", F.lit(0))).alias("base"))
    per_rep = members.select("rep", "ball", "v").join(per_ball, "ball") \
        .join(by_rep.groupBy("rep").agg(F.sum("links").alias("own")), "rep", "left") \
        .select("v", (F.col("base") + F.coalesce("own", F.lit(0))).alias("links"), "component")
    linked = rows.where("ok").join(per_rep, "v").select("id", "links", "component") \
        .unionByName(rows.where("NOT ok").select("id", F.lit(0).cast("bigint").alias("links"), F.col("id").alias("component")))
    return linked.select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                         F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
