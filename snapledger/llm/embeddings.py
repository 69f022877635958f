"""Near duplicates among embeddings by lattice hashing, confirmed by cosine.

A table projects each unit vector at random onto HALVES * 8 dimensions and decodes each eight to the nearest point of the
lattice E8; the points together are the vector's cell. A vector is entered under its own cell and under the PROBES - 1
neighbouring cells (one eight moved by a minimal lattice vector) that lie nearest to it. Two vectors meet in a table where one
enters the other's own cell. At cosine 0.95, the hardest, that is 0.28 of all tables, so TABLES of them miss 1 link in 100.

Only keys under which several vectors stand go further. Under a key, cosines are taken as matrix products of blocks of bounded
size; links are counted, not listed. A pair counts in the first table where it meets and under one key there, and a block
passes on each vector's count and the smallest vector that links within the block reach.
"""

from __future__ import annotations

import hashlib
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import mix
from snapledger.llm.graph import components
from snapledger.llm.minhash import runs
from snapledger.llm.storage import stored

TABLES, HALVES, PROBES = 14, 2, 5
SCALE = 1.4
LEAST = 0.95
#: Rows of a block in the comparison under one key; a task holds two blocks at a time.
BLOCK = 512
#: Vectors hashed at once.
SLICE = 2048


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    found += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


MINIMAL = _minimal_vectors()


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    point = np.rint(x)
    off = x - point
    rows, worst = np.arange(len(x)), np.abs(off).argmax(axis=1)
    point[rows, worst] += np.where(point.sum(axis=1) % 2 != 0, np.where(off[rows, worst] >= 0, 1, -1), 0)
    return point


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row of 8 coordinates: an even point, or one of those shifted by a half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1))[:, None], whole, half)


def cell_keys(unit: np.ndarray) -> np.ndarray:
    """For unit vectors (rows) the keys they stand under, as vectors x TABLES x PROBES; the first is the own cell."""
    n, dim = unit.shape
    rng = np.random.default_rng(dim)
    out = np.empty((n, TABLES, PROBES), np.uint64)
    rows = np.arange(n)[:, None]
    for t in range(TABLES):
        place = (unit @ rng.standard_normal((dim, 8 * HALVES)) / SCALE).reshape(n * HALVES, 8)
        point = decode(place)
        gain = ((place - point) @ MINIMAL.T).reshape(n, HALVES * len(MINIMAL))
        # ties by the number of the move, so that a vector's keys are the same in any batch
        near = np.argsort(-np.round(gain, 9), axis=1, kind="stable")[:, :PROBES - 1]
        cells = np.repeat(np.rint(2 * point).astype(np.int64).reshape(n, 1, HALVES, 8), PROBES, axis=1)
        cells[rows, np.arange(1, PROBES)[None, :], near // len(MINIMAL)] += np.rint(2 * MINIMAL).astype(np.int64)[near % len(MINIMAL)]
        value = np.full((n, PROBES), mix(np.array([dim * TABLES + t + 1], np.uint64))[0])
        with np.errstate(over="ignore"):
            for half in range(HALVES):
                for k in range(8):
                    value = mix(value * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, half, k].astype(np.uint64))
        out[:, t] = value
    return out


def _by_length(batch: pa.RecordBatch):
    """Runs of rows of one vector length: row numbers, and their usable unit vectors; others have none."""
    values = batch.column(1).to_pylist()
    kinds: dict[int, list[int]] = {}
    for k, v in enumerate(values):
        if v and None not in v:
            kinds.setdefault(len(v), []).append(k)
    for own in kinds.values():
        for low in range(0, len(own), SLICE):
            part = own[low:low + SLICE]
            matrix = np.array([values[k] for k in part], np.float64)
            with np.errstate(all="ignore"):
                most = np.abs(matrix).max(axis=1)
                scaled = matrix / most[:, None]  # no square overflows
                unit = scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None] + 0.0
            good = np.isfinite(matrix).all(axis=1) & (most > 0)
            yield np.array(part)[good], unit[good]


def _named(rows: DataFrame) -> DataFrame:
    """vec_id, name (16 bytes; null for a vector that links with nothing), unit (the unit vector's bytes)."""
    def work(batches):
        for batch in batches:
            name, unit = [None] * batch.num_rows, [None] * batch.num_rows
            for own, vectors in _by_length(batch):
                for k, v in zip(own.tolist(), vectors, strict=True):
                    unit[k] = v.tobytes()
                    name[k] = hashlib.blake2b(unit[k], digest_size=16).digest()
            yield pa.record_batch([batch.column(0), pa.array(name, pa.binary()), pa.array(unit, pa.binary())], ["vec_id", "name", "unit"])

    return rows.mapInArrow(work, "vec_id long, name binary, unit binary")


def _hashed(classes: DataFrame) -> DataFrame:
    """class, members, unit, keys (TABLES x PROBES numbers of 8 bytes)."""
    def work(batches):
        for batch in batches:
            units = batch.column(2).to_pylist()
            keys: list[bytes] = [b""] * len(units)
            sizes = np.array([len(u) for u in units])
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                for low in range(0, len(own), SLICE):
                    part = own[low:low + SLICE].tolist()
                    for k, found in zip(part, cell_keys(np.frombuffer(b"".join(units[k] for k in part)).reshape(len(part), -1)), strict=True):
                        keys[k] = found.tobytes()
            yield pa.record_batch([*batch.columns, pa.array(keys, pa.binary())], ["class", "members", "unit", "keys"])

    return classes.select("class", "members", "unit").mapInArrow(work, "class long, members long, unit binary, keys binary")


def _entries(hashed: DataFrame) -> DataFrame:
    """(key, class, own): each key that a vector stands under, once."""
    def work(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            own = np.tile(np.arange(PROBES) == 0, len(keys) // PROBES)
            names = np.repeat(batch.column(0).to_numpy(), TABLES * PROBES)
            yield pa.record_batch([pa.array(keys), pa.array(names), pa.array(own)], ["key", "class", "own"])

    return hashed.select("class", "keys").mapInArrow(work, "key long, class long, own boolean")


def _counted(keys: np.ndarray, key: np.uint64, name: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (rows a, b) count under ``key``: it is of the first table where they meet, and of its two possible keys the smaller vector's cell."""
    table = int(np.argwhere(keys[0] == key)[0, 0])
    own = keys[:, :, 0]
    out = np.ones(len(a), bool)
    for t in range(table):
        met = (own[a, t, None] == keys[b, t]).any(axis=1) | (own[b, t, None] == keys[a, t]).any(axis=1)
        out &= ~met
    at_a, at_b = own[a, table] == key, own[b, table] == key
    out &= at_a | at_b
    # under the cell of one alone: the other's cell comes first where it is the smaller vector's and holds both
    a_first = (own[a, table, None] == keys[b, table]).any(axis=1) & (name[a] < name[b])
    b_first = (own[b, table, None] == keys[a, table]).any(axis=1) & (name[b] < name[a])
    return out & (at_a & at_b | at_a & ~b_first | at_b & ~a_first)


def _reached(near: np.ndarray, name: np.ndarray) -> np.ndarray:
    """The smallest name that links reach from each row."""
    least = name
    while True:
        lower = np.minimum(least, np.where(near, least[None, :], least[:, None]).min(axis=1))
        if (lower == least).all():
            return least
        least = lower


def _compare(batches):
    """(class, links, least) for the vectors of each pair of blocks under one key that have a link there."""
    gathered: list[np.ndarray] = []
    for table in runs(batches, ["key", "low", "high"]):
        if table.num_rows < 2:
            continue
        table = table.combine_chunks()
        unit = np.frombuffer(b"".join(table.column("unit").to_pylist())).reshape(table.num_rows, -1)
        near = unit @ unit.T >= table.column("least")[0].as_py()
        name, block = table.column("class").to_numpy(), table.column("block").to_numpy()
        near &= name[:, None] != name
        if table.column("low")[0].as_py() != table.column("high")[0].as_py():
            near &= block[:, None] != block
        linked = np.flatnonzero(near.any(axis=1))
        if not len(linked):
            continue
        near, name = near[np.ix_(linked, linked)], name[linked]
        keys = np.frombuffer(b"".join(table.column("keys").take(pa.array(linked)).to_pylist()), np.uint64).reshape(len(linked), TABLES, PROBES)
        members = table.column("members").to_numpy()[linked]
        key = np.array([table.column("key")[0].as_py()], np.int64).view(np.uint64)[0]
        here = (keys[:, :, 0] == key).any(axis=1)
        near &= here[:, None] | here
        a, b = np.nonzero(np.triu(near))
        counts = _counted(keys, key, name, a, b)
        a, b = a[counts], b[counts]
        links = np.bincount(a, members[b], len(linked)) + np.bincount(b, members[a], len(linked))
        gathered.append(np.column_stack([name, links.astype(np.int64), _reached(near, name)]))
        if len(gathered) > 2000:
            yield _found(gathered)
            gathered = []
    yield _found(gathered)


def _found(gathered: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(gathered) if gathered else np.zeros((0, 3), np.int64)
    return pa.record_batch([pa.array(rows[:, k]) for k in range(3)], ["class", "links", "least"])


def link_embeddings(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Links vectors of one length found with a cosine of ``least`` (0.95 or more) or more, in double precision. A vector that is
    null, empty, zero or holds a null or non-finite component links with nothing. Vectors of one direction, to the last bit of
    their unit vectors, are one class and link with each other. ``component_id`` is the smallest vec_id that links reach, and
    ``kept`` marks the rows that have it. Repeated rows are vectors of their own, so they link; rows of one id and different
    vectors are one node where that id names their classes; a row with a null id takes its class's links and component, and a
    class without any other id links with nothing. Other columns are left out; an empty table gives no rows.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    named = stored(_named(rows))
    grouped = named.where("name is not null").groupBy("name").agg(F.min("vec_id").alias("class"), F.count("*").alias("members"), F.first("unit").alias("unit"))
    classes = stored(_hashed(stored(grouped.where("class is not null"))))
    entries = stored(_entries(classes))
    held = entries.groupBy("key").agg(F.count("*").alias("rows"), F.max("own").alias("own")).where("own and rows > 1")
    open_ = held.select("key", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    met = entries.join(open_, "key").select("key", "class", "blocks")
    met = met.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks").cast("long")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class", F.lit(float(least)).alias("least"))
    dealt = stored(met).join(classes, "class").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    found = stored(dealt.mapInArrow(_compare, "class long, links long, least long").groupBy("class", "least").agg(F.sum("links").alias("links")))
    labels = components(found.where("class != least").select(F.col("class").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    known = classes.select("class", "members").groupBy("class").agg(F.sum("members").alias("members"))
    facts = known.join(counts, "class", "left").join(labels.withColumnRenamed("node", "class"), "class", "left")
    facts = stored(facts.select("class", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component")))
    owners = grouped.select("name", "class")
    out = named.select("vec_id", "name").join(owners, "name", "left").join(facts, "class", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: All pairs by blocks of the whole table; an exact cosine in double precision.
SQL = f"""
with recursive rows_ as (select vec_id, embedding::double[] v from embeddings),
good as (
  select vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) norm from rows_
  where v is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0),
units as (select vec_id, list_transform(v, lambda x: x / norm) u from good where norm > 0),
links as (select a.vec_id x, b.vec_id y from units a join units b on a.vec_id < b.vec_id and list_dot_product(a.u, b.u) >= {LEAST}),
edges as (select x, y from links union all select y, x from links),
reach(vec_id, other) as (select x, y from edges union select r.vec_id, e.y from reach r join edges e on e.x = r.other),
least_ as (select vec_id, min(other) m from reach group by 1),
degree as (select x vec_id, count(*) n from edges group by 1)
select r.vec_id, coalesce(n, 0)::bigint n_links, least(r.vec_id, coalesce(m, r.vec_id)) component_id, r.vec_id = least(r.vec_id, coalesce(m, r.vec_id)) kept
from rows_ r left join degree using (vec_id) left join least_ using (vec_id)
"""
