"""Embedding near-dedup by cross-polytope hashing after fast Hadamard rotations.

Vectors that are equal are one class with a multiplicity. A class is rotated by three rounds of random
signs and a Walsh-Hadamard transform; its hash is the coordinate of largest size with its sign, and
``hashes`` of them name a bucket of a table. The class stands in its own bucket and, as a probe, in the
buckets with the next best coordinates. Pairs that meet in a bucket where one of them is at home are
verified in double precision by block products; a pair that meets several times is counted in the
first of its buckets only. Large buckets are cut into blocks of ``BLOCK``, and each pair of blocks is a
task of its own, which returns a row per member: its number of links there and the least member it is
joined to; within a task products are taken by tiles. More hashes a table are taken as the table grows,
and more tables with them, so that recall stays (see ``tables_for``).

Defined results: vectors that are null or zero, or hold null or non-finite components, link with
nothing; vectors of different length do not compare; equal vectors link with each other; repeated rows
count each; a null id links like any other, and a component of null ids alone has a null id; an empty
table gives no row; other columns are ignored. The hashing is seeded, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import components, dropped, saved

COSINE = 0.95
TABLES = 4
PROBES = 3
BLOCK = 8192
TILE = 1024
#: Classes that a bucket should hold about; more hashes a table are taken beyond it.
BUCKET = 512
SEED = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def codes(unit: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """Bucket codes, shape (rows, tables, 1 + probes): home first, then probes by how little they lose."""
    n, dim = unit.shape
    d = max(2, 1 << (dim - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :dim] = unit
    out = np.zeros((n, tables, 1 + probes), np.int64)
    for t in range(tables):
        code, options = np.zeros(n, np.int64), []
        for j in range(hashes):
            rng = np.random.default_rng([seed, t, j, d])
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            size = np.abs(y)
            order = np.argsort(-size, 1, kind="stable")[:, : probes + 1]
            index = 2 * order + (np.take_along_axis(y, order, 1) < 0)
            sizes = np.take_along_axis(size, order, 1)
            code = code * (2 * d) + index[:, 0]
            power = (2 * d) ** (hashes - 1 - j)
            options += [(sizes[:, 0] - sizes[:, r], (index[:, r] - index[:, 0]) * power) for r in range(1, order.shape[1])]
        out[:, t, 0] = code
        loss = np.stack([o[0] for o in options], 1)
        best = np.argsort(loss, 1, kind="stable")[:, :probes]
        shift = np.take_along_axis(np.stack([o[1] for o in options], 1), best, 1)
        out[:, t, 1:] = code[:, None]
        out[:, t, 1 : 1 + shift.shape[1]] += shift
    return out


def tables_for(hashes: int) -> int:
    """Tables by hashes of each: 4 for one or two, 8 for three, 12 for four. A pair at the threshold meets with chance 0.96 at least in all of them."""
    return TABLES * max(1, hashes - 1)


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, dim, unit): unit is the vector over its length as doubles, null where it links with nothing."""
    for batch in batches:
        column = batch.column(1)
        flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
        dims = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(dims) - dims
        keys: list[int | None] = [None] * len(dims)
        units: list[bytes | None] = [None] * len(dims)
        for dim in np.unique(dims[dims > 0]).tolist():
            at = np.flatnonzero(dims == dim)
            x = flat[starts[at][:, None] + np.arange(dim)]
            fine = np.isfinite(x).all(1)
            fine[fine] = np.abs(x[fine]).max(1) > 0
            at, x = at[fine], x[fine] + 0.0
            with np.errstate(over="ignore"):
                length = np.sqrt((x * x).sum(1))
            odd = ~np.isfinite(length) | (length < 1e-150)
            y = x.copy()
            y[odd] /= np.abs(x[odd]).max(1)[:, None]
            length[odd] = np.sqrt((y[odd] * y[odd]).sum(1))
            y /= length[:, None]
            for k, raw, unit in zip(at.tolist(), x, y, strict=True):
                keys[k], units[k] = xxhash.xxh64_intdigest(raw.tobytes()) - (1 << 63), unit.tobytes()
        kept = pa.array([d if u is not None else None for d, u in zip(dims.tolist(), units, strict=True)], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), kept, pa.array(units, pa.binary())], names=["id", "key", "dim", "unit"])


def placed(batches: Iterator[pa.RecordBatch], hashes: int) -> Iterator[pa.RecordBatch]:
    """(table_no, bucket, home, key, copies, dim, unit, codes) for each bucket that a class stands in."""
    for batch in batches:
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        dims = np.array(cols["dim"].to_pylist(), np.int64)
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            part = batch.take(pa.array(at))
            unit = np.frombuffer(b"".join(part.column(3).to_pylist()), np.float64).reshape(len(at), dim)
            tables = tables_for(hashes)
            code = codes(unit, tables, hashes, PROBES, SEED)
            carried = pa.array([c.tobytes() for c in code], pa.binary())
            for t in range(tables):
                for r in range(1 + PROBES):
                    fresh = (code[:, t, r : r + 1] != code[:, t, :r]).all(1) if r else np.ones(len(at), bool)
                    pick = pa.array(np.flatnonzero(fresh))
                    rows = part.take(pick)
                    n = rows.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t, np.int32)), pa.array(code[fresh, t, r]), pa.array(np.full(n, r == 0)), *rows.columns[:4], carried.take(pick)], names=["table_no", "bucket", "home", "key", "copies", "dim", "unit", "codes"])


def joined(table: pa.Table, cosine: float) -> pa.Table:
    """(key, links, label) for the members of one pair of blocks of one bucket."""
    t, bucket, dim = table["table_no"][0].as_py(), table["bucket"][0].as_py(), table["dim"][0].as_py()
    key, copies, home, block = (table[n].to_numpy() for n in ("key", "copies", "home", "block"))
    unit = np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(len(key), dim)
    code = np.frombuffer(b"".join(table["codes"].to_pylist()), np.int64).reshape(len(key), -1, 1 + PROBES)
    lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    links, most = np.zeros(len(key), np.int64), np.iinfo(np.int64).max
    by_key = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    rank[by_key] = np.arange(len(key))
    root = np.arange(len(key))  # of each rank: the least rank that links join it to

    for i in range(0, len(left), TILE):
        for j in range(i if lo == hi else 0, len(right), TILE):
            x, y = np.nonzero(unit[left[i : i + TILE]] @ unit[right[j : j + TILE]].T >= cosine)
            x, y = left[i + x], right[j + y]
            pick = (x < y if lo == hi else x != y) & (home[x] | home[y])
            x, y = x[pick], y[pick]
            for a in range(0, len(x), 1 << 16):
                x1, y1 = x[a : a + (1 << 16)], y[a : a + (1 << 16)]
                # The pair's first meeting: the first table, and there the smaller code, where one is at home and the other stands.
                at_x, at_y = (code[x1, :, :1] == code[y1]).any(2), (code[y1, :, :1] == code[x1]).any(2)
                first, rows = np.argmax(at_x | at_y, 1), np.arange(len(x1))
                where = np.minimum(np.where(at_x[rows, first], code[x1, first, 0], most), np.where(at_y[rows, first], code[y1, first, 0], most))
                here = (first == t) & (where == bucket)
                np.add.at(links, x1[here], copies[y1[here]])
                np.add.at(links, y1[here], copies[x1[here]])
                x1, y1 = rank[x1], rank[y1]
                while (apart := root[x1] != root[y1]).any():
                    x1, y1 = x1[apart], y1[apart]
                    np.minimum.at(root, np.maximum(root[x1], root[y1]), np.minimum(root[x1], root[y1]))
                    while (root[root] != root).any():
                        root = root[root]
    labels = key[by_key[root[rank]]]
    some = np.flatnonzero((links > 0) | (labels != key))
    return pa.table({"key": key[some], "links": links[some], "label": labels[some]})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = saved(vectors.select(F.col(vec_id).alias("id"), F.col(embedding).alias("v")).mapInArrow(read, f"id {kind}, key long, dim int, unit binary"))
    classes = saved(rows.filter("key is not null").groupBy("key", "dim").agg(F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit")).select("key", "copies", "dim", "unit"))
    total, dim = classes.agg(F.count(F.lit(1)), F.max("dim")).first()
    wide = 2 * max(2, 1 << ((dim or 2) - 1).bit_length())
    hashes = 1
    while wide**hashes * BUCKET < total and wide ** (hashes + 1) < 1 << 62:
        hashes += 1
    stands = saved(classes.mapInArrow(lambda b: placed(b, hashes), "table_no int, bucket long, home boolean, key long, copies long, dim int, unit binary, codes binary"))
    where = ["table_no", "bucket", "dim"]
    sizes = stands.groupBy(*where).agg(F.count(F.lit(1)).alias("members"), F.max("home").alias("any_home")).filter("members > 1 and any_home")
    cut = stands.join(sizes, where).withColumn("blocks", F.expr(f"cast((members + {BLOCK} - 1) div {BLOCK} as int)"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "members", "any_home", "blocks")
    found = saved(cut.groupBy(*where, "lo", "hi").applyInArrow(lambda t: joined(t, cosine), "key long, links long, label long"))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    labels = components(found.filter("key <> label").select(F.col("key").alias("a"), F.col("label").alias("b")))
    dropped(stands)
    known = classes.select("key", "copies").join(links, "key", "left").join(labels.withColumnRenamed("node", "key"), "key", "left")
    known = known.select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "key").alias("label"))
    out = saved(rows.select("id", "key").join(known, "key", "left"))
    least = out.filter("key is not null").groupBy("label").agg(F.min("id").alias("least"))
    out = out.join(least, "label", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
