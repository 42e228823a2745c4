"""Functions of the user's own over neighbourhoods, blocks and groups.

Spark lays the rows out - halo blocks, blocks of a declared shape, sorted
groups - and the function sees numpy arrays or Arrow tables of a bounded size.
A group without such a bound is given to a :class:`Fold` in batches; if its
states can be merged, the group is cut into slices that many tasks fold.
"""

from __future__ import annotations

import itertools
import pickle
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.operators.relational import _null_safe_join

# functions sent to executors carry their code
cloudpickle.register_pickle_by_value(sys.modules[__name__])

col = F.col

#: cells of a block (without its halo) unless the caller says otherwise
BLOCK_CELLS = 1 << 16
#: rows of a group that a plain function is given at once
GROUP_ROWS = 100_000
#: output rows gathered before they are handed on
OUT_ROWS = 4096
#: results are built for groups of so many rows together
OF_ROWS = 20_000


def _schema(fields) -> T.StructType:
    return fields if isinstance(fields, T.StructType) else T.StructType.fromDDL(fields)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


# ------------------------------------------------------------ U4: neighbours
def _virtual(c: Column, n: int, depth: int, boundary) -> Column:
    """Positions that a cell at ``c`` of an axis of ``n`` takes, also outside the grid."""
    c = c.cast("long")
    if boundary == "periodic":
        wraps = -(-depth // n)
        out = F.transform(F.sequence(F.lit(-wraps), F.lit(wraps)), lambda k: c + k * n)
        return F.filter(out, lambda p: (p >= -depth) & (p < n + depth))
    if boundary == "nearest":
        lo = F.when(c == 0, F.lit(-depth).cast("long")).otherwise(c)
        return F.sequence(lo, F.when(c == n - 1, F.lit(n - 1 + depth).cast("long")).otherwise(c))
    if boundary == "reflect":
        out = F.array(c, -1 - c, 2 * n - 1 - c)
        return F.array_distinct(F.filter(out, lambda p: (p >= -depth) & (p < n + depth)))
    return F.array(c)


def extent(df: DataFrame, dims) -> dict[str, int]:
    """Length of each axis: its largest index and one. One aggregate over the dimension columns."""
    r = df.agg(*[F.max(d).alias(d) for d in dims]).first()
    return {d: 0 if r[d] is None else int(r[d]) + 1 for d in dims}


def map_overlap(df: DataFrame, dims, kernel: Callable[[np.ndarray], np.ndarray], depth=1, value: str = "value", out: str | None = None,
                boundary="none", shape: dict | None = None, block=None, region: dict | None = None) -> DataFrame:
    """A numpy kernel over every block of a grid with a halo of ``depth`` cells around it (U4).

    ``df`` has one row per cell (integer ``dims`` from 0, ``value``); a cell that occurs twice is an error. The kernel
    gets a float64 array of at most ``block + 2 * depth`` per axis, NaN where there is no cell or a NULL, and returns an
    array of the same shape; the halo is cut off and each cell of ``df`` gets its value (NaN becomes NULL) in ``out``.
    ``depth`` and ``block`` are one number or one per dimension; a depth beyond a block or an axis is fine.

    ``boundary``: ``"none"`` - the array ends where the grid ends; ``"periodic"``, ``"nearest"``, ``"reflect"`` - the halo
    goes on with the grid's own cells (``reflect`` repeats the edge and needs depth <= axis); a number - it holds that.
    ``shape`` gives the axes' lengths (else they are looked up, one small job). ``region`` ({dim: (lo, hi)}) asks for a
    part of the result: only blocks that meet it are formed, and with boundary "none" or a number only cells within
    ``depth`` of it are read.

    One shuffle by block: a cell goes to the blocks whose halo it lies in. Arrays are as large as a block, whatever the
    grid's size.
    """
    dims = list(dims)
    per = lambda v: dict(v) if isinstance(v, dict) else {d: v for d in dims}
    depth = per(depth)
    block = per(block or max(1, int(BLOCK_CELLS ** (1 / len(dims)))))
    shape = dict(shape) if shape else extent(df, dims)
    out = out or value
    pad = float(boundary) if isinstance(boundary, (int, float)) else None
    if pad is None and boundary not in ("none", "periodic", "nearest", "reflect"):
        raise ValueError(f"unknown boundary {boundary!r}")
    if boundary == "reflect" and any(depth[d] > shape[d] for d in dims):
        raise ValueError("reflect needs a depth of at most the axis")
    region = {d: (max(0, lo or 0), shape[d] if hi is None else min(hi, shape[d])) for d, (lo, hi) in (region or {}).items()}
    cells = df.select(*dims, col(value).cast("double").alias("_v"))
    for d, (lo, hi) in region.items():
        if boundary == "none" or pad is not None:
            cells = cells.where((col(d) >= lo - depth[d]) & (col(d) < hi + depth[d]))
    for d in dims:
        lo, hi = region.get(d, (0, shape[d]))
        first, last = lo // block[d], max(hi - 1, lo) // block[d]
        cells = cells.withColumn(f"_p_{d}", F.explode(_virtual(col(d), max(shape[d], 1), depth[d], boundary)))
        reach = F.sequence(F.greatest(F.lit(first).cast("long"), F.floor((col(f"_p_{d}") - depth[d]) / block[d])),
                           F.least(F.lit(last).cast("long"), F.floor((col(f"_p_{d}") + depth[d]) / block[d])), F.lit(1).cast("long"))
        met = (F.floor((col(f"_p_{d}") - depth[d]) / block[d]) <= last) & (F.floor((col(f"_p_{d}") + depth[d]) / block[d]) >= first)
        cells = cells.where(met).withColumn(f"_b_{d}", F.explode(reach))
    where, at = [f"_b_{d}" for d in dims], [f"_p_{d}" for d in dims]
    schema = T.StructType([*[df.schema[d] for d in dims], T.StructField(out, T.DoubleType())])
    arrow = _arrow(schema)
    outer = boundary != "none"

    def run(t: pa.Table) -> pa.Table:
        start, stop, core = [], [], []
        for d, b in zip(dims, where, strict=True):
            lo = int(t[b][0].as_py()) * block[d]
            hi = min(lo + block[d], shape[d])
            start.append(lo - depth[d] if outer else max(0, lo - depth[d]))
            stop.append(hi + depth[d] if outer else min(shape[d], hi + depth[d]))
            core.append((lo, hi))
        size = [b - a for a, b in zip(start, stop, strict=True)]
        # a block's last cells reach less far than the shuffle assumed at the grid's end
        p = [t[c].to_numpy() for c in at]
        inside = np.ones(t.num_rows, bool)
        for q, a, b in zip(p, start, stop, strict=True):
            inside &= (q >= a) & (q < b)
        flat = np.ravel_multi_index([q[inside] - a for q, a in zip(p, start, strict=True)], size)
        if len(np.unique(flat)) != len(flat):
            raise ValueError(f"a cell of block {[int(t[b][0].as_py()) for b in where]} occurs twice")
        grid, there = np.full(np.prod(size), np.nan), np.zeros(np.prod(size), bool)
        if pad is not None:
            outside = np.zeros(size, bool)
            for k, (a, n) in enumerate(zip(start, size, strict=True)):
                line = np.arange(a, a + n)
                edge = (line < 0) | (line >= shape[dims[k]])
                outside |= edge.reshape([-1 if i == k else 1 for i in range(len(dims))])
            grid[outside.ravel()] = pad
        grid[flat] = t["_v"].to_numpy()[inside]
        there[flat] = True
        made = np.asarray(kernel(grid.reshape(size)))
        if made.shape != tuple(size):
            raise ValueError(f"the kernel made an array of {made.shape} from one of {tuple(size)}")
        cut = tuple(slice(lo - a, hi - a) for (lo, hi), a in zip(core, start, strict=True))
        index = np.argwhere(there.reshape(size)[cut])
        index += np.array([lo for lo, _ in core])
        for k, d in enumerate(dims):
            lo, hi = region.get(d, (0, shape[d]))
            index = index[(index[:, k] >= lo) & (index[:, k] < hi)]
        values = made[tuple(index[:, k] - a for k, a in enumerate(start))].astype(np.float64)
        return pa.table([*[pa.array(index[:, k]).cast(arrow.field(d).type) for k, d in enumerate(dims)],
                         pa.array(values, pa.float64(), from_pandas=True)], arrow)

    return cells.groupBy(*where).applyInArrow(run, schema)


# ---------------------------------------------------------------- U3: blocks
def map_blocks(df: DataFrame, dims, blocks: dict, fn: Callable[..., dict], template: str | T.StructType, out_dims: dict,
               values=("value",), shape: dict | None = None, max_cells: int = 1 << 20) -> DataFrame:
    """A vectorised function over blocks of a grid, with a declared result.

    ``blocks`` gives the block's length per dimension, ``None`` for the whole axis. ``fn(arrays, origin)`` gets float64
    arrays by value name, all of the block's shape (NaN: no cell or NULL), and the index of the block's first cell per
    dimension; it returns arrays by the names that ``template`` (DDL of the value columns) declares. Their shape is
    declared too: ``out_dims`` maps each dimension of the result to ``"same"`` (a dimension of the grid, kept) or to a
    length (a dimension that the function makes; a grid dimension that isn't named is reduced). What the function
    returns is checked against both, and cast.

    The result has one row per cell of the declared shape, none where all its values are NaN. A block is one array of
    bounded size: a layout whose blocks would exceed ``max_cells`` is refused, so a whole axis must be one that stays
    short (hours, days, features).
    """
    dims, values = list(dims), list(values)
    shape = dict(shape) if shape else extent(df, dims)
    size = {d: shape[d] if blocks.get(d) is None else blocks[d] for d in dims}
    if np.prod([max(1, n) for n in size.values()], dtype=float) > max_cells:
        raise ValueError(f"blocks of {size} have more than {max_cells} cells")
    made = _schema(template)
    for d, n in out_dims.items():
        if n == "same" and d not in dims:
            raise ValueError(f"{d} is no dimension of the grid, so its length must be given")
    kinds = [df.schema[d] if n == "same" else T.StructField(d, T.LongType()) for d, n in out_dims.items()]
    # blocks over reduced dimensions keep their number, or results of two blocks would share a cell
    cut = [d for d in dims if d not in out_dims and size[d] < shape[d]]
    schema = T.StructType([*[T.StructField(f"block_{d}", T.LongType()) for d in cut], *kinds, *made.fields])
    arrow = _arrow(schema)
    where = [f"_b_{d}" for d in dims]

    def run(t: pa.Table) -> pa.Table:
        number = [int(t[b][0].as_py()) for b in where]
        origin = {d: n * size[d] for d, n in zip(dims, number, strict=True)}
        length = [min(size[d], shape[d] - origin[d]) for d in dims]
        flat = np.ravel_multi_index([t[d].to_numpy() - origin[d] for d in dims], length)
        if len(np.unique(flat)) != len(flat):
            raise ValueError(f"a cell of block {number} occurs twice")
        arrays = {}
        for v in values:
            a = np.full(np.prod(length), np.nan)
            a[flat] = t[v].to_numpy()
            arrays[v] = a.reshape(length)
        result = fn(arrays, origin)
        if set(result) != set(made.names):
            raise ValueError(f"the function made {sorted(result)}, {sorted(made.names)} are declared")
        want = tuple(length[dims.index(d)] if n == "same" else n for d, n in out_dims.items())
        for name, a in result.items():
            if np.shape(a) != want:
                raise ValueError(f"{name} has the shape {np.shape(a)}, {want} is declared")
        index = np.indices(want).reshape(len(want), -1)
        columns = [pa.array(np.full(index.shape[1], number[dims.index(d)])) for d in cut]
        columns += [pa.array(i + (origin[d] if n == "same" else 0)) for i, (d, n) in zip(index, out_dims.items(), strict=True)]
        filled = [pa.array(np.asarray(result[n]).ravel(), from_pandas=True) for n in made.names]
        keep = pc.is_valid(filled[0])
        for c in filled[1:]:
            keep = pc.or_(keep, pc.is_valid(c))
        return pa.table([c.cast(f.type) for c, f in zip([*columns, *filled], arrow, strict=True)], arrow).filter(keep)

    d = df.select(*dims, *[col(v).cast("double").alias(v) for v in values], *[F.floor(col(d) / size[d]).cast("long").alias(f"_b_{d}") for d in dims])
    return d.groupBy(*where).applyInArrow(run, schema)


# ---------------------------------------------------------------- U2: groups
class Fold:
    """A function of a group that takes the group's rows in batches, in order.

    ``start()`` gives a state, ``step(state, table)`` takes up some rows and gives the new state, ``finish(state)``
    gives the result (a table, or columns by name). ``merge(a, b)``, if there is one, joins the states of a slice and of
    the slice that follows it; a state can be pickled and must not grow with the rows."""

    merge: Callable | None = None

    def start(self):
        raise NotImplementedError

    def step(self, state, rows: pa.Table):
        raise NotImplementedError

    def finish(self, state):
        raise NotImplementedError


def _runs(batches, keys: list[str]):
    """Stretches of rows with equal keys (nulls and NaNs equal): (continues the stretch before it, table)."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        both = pa.concat_tables([last, t.select(keys)]) if last is not None else t.select(keys)
        n = both.num_rows
        differs = np.zeros(n - 1, bool)
        for k in keys:
            c = both[k].combine_chunks()
            a, z = c.slice(0, n - 1), c.slice(1)
            d = pc.fill_null(pc.not_equal(a, z), False).to_numpy(zero_copy_only=False)
            if pa.types.is_floating(c.type):
                nan = pc.fill_null(pc.is_nan(c), False).to_numpy(zero_copy_only=False)
                d = d & ~(nan[:-1] & nan[1:])
            null = pc.is_null(c).to_numpy(zero_copy_only=False)
            differs |= d | (null[:-1] != null[1:])
        goes_on = last is not None and not differs[0]
        cuts = np.flatnonzero(differs if last is None else differs[1:]) + 1
        for i, (a, z) in enumerate(itertools.pairwise([0, *cuts.tolist(), t.num_rows])):
            yield goes_on and i == 0, t.slice(a, z - a)
        last = t.select(keys).slice(t.num_rows - 1)


def _joined(parts: list, kind: pa.DataType) -> pa.ChunkedArray | pa.Array:
    """One column from its parts: lists in one conversion, if they are of one sort; anything else part by part."""
    if all(type(p) is list for p in parts):
        try:
            return pa.array(list(itertools.chain.from_iterable(parts)), from_pandas=True).cast(kind)
        except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError):
            pass
    arrays = [p if isinstance(p, (pa.Array, pa.ChunkedArray)) else pa.array(p, from_pandas=True) for p in parts]
    if len({a.type for a in arrays}) > 1:
        arrays = [a.cast(kind) for a in arrays]
    return pa.chunked_array([c for a in arrays for c in (a.chunks if isinstance(a, pa.ChunkedArray) else [a])], arrays[0].type).cast(kind)


class _Out:
    """Result rows in the declared schema, with the keys before them, handed on in batches of some size.

    What groups make is only noted by ``put``; columns are built for many groups together: those of ``OF_ROWS`` rows,
    as a noted key or column may keep the whole batch it is a slice of."""

    def __init__(self, keys: list[str], schema: pa.Schema):
        self.keys, self.schema, self.held, self.rows = keys, schema, [], 0
        self.want = {n for n in schema.names if n not in keys and n not in ("_part", "_state")}
        self.noted: list[tuple] = []  # key, rows, columns, more
        self.of = 0

    def put(self, key: pa.Table, made, of: int | None = None, **more) -> None:
        """``of``: the group's rows; the result of a group of unknown size is built at once."""
        if hasattr(made, "columns") and not isinstance(made, pa.Table):  # pandas
            made = pa.Table.from_pandas(made, preserve_index=False)
        made = {c: made[c] for c in made.column_names} if isinstance(made, pa.Table) else made
        if self.want != made.keys():
            raise ValueError(f"the function made the columns {sorted(made)}, {sorted(self.want)} are declared")
        sizes = {len(c) for c in made.values()}
        if len(sizes) > 1:
            raise ValueError(f"the function made columns of {sorted(sizes)} rows")
        n = sizes.pop() if sizes else 0
        if n:
            self.noted.append((key, n, made, more))
            self.rows += n
        self.of += OF_ROWS if of is None else of
        if self.of >= OF_ROWS:
            self._build()

    def _build(self) -> None:
        self.of = 0
        if self.noted:
            keys, sizes, made, more = zip(*self.noted, strict=True)
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            own = pa.concat_tables(keys).combine_chunks()
            columns = []
            for f in self.schema:
                if f.name in self.want:
                    columns.append(_joined([m[f.name] for m in made], f.type))
                elif f.name in self.keys:
                    columns.append(own[f.name].take(at).cast(f.type))
                else:
                    columns.append(pa.array([m.get(f.name) for m in more], f.type).take(at))
            self.held.append(pa.table(columns, self.schema))
            self.noted = []

    def add(self, table: pa.Table) -> None:
        self._build()
        self.held.append(table)
        self.rows += table.num_rows

    def ready(self, least: int = OUT_ROWS):
        if self.rows and self.rows >= least:
            self._build()
            table, self.held, self.rows = pa.concat_tables(self.held), [], 0
            yield from table.combine_chunks().to_batches()


def _with_keys(df: DataFrame, keys: list[str], schema) -> T.StructType:
    fields = _schema(schema)
    if clash := set(keys) & set(fields.names):
        raise ValueError(f"the keys come with the result; {sorted(clash)} can't be made too")
    return T.StructType([*[df.schema[k] for k in keys], *fields.fields])


def apply_groups(df: DataFrame, keys, fn: Callable[[pa.Table], object], schema, order=None, bound: int = GROUP_ROWS,
                 fold: Fold | None = None) -> DataFrame:
    """A function of any shape over each group (U2): ``fn`` gets a group's rows as an Arrow table, sorted by ``order``,
    and returns a table, a pandas frame or columns by name with the columns of ``schema``; the keys are put before them.

    A group of more than ``bound`` rows never reaches ``fn``: it goes to ``fold``, which must compute the same from
    batches. With ``fold.merge`` such groups are cut into slices for many tasks (:func:`fold_groups`); without, one task
    streams a group in sorted batches and carries the state. Without a ``fold`` a larger group is an error. NULL keys
    form groups like others; an empty table gives an empty result.
    """
    keys, order = [keys] if isinstance(keys, str) else list(keys), [order] if isinstance(order, str) else list(order or [])
    full = _with_keys(df, keys, schema)
    if fold is not None and fold.merge is not None:
        large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(col("_n") > bound)
        rest = _null_safe_join(df, large.drop("_n"), keys, "left_anti")
        hot = _null_safe_join(df, large.drop("_n"), keys, "left_semi")
        return apply_groups(rest, keys, fn, schema, order, bound).unionByName(fold_groups(hot, keys, fold, schema, order))
    arrow = _arrow(full)

    def run(batches):
        out, held, n, key, state = _Out(keys, arrow), [], 0, None, None

        def end():
            out.put(key, fn(pa.concat_tables(held)) if held else fold.finish(state), of=n)

        for goes_on, t in _runs(batches, keys):
            if not goes_on:
                if key is not None:
                    end()
                    yield from out.ready()
                held, n, key, state = [], 0, t.select(keys).slice(0, 1), None
            n += t.num_rows
            if n <= bound:
                held.append(t)
            elif fold is None:
                raise ValueError(f"group {key.to_pylist()[0]} has more than {bound} rows; give a fold for such groups")
            else:
                if held or state is None:
                    state = fold.start()
                    for h in held:
                        state = fold.step(state, h)
                    held = []
                state = fold.step(state, t)
        if key is not None:
            end()
        yield from out.ready(0)

    # a number of partitions: the work is by group, and AQE would put many groups of few bytes into one task
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, full)


def fold_groups(df: DataFrame, keys, fold: Fold, schema, order=None, partitions: int | None = None) -> DataFrame:
    """``fold`` over each group of any size: keys and the columns of ``schema`` that ``finish`` makes.

    With ``fold.merge`` rows are range-partitioned by (keys, order), so a group that holds a third of all rows spans
    many tasks; groups that lie within a task are finished there, and only the states of those that a partition's ends
    cut - two per task at most - meet again, in their order. Without ``merge`` a group is one task's, which reads it in
    sorted batches and holds one batch and the state.
    """
    keys, order = [keys] if isinstance(keys, str) else list(keys), [order] if isinstance(order, str) else list(order or [])
    full = _with_keys(df, keys, schema)
    arrow = _arrow(full)
    if fold.merge is None:
        def stream(batches):
            out, key, state = _Out(keys, arrow), None, None
            for goes_on, t in _runs(batches, keys):
                if not goes_on:
                    if key is not None:
                        out.put(key, fold.finish(state))
                        yield from out.ready()
                    key, state = t.select(keys).slice(0, 1), fold.start()
                state = fold.step(state, t)
            if key is not None:
                out.put(key, fold.finish(state))
            yield from out.ready(0)

        return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(stream, full)

    half = T.StructType([*[T.StructField(f.name, f.dataType) for f in full.fields], T.StructField("_part", T.LongType()), T.StructField("_state", T.BinaryType())])
    half_arrow = _arrow(half)
    empty = {f.name: pa.nulls(1, f.type) for f in arrow if f.name not in keys}

    def slices(batches):
        from pyspark import TaskContext

        part, out = TaskContext.get().partitionId(), _Out(keys, half_arrow)
        key, state, first = None, None, True
        for goes_on, t in _runs((b.select([c for c in b.schema.names if c != "_tie"]) for b in batches), keys):
            if not goes_on:
                if key is not None:
                    # the first stretch may go on in the partition before
                    out.put(key, empty, _part=part, _state=pickle.dumps(state)) if first else out.put(key, fold.finish(state), _part=part)
                    first = False
                    yield from out.ready()
                key, state = t.select(keys).slice(0, 1), fold.start()
            state = fold.step(state, t)
        if key is not None:
            out.put(key, empty, _part=part, _state=pickle.dumps(state))
        yield from out.ready(0)

    def join(batches):
        out, key, state = _Out(keys, arrow), None, None
        for goes_on, t in _runs(batches, keys):
            if not goes_on and key is not None:
                out.put(key, fold.finish(state))
                yield from out.ready()
                key = None
            if t["_state"][0].as_py() is None:  # finished in its task
                out.add(t.select(arrow.names).cast(arrow))
                continue
            for s in t["_state"].to_pylist():
                s = pickle.loads(s)
                key, state = (t.select(keys).slice(0, 1), s) if key is None else (key, fold.merge(state, s))
        if key is not None:
            out.put(key, fold.finish(state))
        yield from out.ready(0)

    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    d = df.withColumn("_tie", F.monotonically_increasing_id())  # so that rows equal in keys and order can lie apart
    d = d.repartitionByRange(n, *keys, *order, "_tie").sortWithinPartitions(*keys, *order, "_tie").mapInArrow(slices, half)
    return d.repartition(*keys).sortWithinPartitions(*keys, "_part").mapInArrow(join, full)


# ============================================================ registration
class Drawdown(Fold):
    """Largest fall of ``value`` below the highest value before it, and the number of rows; NULLs count as no value."""

    def __init__(self, value: str):
        self.value = value

    def start(self):
        return None, None, 0, 0  # high, low, fall, rows

    def step(self, state, rows):
        v = pc.drop_null(rows[self.value].combine_chunks()).to_numpy(zero_copy_only=False)
        mine = (None, None, 0, rows.num_rows)
        if len(v):
            mine = (int(v.max()), int(v.min()), int((np.maximum.accumulate(v) - v).max()), rows.num_rows)
        return self.merge(state, mine)

    def merge(self, a, b):
        if a[0] is None or b[0] is None:
            high, low, fall, _ = b if a[0] is None else a
            return high, low, fall, a[3] + b[3]
        return max(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2], a[0] - b[1]), a[3] + b[3]

    def finish(self, state):
        return {"drawdown": pa.array([state[2] if state[0] is not None else None], pa.int64()), "n": [state[3]]}


def largest(n: int, value: str):
    """The ``n`` largest rows of a group by ``value``, and how many rows it has."""
    def run(rows: pa.Table) -> dict:
        top = pc.select_k_unstable(rows, n, [(value, "descending")])
        return {value: rows[value].take(top), "of": [rows.num_rows] * len(top)}

    return run


def smooth(grid: np.ndarray) -> np.ndarray:
    """Weights 1 2 1 / 2 4 2 / 1 2 1 over the cells that are there, in units of 2^-40 so that sums are exact."""
    units = np.floor(np.nan_to_num(grid) * 2.0 ** 40 + 0.5)
    padded = np.pad(units, 1)
    rows = padded[:-2] + 2 * padded[1:-1] + padded[2:]
    return (rows[:, :-2] + 2 * rows[:, 1:-1] + rows[:, 2:]) / 2.0 ** 44


def pool(width: int):
    """Largest value and its place within each run of ``width`` of the last axis, NaN for none."""
    def run(arrays, origin):
        a = arrays["value"]
        a = np.pad(a, ((0, 0), (0, -a.shape[1] % width)), constant_values=np.nan).reshape(len(a), -1, width)
        at = np.argmax(np.where(np.isnan(a), -np.inf, a), axis=2)
        top = np.take_along_axis(a, at[..., None], 2)[..., 0]
        return {"top": top, "at": np.where(np.isnan(top), np.nan, at + width * np.arange(a.shape[1]))}

    return run


def register(reg) -> None:
    from sparklab.operators.grid import embedding_grid
    from sparklab.operators.h2o import H2O_CTE, h2o_frame
    from sparklab.plans.tpch_sql import with_duckdb_ctes
    from sparklab.tables import Tables

    def grid(s, d):
        return Tables.of(s, d).memo("embedding_grid", lambda t: embedding_grid(t.embeddings))

    cells = {"eg": """eg as (select vec_id as i, cast(generate_subscripts(embedding, 1) - 1 as bigint) as j,
                  cast(unnest(embedding) as double) as value from embeddings)"""}
    reg.add("stencil_kernel", lambda s, d: map_overlap(grid(s, d), ["i", "j"], smooth, 1, out="smooth"), with_duckdb_ctes("""
select a.i, a.j, cast(sum((2 - abs(a.i - b.i)) * (2 - abs(a.j - b.j)) * cast(floor(b.value * 1099511627776.0 + 0.5) as hugeint)) as double) / 17592186044416.0 as smooth
from eg a join eg b on b.i between a.i - 1 and a.i + 1 and b.j between a.j - 1 and a.j + 1 group by a.i, a.j""", cells))

    def pooled(s, d):
        e = grid(s, d)
        n = extent(e, ["i", "j"])
        return map_blocks(e, ["i", "j"], {"i": 512, "j": None}, pool(8), "top double, at long", {"i": "same", "bin": -(-n["j"] // 8)}, shape=n)

    reg.add("map_blocks", pooled, with_duckdb_ctes("""
select i, j // 8 as bin, max(value) as top, arg_max(j, value) as at from (select * from eg order by i, j) group by 1, 2""", cells))

    def frame(s, d):
        return Tables.of(s, d).memo("h2o", lambda t: h2o_frame(t.raw("lineitem")))

    reg.add("group_nlargest", lambda s, d: apply_groups(frame(s, d).where("v3 IS NOT NULL").select("id6", "v3"), "id6", largest(2, "v3"), "v3 double, of long"),
            with_duckdb_ctes("""select id6, v3, n as "of" from (select id6, v3, row_number() over (partition by id6 order by v3 desc) as rn,
  count(*) over (partition by id6) as n from h2o where v3 is not null) where rn <= 2""", {"h2o": H2O_CTE}))

    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]

    def falls(s, d):
        """All lines in order, per line number; most groups are above the bound and folded in slices."""
        li = Tables.of(s, d).raw("lineitem")
        li = li.select("l_linenumber", "l_returnflag", *order, F.rint(col("l_extendedprice") * 100).cast("long").alias("cents"))
        fall = Drawdown("cents")
        return apply_groups(li, ["l_linenumber", "l_returnflag"], lambda t: fall.finish(fall.step(fall.start(), t)), "drawdown long, n long", order,
                            bound=2500, fold=fall)

    reg.add("group_drawdown", falls, f"""
select l_linenumber, l_returnflag, max(high - cents) as drawdown, count(*) as n from (
  select l_linenumber, l_returnflag, cents, max(cents) over (partition by l_linenumber, l_returnflag order by {', '.join(order)} rows unbounded preceding) as high
  from (select *, cast(round(l_extendedprice * 100) as bigint) as cents from lineitem)) group by 1, 2""")
