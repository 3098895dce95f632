"""Fill-down of report headers onto the detail rows below them.

A hierarchical report lists a header row (an article) followed by its detail
rows (stores). Each detail row takes the last header value seen above it; the
code and the name are filled *independently* (a header with an empty name
keeps the previous name). Row order comes from the data (``row_no`` or a
timestamp), never from the physical order of a DataFrame.

Scale: a single window over one report (or one very active user) would put
the whole group into one task. Instead Spark cuts the rows, in the order of
(group, order), into ranges of about equal size; that is the one shuffle of the
rows. A task passes over its sorted range once, fills what it can see, and
writes the filled rows together with two small ones: the group its range begins
with, and the last header values of the group it ends with. Only the rows of a
range's first group can still lack a value from before the range. They get it
from the small rows, two per range: per group, the last set value of the ranges
before. So a group that spans many ranges is carried over all of them, whatever
its size, and what the plan and the driver hold depends on the number of ranges
only.

A caller with a dense row number can pass ``chunk=floor(row_no / B)``: then a
window fills each (group, chunk) and a small table carries over the chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.stage import written
from ledgerloom.session import ship_package

# of sampled_chunk: the number of chunks grows with the rows; it has no upper bound
ROWS_PER_CHUNK = 1_000_000


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def fill_down(df: DataFrame, order_by: Sequence[str], fill: Mapping[str, Column],
              is_header: Column, partition_by: Sequence[str] = (),
              chunk: Column | None = None, n_chunks: int | None = None,
              keep_headers: bool = False) -> DataFrame:
    """Carry header values down onto the following rows.

    ``fill`` maps an output column to the value it takes on header rows.
    ``order_by`` must be a total order inside each ``partition_by`` group.
    Header rows are dropped unless ``keep_headers``; detail rows above the
    first header keep NULLs. The rows are cut into ``n_chunks`` ranges (default:
    the shuffle partitions), or into the caller's own ``chunk``.
    """
    pcols = list(partition_by)
    outs = list(fill)
    marked = df.withColumn("__hdr", F.coalesce(is_header, F.lit(False)))
    for o in outs:
        marked = marked.withColumn(f"__v_{o}", F.when(F.col("__hdr"), fill[o]))

    if chunk is None:
        return _fill_ranges(marked, pcols, _cols(order_by), outs, n_chunks, keep_headers)
    marked = marked.withColumn("__chunk", chunk)

    order_key = F.struct(*_cols(order_by))
    keys = pcols + ["__chunk"]

    # 1. last header value per (group, chunk). Only header rows can hold one, so
    #    only they are aggregated (max_by over a struct order sorts its input);
    #    the (group, chunk) pairs of all rows come from a cheap hash distinct.
    lasts = marked.where(F.col("__hdr")).groupBy(*keys).agg(*[
        F.max_by(F.col(f"__v_{o}"), F.when(F.col(f"__v_{o}").isNotNull(), order_key))
        .alias(f"__last_{o}") for o in outs])
    pairs = marked.select(*keys).distinct()
    last_in_chunk = _join_null_safe(pairs, lasts, keys)

    # 2. value carried into each chunk from earlier chunks of the same group
    w_prev = (Window.partitionBy(*pcols).orderBy("__chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = last_in_chunk.select(*keys, *[
        F.last(f"__last_{o}", ignorenulls=True).over(w_prev).alias(f"__carry_{o}")
        for o in outs])

    # 3. fill inside the chunk, then fall back to the carried value
    joined = _join_null_safe(marked, carry, keys)
    w_in = (Window.partitionBy(*keys).orderBy(*_cols(order_by))
            .rowsBetween(Window.unboundedPreceding, 0))
    for o in outs:
        joined = joined.withColumn(
            o, F.coalesce(F.last(f"__v_{o}", ignorenulls=True).over(w_in), F.col(f"__carry_{o}")))
    if not keep_headers:
        joined = joined.where(~F.col("__hdr"))
    drop = ["__hdr", "__chunk"] + [f"__v_{o}" for o in outs] + [f"__carry_{o}" for o in outs]
    return joined.drop(*drop)


_ROW, _BEGIN, _END = 0, 1, 2  # what a written row is: a filled row, or one of a range's two small ones


def _fill_ranges(marked: DataFrame, pcols: list[str], order: list[Column], outs: list[str],
                 n: int | None, keep_headers: bool) -> DataFrame:
    """Fill over sorted ranges: one shuffle, one pass per range, a carry over ranges."""
    ship_package(marked.sparkSession)
    n = n or max(2, int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = [c for c in marked.columns if c != "__hdr" and not c.startswith("__v_") and c not in outs]
    kind = {f.name: f.dataType for f in marked.schema.fields}
    schema = T.StructType([
        *(T.StructField(c, kind[c]) for c in own), *(T.StructField(o, kind[f"__v_{o}"]) for o in outs),
        T.StructField("__kind", T.IntegerType()), T.StructField("__range", T.IntegerType()),
        T.StructField("__first", T.BooleanType())])
    ranged = (marked.repartitionByRange(n, *[F.col(c) for c in pcols], *order)
              .sortWithinPartitions(*pcols, *order))
    filled = written(ranged.mapInArrow(_filler(own, pcols, outs, keep_headers), schema), "filled-ranges")

    # two rows per range: what reaches a range's first group from the ranges before it
    ends = filled.where(F.col("__kind") != _ROW).select(*pcols, *outs, "__kind", "__range")
    before = (Window.partitionBy(*pcols).orderBy("__range", "__kind")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = (ends.select("__kind", "__range", *[F.last(o, ignorenulls=True).over(before).alias(f"__carry_{o}")
                                                for o in outs])
             .where(F.col("__kind") == _BEGIN).drop("__kind"))
    rows = filled.where(F.col("__kind") == _ROW).join(F.broadcast(carry), "__range", "left")
    return rows.select(*[F.col(c) for c in own], *[
        F.coalesce(F.col(o), F.when(F.col("__first"), F.col(f"__carry_{o}"))).alias(o) for o in outs])


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Row by row, whether two group values differ; NULL equals NULL, NaN equals NaN."""
    try:
        same = pc.fill_null(pc.equal(a, b), False)
    except pa.ArrowNotImplementedError:
        same = pa.array([x == y for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())
    same = pc.or_(same, pc.and_(a.is_null(), b.is_null()))
    if pa.types.is_floating(a.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return ~same.to_numpy(zero_copy_only=False)


def _filler(own: list[str], pcols: list[str], outs: list[str], keep_headers: bool):
    """One pass over a sorted range: every row takes the last header value of its group."""
    def fill(batches):
        number, last_key, last, in_first, shape = TaskContext.get().partitionId(), None, None, True, None

        def small(kind: int, keys: list, values: list) -> pa.RecordBatch:
            given = {**dict(zip(pcols, keys)), **dict(zip(outs, values))}
            cols = [given.get(f.name, pa.nulls(1, f.type)) for f in shape]
            return pa.RecordBatch.from_arrays([*cols, pa.array([kind], pa.int32()), pa.array([number], pa.int32()),
                                               pa.nulls(1, pa.bool_())], names=names)

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = [b.column(c) for c in pcols]
            values = [b.column(f"__v_{o}") for o in outs]
            if last_key is None:  # the range begins
                shape = [*(b.schema.field(c) for c in own),
                         *(b.schema.field(f"__v_{o}").with_name(o) for o in outs)]
                names = [*(f.name for f in shape), "__kind", "__range", "__first"]
                last_key, last = [k.slice(0, 1) for k in keys], [pa.nulls(1, v.type) for v in values]
                yield small(_BEGIN, last_key, last)
            new = np.zeros(n, bool)
            for k, before in zip(keys, last_key):
                new |= _differs(k, pa.concat_arrays([before, k.slice(0, n - 1)]))
            at = np.arange(n)
            begun = np.maximum.accumulate(np.where(new, at, -1))  # -1: the group of the batch before
            filled = []
            for i, v in enumerate(values):
                seen = np.maximum.accumulate(np.where(v.is_valid().to_numpy(zero_copy_only=False), at, -1))
                # place 0 is the value carried into the batch
                place = np.where(seen >= np.maximum(begun, 0), seen + 1, 0)
                none = (begun >= 0) & (seen < begun)
                filled.append(pa.concat_arrays([last[i], v]).take(pa.array(place, mask=none)))
            out = pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in own), *filled, pa.array(np.full(n, _ROW, np.int32)),
                 pa.array(np.full(n, number, np.int32)), pa.array(in_first & (begun < 0))], names=names)
            yield out if keep_headers else out.filter(pc.invert(b.column("__hdr")))
            in_first = in_first and not new.any()
            last_key, last = [k.slice(n - 1, 1) for k in keys], [f.slice(n - 1, 1) for f in filled]
        if last_key is not None:
            yield small(_END, last_key, last)

    return fill


def sampled_chunk(df: DataFrame, key_cols: Sequence[str], n_chunks: int | None = None,
                  per_chunk: int = 32, seed: int = 20260501) -> Column:
    """Chunk number of each row in the order of ``key_cols`` (NULLs first).

    ``n_chunks`` defaults to the shuffle partitions, or one per
    ``ROWS_PER_CHUNK`` rows if that is more. Bounds are the ``1/n .. (n-1)/n``
    quantiles of a seeded sample of about ``n_chunks * per_chunk`` keys (at most
    ``n_chunks - 1`` are kept). Each row finds its chunk by a binary search over
    the array of bounds, so the plan's code does not grow with the chunks.
    """
    keys = df.select(*key_cols)
    total = keys.count()
    if n_chunks is None:
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n_chunks = max(2, width, -(-total // ROWS_PER_CHUNK))
    if total == 0 or n_chunks <= 1:
        return F.lit(0)
    fraction = min(1.0, 1.25 * n_chunks * per_chunk / total)
    sample = keys.sample(withReplacement=False, fraction=fraction, seed=seed).collect()
    if not sample:
        return F.lit(0)
    sample.sort(key=lambda r: tuple((v is not None, v) for v in r))
    bounds = []
    for i in range(1, n_chunks):
        b = tuple(sample[min(len(sample) - 1, (i * len(sample)) // n_chunks)])
        if not bounds or b != bounds[-1]:
            bounds.append(b)
    types = {f.name: f.dataType for f in keys.schema.fields}
    # one SQL expression with typed literals, parsed once: building it from
    # Column objects costs a JVM round trip per literal
    key = "named_struct(" + ", ".join(f"'{c}', {_ident(c)}" for c in key_cols) + ")"

    def bound(b) -> str:
        return "named_struct(" + ", ".join(f"'{c}', {_sql_literal(v, types[c])}"
                                           for c, v in zip(key_cols, b)) + ")"

    table = "array(" + ", ".join(map(bound, bounds)) + ")"
    jumps = ", ".join(str(1 << i) for i in reversed(range(len(bounds).bit_length())))
    # at = how many bounds are at or below the key
    return F.expr(f"aggregate(array({jumps}), 0, (at, jump) -> CASE WHEN at + jump <= {len(bounds)} "
                  f"AND get({table}, at + jump - 1) <= {key} THEN at + jump ELSE at END)")


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_literal(v, dt) -> str:
    """A SQL literal of type ``dt`` holding the collected value ``v``."""
    t = dt.simpleString()
    if v is None:
        return f"CAST(NULL AS {t})"
    if isinstance(dt, T.BooleanType):
        return "true" if v else "false"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return f"CAST({int(v)} AS {t})"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        x = float(v)
        text = "NaN" if math.isnan(x) else ("Infinity" if x > 0 else "-Infinity") \
            if math.isinf(x) else repr(x)
        return f"CAST('{text}' AS {t})"
    if isinstance(dt, T.DecimalType):
        return f"CAST('{v}' AS {t})"
    if isinstance(dt, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dt, T.BinaryType):
        return f"X'{bytes(v).hex()}'"
    if isinstance(dt, T.DateType):
        return f"DATE '{v.isoformat()}'"
    if isinstance(dt, T.TimestampNTZType):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(dt, T.TimestampType):
        return f"CAST('{v.isoformat(sep=' ')}' AS TIMESTAMP)"
    raise TypeError(f"fill-down order column of type {t} is not supported")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right.select(*[F.col(c).alias(f"__r{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"__r{k}" for k in keys])
