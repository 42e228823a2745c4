"""Labelled-grid workloads (G3, G6-G12, G14): climatologies, circulation
diagnostics, satellite index, zonal statistics, regridding, group means.

Grids are tables ``(time, <cell dims>, <variables>)``. Registered queries
derive their grids from the fixture tables (lineitem / orders / events /
nation), so their work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparklab.functions.dates import ts_lit

col = F.col


# ------------------------------------------------------------- fixtures
def ship_grid(lineitem: DataFrame) -> DataFrame:
    """Six-hourly grid over 2 x 3 cells: shipped quantity per (time, cell); the hour is 6 * (order key % 4)."""
    time = col("l_shipdate") + F.make_dt_interval(F.lit(0), (col("l_orderkey") % 4 * 6).cast("int"))
    return (lineitem.groupBy(time.alias("time"), (col("l_linenumber") % 2).cast("int").alias("latitude"),
                             (col("l_suppkey") % 3).cast("int").alias("longitude"))
            .agg(F.sum("l_quantity").alias("value")))


SHIP_GRID_SQL = """sg as (select l_shipdate + to_hours(cast(l_orderkey % 4 * 6 as integer)) as time, cast(l_linenumber % 2 as integer) as latitude,
    cast(l_suppkey % 3 as integer) as longitude, sum(l_quantity) as value from lineitem group by 1, 2, 3)"""


def events_grid(events: DataFrame) -> DataFrame:
    """Hourly 4-D grid (time, level, latitude, longitude) with U, V, T, W."""
    u = col("user_id")
    return (events.groupBy(F.date_trunc("hour", "ts").alias("time"), (u % 2).cast("int").alias("level"),
                           F.expr("cast((user_id div 2) % 4 as int)").alias("latitude"),
                           F.expr("cast((user_id div 8) % 6 as int)").alias("longitude"))
            .agg(F.sum(col("value").cast("decimal(18,2)")).cast("double").alias("U"),
                 F.count(F.lit(1)).cast("double").alias("V"),
                 F.max("value").alias("T"), F.min("value").alias("W")))


EVENTS_GRID_SQL = """eg4 as (select date_trunc('hour', ts) as time, cast(user_id % 2 as integer) as level,
    cast((user_id // 2) % 4 as integer) as latitude, cast((user_id // 8) % 6 as integer) as longitude,
    cast(sum(cast(value as decimal(18,2))) as double) as U, cast(count(*) as double) as V,
    max(value) as T, min(value) as W from events group by 1, 2, 3, 4)"""


# --------------------------------------------------------- climatology
def triangle(window: int) -> list[tuple[int, int]]:
    """(offset, weight) of a triangular window: h - |k| for |k| < h, h half the window. The weighted mean is the same
    as with weights normalised to mean 1, and sums stay integers."""
    h = window // 2
    return [(k, h - abs(k)) for k in range(1 - h, h)]


def _unary(f):
    """``f`` with one visible argument, as higher-order functions ask for."""
    return lambda x: f(x)


def _running(a):
    """0 and the running sums of an array of longs."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(a, zero, lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))


def _circular_triangle(df: DataFrame, names, h: int) -> DataFrame:
    """The arrays ``names`` of ``df`` as circular triangular sums: element d becomes the sum over |k| < h of
    (h - |k|) * a[d + k], indices modulo the length. A triangle is a box of h over a box of h, and a box is a
    difference of running sums. Each running sum is a column of its own: a lambda would compute it per element."""
    at = lambda x, i: F.get(col(x), i)
    box = lambda x: F.transform(F.sequence(F.lit(0), F.size(x) - (h + 1)), lambda i: at(x, i + h) - at(x, i))
    longer = lambda x: F.transform(F.sequence(F.lit(1 - h), F.size(x) + (h - 2)), lambda i: at(x, F.pmod(i, F.size(x))))
    df = df.withColumns({n: _running(longer(n)) for n in names})
    df = df.withColumns({n: _running(box(n)) for n in names})
    return df.withColumns({n: box(n) for n in names})


def hourly_climatology(grid: DataFrame, cells=("latitude", "longitude"), value: str = "value", window: int = 61,
                       hours=(0, 6, 12, 18), fill: str = "day365", bits: int = 20) -> DataFrame:
    """Smoothed day-of-year climatology per (hour, dayofyear, cell).

    A circular ``window``-day triangular-weighted mean over days and years.
    ``fill="day365"`` (G6) fills a year's missing day from its day 365;
    ``fill="ffill"`` (G7, all hours kept) fills from the previous day only.

    The grid is read once, into one sum per (cell, hour, year, day); the rest
    happens on rows dealt by (cell, hour): a year becomes an array of at most
    366 days, is filled, years are added up, and the window is two passes of
    running sums along the array. Values count in units of 2^-``bits`` as
    longs, so every sum is exact whatever the order (an overflow raises).
    """
    cells = list(cells)
    h = window // 2
    key = cells + ["hour"]
    g = grid.filter(col(value).isNotNull()).select(
        *cells, F.hour("time").alias("hour"), F.year("time").alias("year"), F.dayofyear("time").alias("doy"),
        F.floor(col(value).cast("double") * float(2 ** bits) + 0.5).alias("_v"))
    if fill == "day365":
        g = g.filter(col("hour").isin(list(hours)))
    days = g.groupBy(*key, "year", "doy").agg(F.sum("_v").alias("s"), F.count(F.lit(1)).alias("c"))
    years = days.repartition(*key).groupBy(*key, "year").agg(F.collect_list(F.struct("doy", "s", "c")).alias("days"))
    last = years.agg(F.max(F.array_max(F.transform("days", lambda d: d["doy"])))).scalar()  # 366 when any leap day is present
    years = years.withColumns({"last": last, "known": F.transform("days", lambda d: d["doy"])})
    zero = F.lit(0).cast("long")
    day = lambda d, s, c: F.struct(d.alias("doy"), s.alias("s"), c.alias("c"))
    missing = F.array_except(F.sequence(F.lit(1), col("last")), col("known"))
    if fill == "day365":
        years = years.withColumn("f", F.get(F.filter("days", lambda d: d["doy"] == 365), F.lit(0)))
        more = F.transform(missing, lambda d: day(d, F.coalesce(col("f")["s"], zero), F.coalesce(col("f")["c"], zero)))
    else:
        years = years.withColumn("gaps", F.array_intersect(F.transform("days", lambda d: d["doy"] + 1), missing))
        moved = F.transform(F.filter("days", lambda d: F.array_contains("gaps", d["doy"] + 1)), lambda d: day(d["doy"] + 1, d["s"], d["c"]))
        more = F.concat(moved, F.transform(F.array_except(missing, col("gaps")), lambda d: day(d, zero, zero)))
    # every year now has every day, so the days of a cell are dense
    full = years.select(*key, F.explode(F.concat("days", more)).alias("d"))
    full = full.groupBy(*key, "d.doy").agg(F.sum("d.s").alias("s"), F.sum("d.c").alias("c"))
    series = full.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("doy", "s", "c"))).alias("a"))
    series = series.select(*key, *[F.transform("a", _unary(lambda d, n=n: d[n])).alias(n) for n in "sc"])
    series = _circular_triangle(series, "sc", h).select(*key, F.posexplode(F.arrays_zip("s", "c")))
    num, den = col("col.s"), col("col.c")
    return series.select("hour", (col("pos") + 1).alias("dayofyear"), *cells,
                         F.when(den > 0, num.cast("double") / den.cast("double") / float(2 ** bits)).alias(value))


# ------------------------------------------------------------ G3, G10-G12
def _mean(c, fixed: bool):
    """avg, or with ``fixed`` an order-independent fixed-point mean."""
    from sparklab.operators.grid import fixed_sum
    c = col(c) if isinstance(c, str) else c
    return (fixed_sum(c) / F.count(c)) if fixed else F.avg(c)


def quadratic_mean(df: DataFrame, u: str, v: str, cells, over: str = "time", fixed: bool = False) -> DataFrame:
    """Mean over ``over`` of u^2, v^2 and u*v per cell."""
    cells = list(cells)
    return df.groupBy(*cells).agg(_mean(col(u) * col(u), fixed).alias(f"{u}2"), _mean(col(v) * col(v), fixed).alias(f"{v}2"),
                                  _mean(col(u) * col(v), fixed).alias(f"{u}{v}"))


def eddy_fluxes_daily(df: DataFrame, variables=("U", "V", "T", "W"), zonal: str = "longitude",
                      keys=("time", "level", "latitude"), fixed: bool = False) -> DataFrame:
    """Zonal means and eddy fluxes uv, vt, uw, then daily means.

    The mean product of two anomalies against the zonal mean is
    ``mean(xy) - mean(x) * mean(y)``, so one partial aggregate per (time,
    level, latitude) gives means and fluxes; cells are never joined back or
    sorted. With ``fixed`` the sums are exact, so the difference is not
    blurred by rounding of the sums. A second aggregate gives daily means.
    """
    keys = list(keys)
    U, V, T, Wv = variables
    pairs = {"uv": (U, V), "vt": (V, T), "uw": (U, Wv)}
    sums = df.groupBy(*keys).agg(*[_mean(x, fixed).alias(x) for x in variables],
                                 *[_mean(col(x) * col(y), fixed).alias("_" + n) for n, (x, y) in pairs.items()])
    hourly = sums.select(*keys, *variables, *[(col("_" + n) - col(x) * col(y)).alias(n) for n, (x, y) in pairs.items()])
    rest = [k for k in keys if k != "time"]
    return hourly.groupBy(F.date_trunc("day", "time").alias("time"), *rest).agg(
        *[_mean(x, fixed).alias(x) for x in list(variables) + list(pairs)])


def group_mean(df: DataFrame, by: str, cells, value: str = "value", time: str = "time", fixed: bool = False) -> DataFrame:
    """Mean per calendar group (month, dayofyear, ...) and cell (G11, G13):
    one partially aggregated group-by; no re-chunking needed. ``fixed``: sums
    that don't depend on the order of rows."""
    fn = {"month": F.month, "dayofyear": F.dayofyear, "dayofmonth": F.dayofmonth, "hour": F.hour, "year": F.year}[by]
    return df.groupBy(fn(time).alias(by), *cells).agg(_mean(value, fixed).alias(value))


def anomalies(df: DataFrame, by: str, cells, value: str = "value", time: str = "time", fixed: bool = False) -> DataFrame:
    """``value - mean of its calendar group`` as a grid (G12): one partial aggregate
    per (cell, group), joined back; AQE splits a hot group's partition."""
    cells = list(cells)
    fn = {"month": F.month, "dayofyear": F.dayofyear, "dayofmonth": F.dayofmonth, "hour": F.hour}[by]
    means = group_mean(df, by, cells, value, time, fixed).withColumnRenamed(value, "_mean")
    return df.withColumn(by, fn(time)).join(means, [by, *cells]).select(time, *cells, (col(value) - col("_mean")).alias("anomaly"))


def anomaly_mean(df: DataFrame, by: str, cells, value: str = "value", time: str = "time", fixed: bool = False) -> DataFrame:
    """Mean over time of the anomalies per cell (G12; zero up to rounding), and of their sizes."""
    a = anomalies(df, by, cells, value, time, fixed)
    return a.groupBy(*cells).agg(_mean("anomaly", fixed).alias("anomaly_mean"), _mean(F.abs("anomaly"), fixed).alias("anomaly_size"))


# ----------------------------------------------------------------- G8
def moisture_by_month(scenes: DataFrame, cutoff: str, b08: str = "B08", b11: str = "B11", offset: int = 1000,
                      cells=("y", "x"), fixed: bool = False) -> DataFrame:
    """Moisture index (B08 - B11) / (B08 + B11) per calendar month.

    Mosaic per solar day: the first scene of the day per pixel (``row_number``
    with a limit on the map side; scenes of the same time by their bands).
    Days after ``cutoff`` are harmonised: max(band, offset) - offset.
    """
    cells = list(cells)
    s = scenes.select(F.date_trunc("day", "time").alias("day"), *cells, "time", col(b08).cast("double").alias("_8"), col(b11).cast("double").alias("_11"))
    first = Window.partitionBy("day", *cells).orderBy("time", "_8", "_11")
    mosaic = s.withColumn("_n", F.row_number().over(first)).filter(col("_n") == 1)
    new = col("day") > ts_lit(cutoff)

    def harm(c):
        return F.when(new, F.greatest(col(c), F.lit(float(offset))) - offset).otherwise(col(c))

    idx = mosaic.select("day", harm("_8").alias("_8"), harm("_11").alias("_11"))
    idx = idx.select("day", F.try_divide(col("_8") - col("_11"), col("_8") + col("_11")).alias("moisture"))
    return idx.groupBy(F.month("day").alias("month")).agg(_mean("moisture", fixed).alias("moisture"))


# ----------------------------------------------------------------- G9
def zonal_mean(grid: DataFrame, regions: DataFrame, cells=("y", "x"), value: str = "value",
               region: str = "region", fixed: bool = False) -> DataFrame:
    """Mean per (time, region id) over the cells of each region, id 0 = outside
    (G9). The raster is joined on integer cell positions (``join="override"``)."""
    cells = list(cells)
    r = regions.filter(col(region) != 0).select(*cells, region)
    return grid.join(r, cells).groupBy("time", region).agg(_mean(value, fixed).alias(value))


# ----------------------------------------------------------------- G14
def bilinear_weights(spark, src_lat0: float, src_dlat: float, src_nlat: int, src_nlon: int,
                     dst_lat0: float, dst_dlat: float, dst_nlat: int, dst_nlon: int) -> DataFrame:
    """Bilinear weights ``(dst_i, dst_j, src_i, src_j, w)`` between regular
    lat/lon grids, longitude periodic over 360 degrees (G14). Built from
    ``spark.range`` over the destination cells (its size is the weight
    matrix's, 4 rows per target); targets outside the source latitudes get none."""
    dlon_s, dlon_d = 360.0 / src_nlon, 360.0 / dst_nlon
    d = spark.range(dst_nlat * dst_nlon).select(
        (col("id") / dst_nlon).cast("int").alias("dst_i"), (col("id") % dst_nlon).cast("int").alias("dst_j"))
    d = d.withColumns({"_lat": F.lit(dst_lat0) + col("dst_i") * dst_dlat, "_lon": col("dst_j") * dlon_d})
    fi = (col("_lat") - src_lat0) / src_dlat
    fj = col("_lon") / dlon_s
    d = d.withColumns({"_i0": F.floor(fi).cast("int"), "_j0": F.floor(fj).cast("int")})
    d = d.withColumns({"_ty": fi - col("_i0"), "_tx": fj - col("_j0")})
    corners = F.explode(F.array(*[
        F.struct((col("_i0") + di).alias("src_i"), F.pmod(col("_j0") + dj, F.lit(src_nlon)).alias("src_j"),
                 ((col("_ty") if di else 1 - col("_ty")) * (col("_tx") if dj else 1 - col("_tx"))).alias("w"))
        for di in (0, 1) for dj in (0, 1)]))
    out = d.select("dst_i", "dst_j", corners.alias("_c")).select("dst_i", "dst_j", "_c.*")
    # exact-on-node targets: drop the zero-weight corner beyond the last row
    out = out.filter((col("w") > 0) | ((col("src_i") >= 0) & (col("src_i") < src_nlat)))
    inside = out.groupBy("dst_i", "dst_j").agg(
        F.min(F.when(col("w") > 0, col("src_i"))).alias("_lo"), F.max(F.when(col("w") > 0, col("src_i"))).alias("_hi"))
    inside = inside.filter((col("_lo") >= 0) & (col("_hi") < src_nlat)).select("dst_i", "dst_j")
    return out.filter(col("w") > 0).join(inside, ["dst_i", "dst_j"], "left_semi")


def regrid(df: DataFrame, weights: DataFrame, value: str = "value", keys=("time",), fixed: bool = False) -> DataFrame:
    """Apply a sparse weight matrix (G14). A target with a missing source -
    a NULL value or no row for that time - is NULL, as missing values
    propagate by default in the workload's regridder; a target of which all
    source rows are absent has no row. The full number of sources per target
    comes from the weights."""
    from sparklab.operators.grid import fixed_sum

    keys, total = list(keys), fixed_sum if fixed else F.sum
    need = weights.groupBy("dst_i", "dst_j").agg(F.count(F.lit(1)).alias("_need"))
    j = df.select(*keys, "src_i", "src_j", col(value).alias("_v")).join(weights, ["src_i", "src_j"])
    g = j.groupBy(*keys, "dst_i", "dst_j").agg(F.count("_v").alias("_n"), total(col("w") * col("_v")).alias("_s"), total(col("w")).alias("_w"))
    return g.join(need, ["dst_i", "dst_j"]).select(
        *keys, "dst_i", "dst_j", F.when(col("_n") == col("_need"), col("_s") / col("_w")).alias(value))


# ============================================================ registration
def register(reg) -> None:
    from sparklab.plans.tpch_sql import with_duckdb_ctes
    from sparklab.tables import Tables

    def sg(s, d):
        return Tables.of(s, d).memo("ship_grid", lambda t: ship_grid(t.raw("lineitem")))

    def sql(body, **extra):
        return with_duckdb_ctes(body, {"sg": SHIP_GRID_SQL, "eg4": EVENTS_GRID_SQL, **extra})

    wrows = ", ".join(f"({k}, {w})" for k, w in triangle(61))

    reg.add("climatology", lambda s, d: hourly_climatology(sg(s, d)), sql(f"""
with g as (select latitude, longitude, hour(time) as hour, year(time) as year, dayofyear(time) as doy, cast(floor(value * 1048576 + 0.5) as bigint) as v
           from sg where value is not null and hour(time) in (0, 6, 12, 18)),
L as (select max(doy) as L from g),
cells as (select distinct latitude, longitude, hour from g),
years as (select distinct year from g),
days as (select unnest(range(1, (select L from L) + 1)) as doy),
dense as (select c.latitude, c.longitude, c.hour, y.year, d.doy, g.v
          from cells c cross join years y cross join days d
          left join g on g.latitude = c.latitude and g.longitude = c.longitude and g.hour = c.hour
                     and g.year = y.year and g.doy = d.doy),
filled as (select a.latitude, a.longitude, a.hour, a.year, a.doy, coalesce(a.v, b.v) as v
           from dense a left join dense b on b.latitude = a.latitude and b.longitude = a.longitude
               and b.hour = a.hour and b.year = a.year and b.doy = 365),
w(k, w) as (values {wrows}),
contrib as (select f.latitude, f.longitude, f.hour, ((f.doy - 1 - w.k) % (select L from L) + (select L from L)) % (select L from L) + 1 as dayofyear,
                   w.w * f.v as wv, case when f.v is null then 0 else w.w end as ww
            from filled f cross join w)
select cast(hour as integer) as hour, cast(dayofyear as integer) as dayofyear, latitude, longitude,
       case when sum(ww) > 0 then cast(sum(wv) as double) / cast(sum(ww) as double) / 1048576.0 end as value
from contrib group by hour, dayofyear, latitude, longitude"""))

    reg.add("climatology_ffill",
            lambda s, d: hourly_climatology(sg(s, d), fill="ffill"), sql(f"""
with g as (select latitude, longitude, hour(time) as hour, year(time) as year, dayofyear(time) as doy, cast(floor(value * 1048576 + 0.5) as bigint) as v
           from sg where value is not null),
L as (select max(doy) as L from g),
cells as (select distinct latitude, longitude, hour from g),
years as (select distinct year from g),
days as (select unnest(range(1, (select L from L) + 1)) as doy),
dense as (select c.latitude, c.longitude, c.hour, y.year, d.doy, g.v
          from cells c cross join years y cross join days d
          left join g on g.latitude = c.latitude and g.longitude = c.longitude and g.hour = c.hour
                     and g.year = y.year and g.doy = d.doy),
filled as (select *, coalesce(v, lag(v) over (partition by latitude, longitude, hour, year order by doy)) as fv from dense),
w(k, w) as (values {wrows}),
contrib as (select f.latitude, f.longitude, f.hour, ((f.doy - 1 - w.k) % (select L from L) + (select L from L)) % (select L from L) + 1 as dayofyear,
                   w.w * f.fv as wv, case when f.fv is null then 0 else w.w end as ww
            from filled f cross join w)
select cast(hour as integer) as hour, cast(dayofyear as integer) as dayofyear, latitude, longitude,
       case when sum(ww) > 0 then cast(sum(wv) as double) / cast(sum(ww) as double) / 1048576.0 end as value
from contrib group by hour, dayofyear, latitude, longitude"""))

    def eg(s, d):
        return Tables.of(s, d).memo("events_grid", lambda t: events_grid(t.events))

    from sparklab.operators.grid import fixed_sum_sql as fs

    def fm(e):
        return f"{fs(e)} / count({e})"

    reg.add("quadratic_mean", lambda s, d: quadratic_mean(eg(s, d), "U", "V", ["level", "latitude", "longitude"], fixed=True),
            sql(f"""select level, latitude, longitude, {fm('U * U')} as U2, {fm('V * V')} as V2, {fm('U * V')} as UV
                    from eg4 group by 1, 2, 3"""))
    reg.add("eddy_fluxes", lambda s, d: eddy_fluxes_daily(eg(s, d), fixed=True), sql(f"""
with h as (select time, level, latitude, {fm('U')} as U, {fm('V')} as V, {fm('T')} as T, {fm('W')} as W,
             {fm('U * V')} - {fm('U')} * ({fm('V')}) as uv, {fm('V * T')} - {fm('V')} * ({fm('T')}) as vt,
             {fm('U * W')} - {fm('U')} * ({fm('W')}) as uw from eg4 group by 1, 2, 3)
select date_trunc('day', time) as time, level, latitude, {fm('U')} as U, {fm('V')} as V, {fm('T')} as T, {fm('W')} as W,
       {fm('uv')} as uv, {fm('vt')} as vt, {fm('uw')} as uw from h group by 1, 2, 3"""))
    reg.add("group_mean_month", lambda s, d: group_mean(sg(s, d), "month", ["latitude", "longitude"], fixed=True), sql(f"""
select cast(month(time) as integer) as month, latitude, longitude, {fm('value')} as value from sg group by 1, 2, 3"""))
    reg.add("anomaly_mean", lambda s, d: anomaly_mean(sg(s, d), "dayofmonth", ["latitude", "longitude"], fixed=True), sql(f"""
with m as (select latitude, longitude, dayofmonth(time) as dom, {fm('value')} as mean from sg group by 1, 2, 3)
select latitude, longitude, {fm('(value - mean)')} as anomaly_mean, {fm('abs(value - mean)')} as anomaly_size
from sg join m using (latitude, longitude) where dom = dayofmonth(time) group by 1, 2"""))

    def scenes(s, d):
        li = Tables.of(s, d).raw("lineitem")
        t = col("l_shipdate") + F.make_dt_interval(F.lit(0), (col("l_linenumber") % 2).cast("int"))
        return li.groupBy(t.alias("time"), (col("l_partkey") % 4).cast("int").alias("y"),
                          (col("l_suppkey") % 4).cast("int").alias("x")).agg(
            F.max(F.lit(900.0) + col("l_extendedprice") % 300).alias("B08"),
            F.min(F.lit(800.0) + col("l_quantity") * 10).alias("B11"))

    reg.add("moisture_by_month", lambda s, d: moisture_by_month(scenes(s, d), "1998-06-15", fixed=True), sql(f"""
with sc as (select l_shipdate + to_hours(cast(l_linenumber % 2 as integer)) as time, cast(l_partkey % 4 as integer) as y,
                   cast(l_suppkey % 4 as integer) as x, max(900.0 + l_extendedprice % 300) as B08,
                   min(800.0 + l_quantity * 10) as B11 from lineitem group by 1, 2, 3),
m as (select date_trunc('day', time) as day, y, x, arg_min(B08, time) as b08, arg_min(B11, time) as b11
      from sc group by 1, 2, 3),
h as (select day, case when day > timestamp '1998-06-15' then greatest(b08, 1000.0) - 1000 else b08 end as b8,
             case when day > timestamp '1998-06-15' then greatest(b11, 1000.0) - 1000 else b11 end as b11h from m)
select cast(month(day) as integer) as month, {fm('case when b8 + b11h = 0 then null else (b8 - b11h) / (b8 + b11h) end')} as moisture
from h group by 1"""))

    def zonal(s, d):
        t = Tables.of(s, d)
        grid = t.orders.groupBy(F.date_trunc("month", "o_orderdate").alias("time"),
                                (col("o_custkey") % 5).cast("int").alias("y"),
                                F.expr("cast((o_custkey div 5) % 5 as int)").alias("x")).agg(
            F.sum(col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
        regions = t.nation.select((col("n_nationkey") % 5).alias("y"), (col("n_nationkey") / 5).cast("int").alias("x"),
                                  col("n_regionkey").alias("region"))
        return zonal_mean(grid, regions, fixed=True)

    reg.add("zonal_mean", zonal, sql(f"""
with grid as (select date_trunc('month', o_orderdate) as time, cast(o_custkey % 5 as integer) as y,
                     cast((o_custkey // 5) % 5 as integer) as x,
                     cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value from orders group by 1, 2, 3),
r as (select n_nationkey % 5 as y, n_nationkey // 5 as x, n_regionkey as region from nation where n_regionkey <> 0)
select time, region, {fm('value')} as value from grid join r using (y, x) group by 1, 2"""))

    def regridded(s, d):
        li = Tables.of(s, d).raw("lineitem")
        src = li.groupBy(F.year("l_shipdate").alias("time"), (col("l_partkey") % 12).cast("int").alias("src_i"),
                         (col("l_suppkey") % 24).cast("int").alias("src_j")).agg((F.sum("l_quantity") / F.count("l_quantity")).alias("value"))
        # land: cells without a value
        src = src.withColumn("value", F.when((col("src_i") * 5 + col("src_j") * 3 + col("time")) % 11 != 0, col("value")))
        wts = bilinear_weights(s, -82.5, 15.0, 12, 24, -75.0, 30.0, 6, 12)
        return regrid(src, wts, fixed=True)

    reg.add("regrid", regridded, sql(f"""
with src as (select cast(year(l_shipdate) as integer) as time, cast(l_partkey % 12 as integer) as src_i,
                    cast(l_suppkey % 24 as integer) as src_j,
                    case when (cast(l_partkey % 12 as integer) * 5 + cast(l_suppkey % 24 as integer) * 3 + cast(year(l_shipdate) as integer)) % 11 <> 0
                      then sum(l_quantity) / count(l_quantity) end as value from lineitem group by 1, 2, 3),
d as (select cast(i as integer) as dst_i, cast(j as integer) as dst_j, -75.0 + i * 30.0 as lat, j * 30.0 as lon from range(6) t(i), range(12) u(j)),
d2 as (select *, (lat - (-82.5)) / 15.0 as fi, lon / 15.0 as fj from d),
d3 as (select *, cast(floor(fi) as integer) as i0, cast(floor(fj) as integer) as j0 from d2),
d4 as (select *, fi - i0 as ty, fj - j0 as tx from d3),
c as (select dst_i, dst_j, i0 + di as src_i, ((j0 + dj) % 24 + 24) % 24 as src_j,
             (case when di = 1 then ty else 1 - ty end) * (case when dj = 1 then tx else 1 - tx end) as w
      from d4, (values (0, 0), (0, 1), (1, 0), (1, 1)) t(di, dj)),
inside as (select dst_i, dst_j from c where w > 0 group by 1, 2 having min(src_i) >= 0 and max(src_i) < 12),
wts as (select c.* from c join inside using (dst_i, dst_j) where w > 0),
need as (select dst_i, dst_j, count(*) as n from wts group by 1, 2)
select time, dst_i, dst_j, case when count(value) = any_value(n) then {fs('w * value')} / {fs('w')} end as value
from src join wts using (src_i, src_j) join need using (dst_i, dst_j) group by 1, 2, 3"""))
