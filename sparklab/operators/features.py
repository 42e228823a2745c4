"""Feature preparation and model search (F1-F6) with built-in expressions
and MLlib (re-aimed from gradient-boosting libraries to ``pyspark.ml``)."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklab.operators.relational import join_small, map_values, remove_outliers

col = F.col

# Borough -> super-borough mapping of the trip workload.
BOROUGH_MAPPING = {
    "Manhattan": "Superborough 1",
    "Bronx": "Superborough 1",
    "EWR": "Superborough 1",
    "Brooklyn": "Superborough 2",
    "Queens": "Superborough 2",
    "Staten Island": "Superborough 3",
    "Unknown": "Unknown",
}

# The categorical columns of the trip table.
TRIP_CATEGORIES = ["hvfhs_license_num", "PULocationID", "DOLocationID", "wav_request_flag", "accessible_vehicle",
                   "pickup_month", "pickup_dow", "pickup_hour", "PUBorough", "DOBorough",
                   "PUSuperborough_DOSuperborough"]


def zone_lookup(zones: DataFrame, mapping: dict | None = None, borough: str = "Borough") -> DataFrame:
    """Zone table ``(LocationID, Borough, Superborough)``."""
    z = zones.select("LocationID", borough)
    return map_values(z, borough, mapping or BOROUGH_MAPPING, out="Superborough")


def trip_features(trips: DataFrame, zones: DataFrame, exact_quantile: bool = False) -> DataFrame:
    """Trip table -> model features (F1): accessibility flag, pickup
    month / day-of-week (Monday = 0) / hour, 'None' airport fee -> 0, rows
    with any NULL dropped, trip_time outliers cut (P9), both zone lookups
    (joined without a hint), super-borough pair."""
    d = trips.withColumns({
        "accessible_vehicle": col("on_scene_datetime").isNull(),
        "pickup_month": F.month("pickup_datetime"),
        "pickup_dow": F.weekday("pickup_datetime"),
        "pickup_hour": F.hour("pickup_datetime"),
        "airport_fee": F.coalesce(F.when(col("airport_fee") == "None", F.lit("0")).otherwise(col("airport_fee"))
                                  .try_cast("double"), F.lit(0.0)),
    }).drop("on_scene_datetime", "pickup_datetime")
    d = d.na.drop("any")
    d = remove_outliers(d, "trip_time", lower=0.0, exact=exact_quantile)
    pu = zones.select(col("LocationID").alias("PULocationID"), col("Borough").alias("PUBorough"),
                      col("Superborough").alias("PUSuperborough"))
    do = zones.select(col("LocationID").alias("DOLocationID"), col("Borough").alias("DOBorough"),
                      col("Superborough").alias("DOSuperborough"))
    d = join_small(d, pu, "PULocationID")
    d = join_small(d, do, "DOLocationID")
    d = d.withColumn("PUSuperborough_DOSuperborough", F.concat_ws("-", "PUSuperborough", "DOSuperborough"))
    return d.drop("PUSuperborough", "DOSuperborough")


#: a dictionary column of at most so many bytes is broadcast; larger ones are joined without a hint
BROADCAST_BYTES = 8 << 20


#: the dictionary has one column per kind of value
FIELDS = {"l": "long", "d": "double", "m": "decimal(38,18)", "s": "string"}


def _field(df: DataFrame, c: str) -> tuple[str, Column]:
    """The dictionary's field for a column, and its value there, in the value's own order."""
    kind, v = df.schema[c].dataType.typeName(), col(c)
    whole = {"boolean": lambda: v.cast("int"), "date": lambda: F.unix_date(v), "timestamp": lambda: F.unix_micros(v),
             "timestamp_ntz": lambda: F.unix_micros(v.cast("timestamp"))}
    field = {"float": "d", "double": "d", "decimal": "m", "string": "s", **dict.fromkeys(["byte", "short", "integer", "long", *whole], "l")}.get(kind)
    if field is None:
        raise ValueError(f"{c} is of type {kind}, which has no dictionary")
    return field, whole.get(kind, lambda: v)().cast(FIELDS[field])


def dictionary(df: DataFrame, cols) -> DataFrame:
    """Codes of the values of all ``cols``: (column, l, d, m, s, code), from one pass over ``df`` and one ranking.

    The distinct (column, value) pairs are combined on the map side; the ranking is a range-partitioned sort
    (:func:`relational.rank_within_groups`, one checkpoint), so no column's values meet in one task."""
    from sparklab.operators.relational import rank_within_groups

    def pair(i, c):
        field, v = _field(df, c)
        return F.struct(F.lit(i).alias("column"), *[(v if n == field else F.lit(None).cast(t)).alias(n) for n, t in FIELDS.items()])

    pairs = F.explode(F.array(*[pair(i, c) for i, c in enumerate(cols)])).alias("v")
    found = df.select(pairs).select("v.*").where(" OR ".join(f"{n} IS NOT NULL" for n in FIELDS)).distinct()
    return rank_within_groups(found, "column", ["l", "d", "m", "s"], name="code").withColumn("code", col("code").cast("int"))


def categorize(df: DataFrame, cols, suffix: str = "_code") -> DataFrame:
    """Global dictionary codes per column (F4): code = rank of the value
    among the column's sorted distinct values (numbers numerically, strings
    by bytes), 0-based; NULL has no code. The dictionary of all columns comes
    from one pass (:func:`dictionary`); the encoding is one pass too, as the
    columns whose part of it is small - checked - are looked up in broadcasts."""
    from sparklab.session import cut_lineage

    cols = list(cols)
    if not cols:
        return df
    codes = cut_lineage(dictionary(df, cols))
    sizes = {r["column"]: r["bytes"] for r in codes.groupBy("column").agg(F.sum(F.coalesce(F.octet_length("s"), F.lit(0)) + 48).alias("bytes")).collect()}
    out = df
    for i, c in enumerate(cols):
        field, v = _field(df, c)
        part = codes.where(col("column") == i).select(col(field).alias("_k"), col("code").alias(c + suffix))
        if sizes.get(i, 0) <= BROADCAST_BYTES:
            part = F.broadcast(part)
        out = out.withColumn("_v", v).join(part, col("_v") == col("_k"), "left").drop("_v", "_k")
    return out


def float32_columns(df: DataFrame) -> DataFrame:
    """double -> float for every double column."""
    return df.select(*[col(f.name).cast("float").alias(f.name) if f.dataType.typeName() == "double" else col(f.name)
                       for f in df.schema.fields])


# ------------------------------------------------------------- models
def _assemble(df: DataFrame, features, label: str):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector

    if isinstance(features, str):  # an array column
        return df.select(array_to_vector(col(features)).alias("features"), col(label).cast("double").alias("label"))
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return va.transform(df).select("features", col(label).cast("double").alias("label"))


#: bins of a feature: what the trees tell apart (``maxBins`` of the model)
BINS = 32


def bin_stages(df: DataFrame, features) -> list:
    """Stages that put ``features`` into at most ``BINS`` bins each and assemble their numbers.

    The cuts are quantiles of all rows of ``df``, from one pass (rank error 1/1000 of the rows)."""
    from pyspark.ml.feature import Bucketizer, VectorAssembler

    inf = float("inf")
    cuts = df.select(*[col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)]).approxQuantile(
        [f"_{i}" for i in range(len(features))], [k / BINS for k in range(1, BINS)], 0.001)
    splits = [[-inf, *(sorted({c for c in q if abs(c) < inf}) or [0.0]), inf] for q in cuts]
    binned = [f"_bin{i}" for i in range(len(features))]
    return [Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=binned, handleInvalid="skip"),
            VectorAssembler(inputCols=binned, outputCol="features")]


def _label(label: str) -> Column:
    """The label as double; as in the models, NULL, NaN and infinity are errors."""
    y = col(label).cast("double")
    return F.when(y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")), F.raise_error(F.lit("Labels MUST NOT be NULL, NaN or infinite")).cast("double")).otherwise(y)


def bin_cells(df: DataFrame, stages, label: str, *keys: str) -> DataFrame:
    """One row per key and combination of bins: ``weight`` (rows), ``label`` (mean) and ``spread`` (sum of squares about it).

    Trees on binned features can't tell the rows of a cell apart, and splits by squared error depend on number and mean
    of the rows only, so weighted cells give the trees that all rows give. There are at most as many cells as rows, and
    as combinations of bins, however many rows there are."""
    from sparklab.session import cut_lineage

    binner, assembler = stages
    d = df.select(*keys, *[col(c).cast("double").alias(c) for c in binner.getInputCols()], _label(label).alias("_y"))
    cells = binner.transform(d).groupBy(*keys, *binner.getOutputCols()).agg(
        F.count("_y").cast("double").alias("weight"), F.avg("_y").alias("label"), (F.var_pop("_y") * F.count("_y")).alias("spread"))
    # every pass of a model reads them: written once
    return cut_lineage(assembler.transform(cells).select(*keys, "features", "weight", "label", "spread"))


def train_gbt(train: DataFrame, features, label: str, test: DataFrame | None = None, max_iter: int = 20,
              max_depth: int = 4, step_size: float = 0.1, seed: int = 42):
    """Gradient-boosted regression trees (F5). Returns ``(model, predictions,
    rmse)`` where predictions/rmse are on ``test`` (or ``train``).

    With a list of ``features`` all training rows are put into weighted cells first (:func:`bin_cells`), on which the
    trees are grown; the model then has the binning as its first stages. An array column is taken as it is."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor

    gbt = GBTRegressor(maxIter=max_iter, maxDepth=max_depth, stepSize=step_size, seed=seed, checkpointInterval=10)
    rows = test if test is not None else train
    if isinstance(features, str):
        model = gbt.fit(_assemble(train, features, label))
        pred = model.transform(_assemble(rows, features, label))
    else:
        stages = bin_stages(train, features)
        model = PipelineModel([*stages, gbt.setWeightCol("weight").fit(bin_cells(train, stages, label))])
        pred = model.transform(rows.select(*features, col(label).cast("double").alias("_y"))).select("features", col("_y").alias("label"), "prediction")
    rmse = RegressionEvaluator(metricName="rmse").evaluate(pred)
    return model, pred, rmse


def trials_of(n: int, seed: int) -> list[tuple[int, float, int]]:
    """``n`` seeded random settings of (depth, step, iterations)."""
    rng = random.Random(seed)
    return [(rng.randint(2, 6), round(rng.uniform(0.05, 0.3), 3), rng.randint(5, 15)) for _ in range(n)]


def fold_scores(train: DataFrame, features, label: str, key, n_trials: int = 4, folds: int = 3, seed: int = 2, parallelism: int = 4) -> DataFrame:
    """Hyper-parameter search with k-fold scoring (F6): one row per setting and fold.

    A row's fold is a hash of ``key`` and the seed, so it is the same on every run. Each setting is fitted on all other
    folds and scored on the fold it has not seen: ``n`` rows, ``mse`` of the model, and ``mean_mse``, the error of the
    other folds' mean label, from one exact aggregate. ``parallelism`` fits (each a distributed job) run at a time.
    Rows with a NULL label are left out.

    With a list of ``features`` all rows are put into weighted cells of a fold once (:func:`bin_cells`; the bins' cuts
    are those of all rows, no label has a part in them). Fits read cells, and a fold's error is the exact sum over its
    rows, from their number, mean and spread per cell.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.regression import GBTRegressor

    from sparklab.operators.grid import fixed_sum
    from sparklab.operators.relational import hash_bucket

    spark = train.sparkSession
    d = train.where(col(label).isNotNull()).withColumn("_fold", F.coalesce(hash_bucket(key, seed, folds, portable=True), F.lit(0)).cast("int"))
    sums = {r["_fold"]: (r["n"], r["s"], r["q"]) for r in d.groupBy("_fold").agg(
        F.count(F.lit(1)).alias("n"), fixed_sum(label).alias("s"), fixed_sum(col(label) * col(label)).alias("q")).collect()}

    def mean_error(k):
        n, s, q = sums[k]
        mean = sum(v[1] for f, v in sorted(sums.items()) if f != k) / sum(v[0] for f, v in sums.items() if f != k)
        return (q - 2 * mean * s + n * mean * mean) / n

    if not isinstance(features, str):
        cells = bin_cells(d, bin_stages(d, features), label, "_fold")

    def score(job):
        (trial, (depth, step, iterations)), k = job
        gbt = GBTRegressor(seed=seed, checkpointInterval=10, maxDepth=depth, stepSize=step, maxIter=iterations)
        err = col("prediction") - col("label")
        if isinstance(features, str):
            model = gbt.fit(_assemble(d.where(col("_fold") != k), features, label))
            mse = model.transform(_assemble(d.where(col("_fold") == k), features, label)).agg(F.avg(err * err))
        else:
            model = gbt.setWeightCol("weight").fit(cells.where(col("_fold") != k))
            mse = model.transform(cells.where(col("_fold") == k)).agg(F.sum(err * err * col("weight") + col("spread")) / F.sum("weight"))
        return trial, depth, step, iterations, k, sums[k][0], float(mse.first()[0]), mean_error(k)

    jobs = [(t, k) for t in enumerate(trials_of(n_trials, seed)) for k in sorted(sums) if len(sums) > 1]
    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(score, jobs))
    return spark.createDataFrame(rows, "trial int, max_depth int, step_size double, max_iter int, fold int, n long, mse double, mean_mse double")


def search(train: DataFrame, features, label: str, key=None, n_trials: int = 4, folds: int = 3, seed: int = 2,
           parallelism: int = 4) -> DataFrame:
    """Settings of :func:`fold_scores` with their error over all folds: ``(trial, max_depth, step_size, max_iter, rmse)``.
    ``key`` names the columns that tell rows apart (default: features and label)."""
    key = list(key or [*([features] if isinstance(features, str) else features), label])
    scores = fold_scores(train, features, label, key, n_trials, folds, seed, parallelism)
    return scores.groupBy("trial", "max_depth", "step_size", "max_iter").agg(F.sqrt(F.sum(col("mse") * col("n")) / F.sum("n")).alias("rmse"))


# ============================================================ registration
def _trips(t):
    e = t.events
    return e.select(
        col("event_type").alias("hvfhs_license_num"),
        (col("user_id") % 25).cast("int").alias("PULocationID"),
        (col("event_id") % 25).cast("int").alias("DOLocationID"),
        (col("value") / 10).alias("trip_miles"),
        col("value").alias("trip_time"),
        F.lit(0.0).alias("tolls"),
        F.when(col("event_id") % 37 == 0, F.lit(None).cast("double")).otherwise(F.lit(2.75)).alias("congestion_surcharge"),
        F.when(col("event_id") % 3 == 0, F.lit("None")).otherwise((col("event_id") % 5).cast("string")).alias("airport_fee"),
        F.when(col("event_id") % 2 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("wav_request_flag"),
        F.when(col("event_id") % 4 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(col("ts")).alias("on_scene_datetime"),
        col("ts").alias("pickup_datetime"),
    )


# Region -> super-borough for the fixture zone table.
REGION_MAPPING = {"AFRICA": "Superborough 1", "AMERICA": "Superborough 1", "ASIA": "Superborough 2",
                  "EUROPE": "Superborough 2", "MIDDLE EAST": "Superborough 3"}


def _zones(t):
    n = t.nation.join(F.broadcast(t.region), col("n_regionkey") == col("r_regionkey"))
    z = n.select(col("n_nationkey").alias("LocationID"), col("n_name").alias("Borough"), col("r_name").alias("_r"))
    return map_values(z, "_r", REGION_MAPPING, out="Superborough").drop("_r")


TRIPS_SQL = """trips as (select event_type as hvfhs_license_num, cast(user_id % 25 as integer) as PULocationID,
    cast(event_id % 25 as integer) as DOLocationID, value / 10 as trip_miles, value as trip_time, cast(0.0 as double) as tolls,
    case when event_id % 37 = 0 then null else cast(2.75 as double) end as congestion_surcharge,
    case when event_id % 3 = 0 then 'None' else cast(event_id % 5 as varchar) end as airport_fee,
    case when event_id % 2 = 0 then 'Y' else 'N' end as wav_request_flag,
    case when event_id % 4 = 0 then null else ts end as on_scene_datetime, ts as pickup_datetime from events)"""
ZONES_SQL = """zones as (select n_nationkey as LocationID, n_name as Borough,
    case r_name when 'AFRICA' then 'Superborough 1' when 'AMERICA' then 'Superborough 1'
      when 'ASIA' then 'Superborough 2' when 'EUROPE' then 'Superborough 2' when 'MIDDLE EAST' then 'Superborough 3'
      else r_name end as Superborough from nation join region on n_regionkey = r_regionkey)"""
FEATURES_SQL = """feat as (select hvfhs_license_num, PULocationID, DOLocationID, trip_miles, trip_time, tolls,
    congestion_surcharge, coalesce(try_cast(case when airport_fee = 'None' then '0' else airport_fee end as double), 0.0)
      as airport_fee, wav_request_flag, on_scene_datetime is null as accessible_vehicle,
    cast(month(pickup_datetime) as integer) as pickup_month, cast(isodow(pickup_datetime) - 1 as integer) as pickup_dow,
    cast(hour(pickup_datetime) as integer) as pickup_hour from trips),
nn as (select * from feat where congestion_surcharge is not null and hvfhs_license_num is not null
       and trip_miles is not null and trip_time is not null),
cut as (select * from nn where trip_time >= 0 and trip_time <= (select quantile_cont(trip_time, 0.75) * 2.5 from nn)),
tf as (select cut.*, pu.Borough as PUBorough, dz.Borough as DOBorough,
       pu.Superborough || '-' || dz.Superborough as PUSuperborough_DOSuperborough
       from cut join zones pu on cut.PULocationID = pu.LocationID join zones dz on cut.DOLocationID = dz.LocationID)"""


def register(reg) -> None:
    from sparklab.plans.tpch_sql import with_duckdb_ctes
    from sparklab.tables import Tables

    ctes = {"trips": TRIPS_SQL, "zones": ZONES_SQL, "tf": FEATURES_SQL}

    def feats(s, d):
        t = Tables.of(s, d)
        return trip_features(_trips(t), _zones(t), exact_quantile=True)

    cols = ["hvfhs_license_num", "PULocationID", "DOLocationID", "trip_miles", "trip_time", "tolls",
            "congestion_surcharge", "airport_fee", "wav_request_flag", "accessible_vehicle", "pickup_month",
            "pickup_dow", "pickup_hour", "PUBorough", "DOBorough", "PUSuperborough_DOSuperborough"]
    reg.add("trip_features", lambda s, d: feats(s, d).select(*cols),
            with_duckdb_ctes(f"select {', '.join(cols)} from tf", ctes))
    nums = ["trip_miles", "trip_time", "tolls", "congestion_surcharge", "airport_fee"]
    reg.add("float32_features", lambda s, d: float32_columns(feats(s, d).select("PULocationID", *nums)),
            with_duckdb_ctes("select PULocationID, " + ", ".join(f"cast({c} as float) as {c}" for c in nums) + " from tf",
                             ctes))
    cats = TRIP_CATEGORIES
    reg.add("categorize", lambda s, d: categorize(feats(s, d).select(*cats), cats), with_duckdb_ctes(
        f"select {', '.join(cats)}, " + ", ".join(
            f"cast(dense_rank() over (order by {c}) - 1 as integer) as {c}_code" for c in cats) + " from tf", ctes))

    model_cols = ["l_quantity", "l_discount", "l_tax", "l_partkey", "l_linenumber"]

    def model_table(s, d):
        # the fixtures' prices are random; the target is derived from the table
        li = Tables.of(s, d).raw("lineitem")
        return li.select("l_orderkey", *model_cols, (col("l_quantity") * (1 - col("l_discount"))).alias("net_qty"))

    def gbt(s, d):
        """Quality facts of the model on the held-out part: rows, and whether it beats the mean predictor."""
        from sparklab.operators.relational import hash_split
        tr, te = hash_split(model_table(s, d), ["l_orderkey", "l_linenumber", "l_partkey"], [0.8, 0.2], seed=42, portable=True)
        _, pred, _ = train_gbt(tr, model_cols, "net_qty", te)
        err = col("prediction") - col("label")
        return pred.agg(F.count("prediction").alias("n"), (F.avg(err * err) < 0.25 * F.var_pop("label")).alias("beats_mean"))

    reg.add("gbt_predictions", gbt, """
select count(*) as n, true as beats_mean from lineitem where cast('0x' || substr(md5(cast(l_orderkey as varchar) || '|' ||
  cast(l_linenumber as varchar) || '|' || cast(l_partkey as varchar) || '-42'), 1, 8) as bigint) % 10000 >= 8000""")

    def scores(s, d):
        """Per setting and fold: the fold's rows, the mean predictor's error there, and whether the model is well below it."""
        r = fold_scores(model_table(s, d), model_cols, "net_qty", ["l_orderkey", "l_linenumber", "l_partkey"])
        return r.select("trial", "fold", "n", "mean_mse", (col("mse") < 0.64 * col("mean_mse")).alias("below"))

    from sparklab.operators.grid import fixed_sum_sql as fs

    reg.add("search_scores", scores, f"""
with t as (select l_quantity * (1 - l_discount) as y, cast('0x' || substr(md5(cast(l_orderkey as varchar) || '|' ||
    cast(l_linenumber as varchar) || '|' || cast(l_partkey as varchar) || '-2'), 1, 8) as bigint) % 3 as fold from lineitem),
f as (select fold, count(*) as n, {fs('y')} as s, {fs('y * y')} as q from t group by fold),
m as (select a.fold, a.n, a.s, a.q, sum(b.s order by b.fold) / sum(b.n) as mean from f a join f b on a.fold <> b.fold group by 1, 2, 3, 4)
select cast(trial as integer) as trial, cast(fold as integer) as fold, n, (q - 2 * mean * s + n * mean * mean) / n as mean_mse, true as below
from m, range(4) as r(trial)""")
