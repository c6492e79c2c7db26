"""Feature tables: calendar columns, lags, rolling means, scaling, splits, class balance."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizlens.operators.joins import attach, with_group_value
from bizlens.operators.scale import exact_quantiles, running, series_columns, settled

#: Minority rows whose neighbours one task searches.
CELL_ROWS = 4_000
#: Cells whose cut points are sent to every task.
BROADCAST_CELLS = 100_000


def calendar_features(df: DataFrame, date: str) -> DataFrame:
    """Day, month, year, ISO week and week day (Monday 0)."""
    return df.withColumns({
        "day": F.dayofmonth(date), "month": F.month(date), "year": F.year(date), "week": F.weekofyear(date),
        "dayofweek": F.weekday(date)})


def add_lags(
    df: DataFrame, keys: Sequence[str], order: str, column: str, lags: Sequence[int] = (1, 7), **scale
) -> DataFrame:
    """``lag_k``: the value ``k`` rows earlier in the same series."""
    return series_columns(
        df, keys, [order], max(lags), lambda w: {f"lag_{k}": F.lag(column, k).over(w) for k in lags}, **scale)


def add_rolling(
    df: DataFrame, keys: Sequence[str], order: str, column: str, sizes: Sequence[int] = (3, 7, 30), shift: int = 1,
    **scale,
) -> DataFrame:
    """``roll_n``: mean of the ``n`` rows that end ``shift`` rows before this one, null until there are ``n``.

    The default shift leaves the row's own value out.
    """
    def build(window):
        out = {}
        for n in sizes:
            frame = window.rowsBetween(-(n - 1 + shift), -shift)
            out[f"roll_{n}"] = F.when(
                F.count(column).over(frame) == n, F.sum(column).over(frame).cast("double") / F.lit(float(n)))
        return out

    return series_columns(df, keys, [order], max(sizes) - 1 + shift, build, **scale)


def fit_standardizer(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, measured on the training rows."""
    row = train.agg(*[
        f(F.col(c).cast("double")).alias(f"{n}{i}")
        for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def standardize(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """``(x - mean) / deviation``; a constant column becomes 0."""
    return df.withColumns({
        c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in scaler.items()})


def assemble(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector and numeric label, with the key columns kept."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)
    return vectors.select(*keep, "features", F.col(label).cast("double").alias("label"))


def stratified_split(
    df: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 42, spread: float = 6.0, **scale
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with the same share of every class.

    Rows are ranked in their class by the MD5 digest of ``key:seed``; the first ``ceil(test * (rows - 1))`` are the test rows, for
    any number of classes (a null label is one).  Equal keys are ordered by their other columns, so the split does not
    depend on the partitioning.

    Digests are spread evenly, so the last test row of a class lies within a few deviations of its place.  Rows below that bracket
    are counted, and only those inside it are sorted; the bracket (``spread`` deviations) grows until it holds the row.
    """
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))))
    draw = F.struct(digest.alias("a"), F.xxhash64(*df.columns).alias("b"))
    drawn = settled(df.withColumn("_draw", draw))
    part = F.conv(F.substring("_draw.a", 1, 13), 16, 10).cast("double") / F.lit(16.0**13)
    sized = with_group_value(drawn.select(label, "_draw"), label, F.count("*"), "_size", **scale)
    wanted = F.ceil(F.lit(test) * (F.col("_size") - 1))
    while True:
        margin = spread * F.sqrt(F.lit(test * (1 - test)) / F.col("_size")) + spread / F.col("_size")
        side = F.when(part < F.lit(test) - margin, -1).when(part > F.lit(test) + margin, 1).otherwise(0)
        sided = sized.withColumn("_side", side)
        counts = settled(sided.groupBy(label).agg(
            F.max("_size").alias("_rows"), F.count_if(F.col("_side") < 0).alias("_below"), F.count_if(F.col("_side") == 0).alias("_inside"),
            F.max(wanted).alias("_wanted")))
        if counts.where("_wanted > 0 and (_wanted <= _below or _wanted > _below + _inside)").isEmpty():
            break
        spread *= 2
    inside = sided.where("_side = 0").select(label, "_draw").withColumn("_place", F.row_number().over(Window.partitionBy(label).orderBy("_draw")))
    edges = inside.join(counts.withColumnRenamed(label, "_label"), F.col(label).eqNullSafe(F.col("_label")) & (F.col("_place") == F.col("_wanted") - F.col("_below")))
    last = counts.withColumnRenamed(label, "_label").join(
        edges.select(F.col(label).alias("_at"), F.col("_draw").alias("_last")), F.col("_label").eqNullSafe(F.col("_at")), "left")
    marked = attach(drawn, last.select(F.col("_label").alias(label), "_last", "_rows"), label, "_rows", **scale)
    chosen = F.coalesce(F.col("_draw") <= F.col("_last"), F.lit(False))
    return tuple(marked.where(part_).drop("_draw", "_last") for part_ in (~chosen, chosen))


def time_split(df: DataFrame, date: str, test: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Earlier rows to train, the last share by date to test; rows of one date stay together."""
    edge = exact_quantiles(df, {"d": F.unix_date(F.col(date).cast("date"))}, (1 - test,), few_values=True)["d"][0]
    if edge is None:
        return df, df.limit(0)
    cut = F.date_from_unix_date(F.lit(int(edge)))
    return df.where(F.col(date) <= cut), df.where(F.col(date) > cut)


def class_weights(df: DataFrame, label: str, into: str = "weight", **scale) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    labelled = df.where(F.col(label).isNotNull())
    sizes = labelled.groupBy(label).agg(F.count("*").alias("_n"))
    whole = sizes.agg(F.struct(F.sum("_n").alias("rows"), F.count("*").alias("classes"))).scalar()
    weight = whole["rows"].cast("double") / (whole["classes"] * F.col("_n"))
    return attach(labelled, sizes.withColumn(into, weight), label, "_n", **scale)


def _cells(points: DataFrame, features: Sequence[str], key: str, cell_rows: int) -> DataFrame:
    """Minority rows split into cells of about ``cell_rows`` by halving on the features in turn.

    Every level cuts all cells at their approximate median; equal values are dealt out by the key's hash,
    so copies of one point cannot pile up.  The cuts of a level are one number per cell, fetched and sent
    back as a literal table, so the split is a chain of map-side lookups and gives the same cells again
    when a task is repeated.
    """
    points = settled(points).withColumn("_cell", F.lit(0).cast("long"))
    rows, level = points.count(), 0
    while rows / 2**level > cell_rows:
        feature = F.col(features[level % len(features)])
        cuts = points.groupBy("_cell").agg(F.percentile_approx(feature, 0.5, 1_000).alias("_cut")).collect()
        table = points.sparkSession.createDataFrame([tuple(c) for c in cuts], "_at long, _cut double")
        half = F.when(feature > F.col("_cut"), 1).when(feature < F.col("_cut"), 0).otherwise(
            F.pmod(F.xxhash64(F.col(key), F.lit(level)), F.lit(2)))
        if len(cuts) <= BROADCAST_CELLS:
            table = F.broadcast(table)
        points = points.join(table, F.col("_cell") == F.col("_at")).withColumn(
            "_cell", F.col("_cell") * 2 + half).drop("_at", "_cut")
        level += 1
    return points


def _nearest(points: np.ndarray, of: np.ndarray, k: int, own: bool) -> list[list[tuple[float, list[float]]]]:
    """For each row of ``of`` the ``k`` nearest points with squared distances, equal distances by coordinates.

    Squares are summed feature by feature, so a distance does not depend on the rows beside it.  With ``own``, ``of`` are the
    points themselves and a row is not its own neighbour.
    """
    order = np.lexsort(points.T[::-1])
    ranked = points[order]
    place = np.argsort(order)
    reach = min(k, len(points) - own)
    near = []
    for start in range(0, len(of), 512):
        block = of[start:start + 512]
        gaps = np.zeros((len(block), len(ranked)))
        for i in range(points.shape[1]):
            gaps += (block[:, i, None] - ranked[None, :, i]) ** 2
        if own:
            gaps[np.arange(len(block)), place[start:start + len(block)]] = np.inf
        best = np.argsort(gaps, axis=1, kind="stable")[:, :reach]
        near += [[(float(row[j]), ranked[j].tolist()) for j in js] for row, js in zip(gaps, best)]
    return near


def _neighbours(celled: DataFrame, names: list[str], k: int) -> DataFrame:
    """(_key, _copies, _point, _near) of all rows of ``celled``: their ``k`` nearest other rows, whatever the cells.

    Each row finds the nearest of its cell.  It is then compared with the rows of each cell whose box lies no farther than its
    k-th distance, and the nearest of all stay.  A task holds the rows of two cells.
    """
    near = "_near array<struct<d:double,p:array<double>>>"

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_key", *names], kind="stable")
        points = pdf[names].to_numpy(float)
        return pd.DataFrame({"_cell": pdf["_cell"].to_numpy(), "_place": np.arange(len(pdf)), "_key": pdf["_key"].to_numpy(),
                             "_copies": pdf["_copies"].to_numpy(), "_point": points.tolist(), "_near": _nearest(points, points, k, True)})

    found = celled.groupBy("_cell").applyInPandas(inside, f"_cell long, _place long, _key string, _copies long, _point array<double>, {near}")
    boxes = celled.groupBy("_cell").agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(names) for n, f in (("l", F.min), ("h", F.max))]).collect()
    if len(boxes) > 1:
        found = settled(found)
        width = len(names)
        cells = [b["_cell"] for b in boxes]
        low, high = (np.array([[b[f"{n}{i}"] for i in range(width)] for b in boxes]) for n in "lh")

        def visit(batches):
            for pdf in batches:
                points = np.array(pdf["_point"].tolist(), float).reshape(-1, width)
                reach = np.array([n[-1]["d"] if len(n) == k else np.inf for n in pdf["_near"]])
                for at, lo, hi in zip(cells, low, high):
                    gap = np.zeros(len(points))
                    for i in range(width):
                        gap += np.maximum(np.maximum(lo[i] - points[:, i], points[:, i] - hi[i]), 0) ** 2
                    # k copies of a row itself can't be bettered
                    go = (gap <= reach) & (reach > 0) & (pdf["_cell"].to_numpy() != at)
                    if go.any():
                        yield pd.DataFrame({"_at": at, "_cell": pdf["_cell"][go], "_place": pdf["_place"][go], "_point": pdf["_point"][go]})

        visits = settled(found.select("_cell", "_place", "_point", "_near").mapInPandas(visit, "_at long, _cell long, _place long, _point array<double>"))
        hosts = visits.select(F.col("_at").alias("_host"), F.col("_cell").alias("_guest")).distinct().join(
            celled.select(F.col("_cell").alias("_host"), F.array(*names).alias("_point")), "_host")

        def outside(guests: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(guests):
                return pd.DataFrame({"_cell": [], "_place": [], "_near": []})
            points, of = (np.array(x["_point"].tolist(), float).reshape(-1, width) for x in (rows, guests))
            return pd.DataFrame({"_cell": guests["_cell"], "_place": guests["_place"], "_near": _nearest(points, of, k, False)})

        met = visits.groupBy("_at", "_cell").cogroup(hosts.groupBy("_host", "_guest")).applyInPandas(outside, f"_cell long, _place long, {near}")
        more = met.groupBy("_cell", "_place").agg(F.flatten(F.collect_list("_near")).alias("_more"))
        every = F.concat("_near", F.coalesce("_more", F.array().cast("array<struct<d:double,p:array<double>>>")))
        found = found.join(more, ["_cell", "_place"], "left").withColumn("_near", F.slice(F.array_sort(every), 1, k))
    return found.select("_key", "_copies", "_point", F.transform("_near", lambda x: x["p"]).alias("_near"))


def nearest_rows(df: DataFrame, features: Sequence[str], key: str, k: int = 5, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(key, place, distance) of the ``k`` nearest other rows of every row, with squared distances; the search of :func:`smote`.

    Exact at any size.  Equal rows are neighbours at distance 0; rows with a null feature have to be left out before.
    """
    names = list(features)
    rows = df.select(F.col(key).cast("string").alias("_key"), F.lit(0).cast("long").alias("_copies"), *[F.col(f).cast("double").alias(f) for f in names])
    found = _neighbours(settled(_cells(rows, names, "_key", cell_rows)), names, k)
    each = found.select("_key", "_point", F.posexplode("_near").alias("place", "_other"))
    gaps = F.zip_with("_point", "_other", lambda a, b: (a - b) * (a - b))
    return each.select(F.col("_key").cast(df.schema[key].dataType).alias(key), (F.col("place") + 1).alias("place"),
                       F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x).alias("distance"))


def smote(
    train: DataFrame, features: Sequence[str], label: str, key: str, minority=None, k: int = 5, seed: int = 42,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Adds synthetic minority rows until both classes have the same size.

    ``minority`` is the label of the smaller class, by default found by counting.
    A synthetic row lies on the line between a minority row and one of its ``k`` nearest minority rows.
    Python only finds the neighbours, cell by cell; the copies are made as column expressions, from hashes
    of the key, so a repeated task makes the same rows.
    The neighbours are exact at any size: ``cell_rows`` bounds what a task holds and does not change a row.
    Synthetic rows have a null key.
    """
    if minority is None:
        smallest = train.where(F.col(label).isNotNull()).groupBy(label).count().orderBy("count", F.desc(label)).first()
        minority = smallest[label] if smallest else 1
    sizes = train.agg(F.count_if(F.col(label) == minority).alias("few"), F.count(label).alias("all")).first()
    wanted = sizes["all"] - 2 * sizes["few"]
    if wanted <= 0 or sizes["few"] < 2:
        return train.select(key, *features, label)
    each, extra = divmod(wanted, sizes["few"])
    few = train.where(F.col(label) == minority).select(
        F.col(key).cast("string").alias("_key"), *[F.col(f).cast("double").alias(f) for f in features])
    few = few.withColumn("_draw", F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(2**52)).cast("double"))
    limit = exact_quantiles(few, {"d": "_draw"}, (extra / sizes["few"],))["d"][0]
    few = few.withColumn("_copies", F.lit(each) + F.when(F.col("_draw") < limit, 1).otherwise(0)).drop("_draw")
    names = list(features)
    found = _neighbours(settled(_cells(few, names, "_key", cell_rows)), names, k)
    made = (
        found.where("_copies > 0 AND size(_near) > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
        .withColumn("_other", F.get("_near", F.pmod(F.xxhash64("_key", "_copy", F.lit(seed)), F.size("_near")).cast("int")))
        .withColumn("_step", F.pmod(F.xxhash64("_copy", "_key", F.lit(seed + 1)), F.lit(2**52)) / F.lit(float(2**52)))
    )
    made = made.select(*[
        (F.get("_point", F.lit(i)) + F.col("_step") * (F.get("_other", F.lit(i)) - F.get("_point", F.lit(i)))).alias(n)
        for i, n in enumerate(names)])
    real = train.select(F.col(key), *[F.col(f).cast("double").alias(f) for f in names], F.col(label))
    blank = F.lit(None).cast(train.schema[key].dataType)
    return real.unionByName(made.select(
        blank.alias(key), *names, F.lit(minority).cast(train.schema[label].dataType).alias(label)))


