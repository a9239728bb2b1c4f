"""Walk-forward folds without copies of rows.

Fold k trains on the first initial + k * test rows of a user, skips a gap and
tests the next `test` rows. So a user's rows fall into blocks, the first of
`initial` rows and the others of `test`, and fold k trains on blocks 0 to k. What
a fold has to know of its training rows adds up: it is aggregated by block and
then run over the blocks, which are a fraction of the rows. Every row is shuffled
once, whatever the number of folds that train on it.
"""

from __future__ import annotations

from bisect import insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Days of a user's rows that are numbered in one window.
SPAN = 90


def numbered(df: DataFrame, order: tuple[str, ...] = ("start_at", "cycle_id")) -> DataFrame:
    """df with row_index (from 0, along `order`) and n_rows of each user. Rows
    are numbered within spans of time, and spans are offset by the counts of
    those before, so that a busy user is many windows. Rows without a time or
    user are left out."""
    time = df.schema[order[0]].dataType.typeName()
    span = F.floor(F.unix_seconds(F.col(order[0]).cast("timestamp")) / (SPAN * 86400)) if time in ("timestamp", "timestamp_ntz", "date") else F.when(F.col(order[0]).isNotNull(), F.lit(0))
    d = df.withColumn("__span", span.cast("long"))
    counts, own = d.groupBy("user_id", "__span").agg(F.count("*").alias("__c")), Window.partitionBy("user_id")
    before = F.sum("__c").over(own.orderBy("__span").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("user_id", "__span", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__c").over(own).alias("n_rows"))
    local = F.row_number().over(Window.partitionBy("user_id", "__span").orderBy(*order))
    out = d.withColumn("__local", local).join(offsets, ["user_id", "__span"])
    return out.withColumn("row_index", F.col("__local") - 1 + F.col("__before")).drop("__span", "__local", "__before")


def fold_rows(pairs: DataFrame, initial: int = 60, test: int = 14, gap: int = 1, order: tuple[str, ...] = ("start_at", "cycle_id")) -> DataFrame:
    """pairs, each row once, with row_index, block (the first fold that trains on
    it, null for none), fold (the one that tests it, null for none) and purged
    (the first fold whose gap holds it, null for none) and last_purged. Folds
    are complete and expanding; users with fewer than two have no rows."""
    if initial < 2 or test < 2 or gap < 0:
        raise ValueError("invalid walk-forward sizes")
    i = F.col("row_index")
    folds = F.floor((F.col("n_rows") - initial - gap) / test)
    at = lambda c, limit=folds: F.when((c >= 0) & (c < limit), c).cast("int")
    block = F.when(i < initial, F.lit(0)).otherwise(F.floor((i - initial) / test) + 1)
    first = F.greatest(F.lit(0), F.ceil((i - initial - gap + 1) / test))
    last = F.least(folds - 1, F.floor((i - initial) / test))
    inside = (i >= initial) & (first <= last)
    out = numbered(pairs, order).where(F.col("n_rows") >= initial + gap + 2 * test)
    return out.withColumns({"block": at(block), "fold": at(F.floor((i - initial - gap) / test)), "purged": F.when(inside, first).cast("int"), "last_purged": F.when(inside, last).cast("int")}).drop("n_rows")


def test_rows(rows: DataFrame) -> DataFrame:
    """The rows that a fold tests; each is in one fold at most."""
    return rows.where("fold is not null").drop("block", "purged", "last_purged")


def training(rows: DataFrame, **parts: tuple[str, Column]) -> DataFrame:
    """(user_id, fold, parts) over every fold's training rows: each part is the
    sum, count, min or max of a column, by block and then over the blocks."""
    blocks = rows.where("block is not null").groupBy("user_id", "block").agg(*[getattr(F, kind)(c).alias(name) for name, (kind, c) in parts.items()])
    so_far = Window.partitionBy("user_id").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    run = [getattr(F, "sum" if kind == "count" else kind)(name).over(so_far).alias(name) for name, (kind, _) in parts.items()]
    return blocks.select("user_id", F.col("block").alias("fold"), *run)


def fold_summary(rows: DataFrame) -> DataFrame:
    """(user_id, fold, role, n, first_cycle, last_cycle) of every fold's training,
    purged and test rows."""
    cycle = {"n": F.count("*"), "first_cycle": F.min("cycle_id"), "last_cycle": F.max("cycle_id")}
    by_fold = lambda df, role: df.groupBy("user_id", "fold").agg(*[c.alias(n) for n, c in cycle.items()]).withColumn("role", F.lit(role))
    train = training(rows, n=("count", F.lit(1)), first_cycle=("min", F.col("cycle_id")), last_cycle=("max", F.col("cycle_id"))).withColumn("role", F.lit("train"))
    # a row is in the gaps of gap / test folds at most
    purged = rows.where("purged is not null").withColumn("fold", F.explode(F.sequence("purged", "last_purged")))
    names = ["user_id", "fold", "role", *cycle]
    return train.select(*names).unionByName(by_fold(purged, "purged").select(*names)).unionByName(by_fold(test_rows(rows), "test").select(*names))


def leaking_folds(rows: DataFrame) -> DataFrame:
    """Folds in which a training label is not older than every test origin."""
    origin = test_rows(rows).groupBy("user_id", "fold").agg(F.min("start_at").alias("first_origin"))
    return training(rows, last_label=("max", F.col("target_start_at"))).join(origin, ["user_id", "fold"]).where("last_label >= first_origin")


def fold_status(rows: DataFrame) -> DataFrame:
    """Whether a fold's training rows hold both classes; others are skipped."""
    y = F.col("low_recovery")
    ends = training(rows, lo=("min", y), hi=("max", y))
    return ends.select("user_id", "fold", F.when(F.col("lo").isNull(), 0).when(F.col("lo") == F.col("hi"), 1).otherwise(2).alias("classes")).withColumn("skipped", F.col("classes") < 2)


def values(features: tuple[str, ...]) -> list[Column]:
    """The features as doubles, NaN as null."""
    return [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]


def running_medians(rows: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """(user_id, fold, medians) of every fold's training rows, exact; 0 for a
    feature without values. A user's rows stream by in their order, once; one
    user's sorted values are held at a time."""
    schema = T.StructType([rows.schema["user_id"], T.StructField("fold", T.IntegerType()), T.StructField("medians", T.ArrayType(T.DoubleType()))])

    def middle(v: list[float]) -> float:
        n = len(v)
        return (v[n // 2] + v[(n - 1) // 2]) / 2 if n else 0.0

    def run(batches):
        key, held, out = None, [], ([], [], [])

        def close():
            for column, x in zip(out, (*key, [middle(v) for v in held])):
                column.append(x)

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=[f.name for f in schema])

        kinds = [None, pa.int32(), pa.list_(pa.float64())]
        for b in batches:
            kinds[0] = b.schema.field(0).type
            user, block, *columns = [c.to_pylist() for c in b.columns]
            for i, now in enumerate(zip(user, block)):
                if now != key:
                    if key is not None:
                        close()
                    if key is None or now[0] != key[0]:
                        held = [[] for _ in features]
                    key = now
                for v, c in zip(held, columns):
                    if c[i] is not None:
                        insort(v, c[i])
            if out[0]:
                yield batch()
                out = ([], [], [])
        if key is not None:
            close()
            yield batch()

    ordered = rows.where("block is not null").select("user_id", "block", "row_index", *[v.alias(f"__x{i}") for i, v in enumerate(values(features))])
    return ordered.repartition("user_id").sortWithinPartitions("user_id", "row_index").drop("row_index").mapInArrow(run, schema)


def _products(rows: DataFrame, features: tuple[str, ...], target: str, keep: list[str]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """keep, centre (the user's means), and e: the features and target counted
    from there (0 where missing), the marks of missing features, and 1."""
    x, y = values(features), F.col(target).cast("double")
    centre = rows.groupBy("user_id").agg(F.array(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in [*x, y]]).alias("centre"))
    away = [c - F.col("centre")[i] for i, c in enumerate([*x, y])]
    e = [*[F.coalesce(c, F.lit(0.0)) for c in away[:-1]], *[c.isNull().cast("double") for c in x], away[-1], F.lit(1.0)]
    d = rows.join(centre, "user_id").select(*keep, "centre", F.array(*e).alias("e"))
    return d, [(i, j) for i in range(len(e)) for j in range(i, len(e))]


def running_products(rows: DataFrame, features: tuple[str, ...], target: str = "target") -> DataFrame:
    """(user_id, fold, centre, sums): sums of the products of each two of the
    features (0 where missing), the marks of missing ones, the target and 1, as an
    upper triangle by rows; features and target are counted from the user's
    means (centre), so that sums keep their digits."""
    d, pairs = _products(rows, features, target, ["user_id", "block"])
    out = training(d, centre=("max", F.col("centre")), **{f"s{i}_{j}": ("sum", F.col("e")[i] * F.col("e")[j]) for i, j in pairs})
    return out.select("user_id", "fold", "centre", F.array(*[f"s{i}_{j}" for i, j in pairs]).alias("sums"))


def sliding_products(pairs: DataFrame, features: tuple[str, ...], days: int = 90, target: str = "target") -> DataFrame:
    """running_products of every pair's last `days` days of earlier pairs, whose
    labels are known when it starts: (user_id, cycle_id, centre, sums). What has
    left the window is subtracted from the sum of all before, so that a pair is
    added once and taken away once, however long the window."""
    d, products = _products(pairs.withColumn("__at", F.unix_seconds(F.col("start_at").cast("timestamp"))), features, target, ["user_id", "cycle_id", "__at"])
    along, span = Window.partitionBy("user_id").orderBy("__at"), days * 86400
    until = along.rangeBetween(Window.unboundedPreceding, -1)
    gone = along.rangeBetween(Window.unboundedPreceding, -span - 1)
    sums = [F.coalesce(F.sum(F.col("e")[i] * F.col("e")[j]).over(until), F.lit(0.0)) - F.coalesce(F.sum(F.col("e")[i] * F.col("e")[j]).over(gone), F.lit(0.0)) for i, j in products]
    return d.select("user_id", "cycle_id", "centre", F.array(*sums).alias("sums"))
