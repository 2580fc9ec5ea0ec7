"""Small helpers the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import islet

#: Functions that run in tasks travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(islet)

#: A word is a run of anything but space, tab, newline, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def enter(df: DataFrame, **roles: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns renamed ``in_0, in_1, ...`` plus one column per role.

    Operators then add columns of their own freely: no input name can clash with them,
    and Catalyst still prunes every column that the caller doesn't use. A role whose
    column is missing is all null.
    """
    names = df.columns
    flat = df.toDF(*[f"in_{i}" for i in range(len(names))])
    made = []
    for role, name in roles.items():
        at = names.index(name) if name in names else None
        made.append((F.col(f"in_{at}") if at is not None else F.lit(None)).alias(role))
    return flat.select("*", *made), names


def leave(df: DataFrame, names: list[str], out: dict[str, Column]) -> DataFrame:
    """The input's columns under their own names, then ``out``; a computed column replaces an input column of its name."""
    mine = {n.lower() for n in out}
    return df.select(*[F.col(f"in_{i}").alias(n) for i, n in enumerate(names) if n.lower() not in mine], *[c.alias(n) for n, c in out.items()])


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def scanned(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` makes of all elements before each one, as sums or maxima run, for an associative step and its zero.

    An array that grows by an element is copied each time, so elements are scanned in blocks of their number's root, whose own results are then
    scanned: an array of n copies n * sqrt(n) elements instead of n * n.
    """

    def along(part: Column) -> Column:
        start = F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out"))
        return F.aggregate(part, start, lambda a, x: F.struct(step(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))

    def whole(v: Column) -> Column:
        root = F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int")
        blocks = F.transform(F.sequence(F.lit(1), F.size(v), root), lambda s: along(F.slice(v, s, root)))
        return F.get(F.transform(F.array(blocks), join), F.lit(0))

    def join(blocks: Column) -> Column:
        before = along(F.transform(blocks, lambda b: b["at"]))["out"]
        return F.flatten(F.zip_with(blocks, before, lambda b, f: F.transform(b["out"], lambda x: step(f, x))))

    return F.get(F.transform(F.array(values), lambda v: F.when(F.size(v) == 0, F.slice(F.array(zero), 1, 0)).otherwise(whole(v))), F.lit(0))


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only where none is set and one machine does all, as in tests."""
    got = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not got:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        got = tempfile.mkdtemp(prefix="spark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got


def keep(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and reads it back: lineage ends there and no executor's loss undoes it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/islet-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``keep``, bucketed by a key: later work by that key needs no shuffle of this side. The table's files stay in the shared folder."""
    spark = df.sparkSession
    name = f"islet_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return spark.table(name)


def join_salted(many: DataFrame, one: DataFrame, keys: list[str], how: str, salts: int = 16) -> DataFrame:
    """Joins ``many`` to at most one row a key of ``one``, small against it; the rows of a hot key are dealt over ``salts`` tasks."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts))
    spread = one.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return many.withColumn("salt", salt).join(spread, [*keys, "salt"], how).drop("salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
