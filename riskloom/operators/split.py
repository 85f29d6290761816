"""Splitting by entity, checking the split, and weighting classes."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import percent
from riskloom.schemas import ENTITY_KEY, LABEL, SPLIT_SEED, TEST_RATIO, TRAIN_RATIO
from riskloom.session import scratch_path
from riskloom.sources.sinks import written

_BUCKETS = 100


def entity_bucket(key: str, seed: int = SPLIT_SEED, buckets: int = _BUCKETS) -> Column:
    """A number below ``buckets`` that depends on the key and the seed only."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def split_part(
    key: str = ENTITY_KEY,
    train_ratio: float = TRAIN_RATIO,
    test_ratio: float = TEST_RATIO,
    seed: int = SPLIT_SEED,
    buckets: int = _BUCKETS,
) -> Column:
    """``train`` or ``test``. Use more buckets for ratios finer than one percent."""
    cut = round(train_ratio / (train_ratio + test_ratio) * buckets)
    return F.when(entity_bucket(key, seed, buckets) < cut, "train").otherwise("test")


def prepare_train_test_split(
    df: DataFrame,
    train_ratio: float = TRAIN_RATIO,
    test_ratio: float = TEST_RATIO,
    seed: int = SPLIT_SEED,
    key: str = ENTITY_KEY,
    method: str = "hash",
    buckets: int = _BUCKETS,
) -> tuple[DataFrame, DataFrame]:
    """Split rows so that all rows of an entity land on the same side.

    ``hash`` decides from the key alone: two filters, no shuffle, the same answer
    however the data is partitioned, and parts of about the wanted sizes. ``random``
    gives the training part exactly its share of the distinct entities (see
    ``exact_cut``); after the cut is found it is two filters as well.
    """
    if method == "hash":
        part = split_part(key, train_ratio, test_ratio, seed, buckets)
        return df.filter(part == "train"), df.filter(part == "test")
    if method != "random":
        raise ValueError(f"unknown split method {method!r}; use 'hash' or 'random'")
    part = exact_split_part(df, key, train_ratio, test_ratio, seed)
    return df.filter(part == "train"), df.filter(part == "test")


def _place(key: str, seed: int) -> Column:
    """A number of 60 bits that depends on the key and the seed only."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def exact_cut(df: DataFrame, key: str, share: float, seed: int = SPLIT_SEED, bits: int = 12, few: int = 4096) -> tuple[int, str] | None:
    """The last of ``floor(share * n + 1/2)`` entities in the order of their seeded hash, as hash and key; None for none.

    The order statistic is found by narrowing: entities are counted per range of hashes (2^bits
    ranges), and the range that holds the wanted rank is cut into ranges again, until it holds few
    entities. Only counts and those few reach the driver, and the answer hangs on keys alone.
    """
    hashed = distinct_entities(df, key).select(_place(key, seed).alias("place"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"))
    entities = written(hashed, scratch_path(df.sparkSession, "entities"))
    wanted, low, width = math.floor(share * entities.count() + 0.5), 0, 60
    if not wanted:
        return None
    while width:
        width -= bits
        held = entities.filter(F.col("place").between(low, low + (1 << width + bits) - 1))
        ranges = held.groupBy(F.shiftright(F.col("place") - low, width).alias("r")).agg(F.count(F.lit(1)).alias("n"))
        for r, n in sorted(tuple(row) for row in ranges.collect()):
            if wanted <= n:
                low += r << width
                break
            wanted -= n
        if n <= few:
            break
    last = entities.filter(F.col("place").between(low, low + (1 << width) - 1)).orderBy("place", "name").limit(wanted).collect()[-1]
    return last["place"], last["name"]


def exact_split_part(
    df: DataFrame, key: str = ENTITY_KEY, train_ratio: float = TRAIN_RATIO, test_ratio: float = TEST_RATIO, seed: int = SPLIT_SEED
) -> Column:
    """``train`` for exactly the training share of the entities in ``df``, else ``test``."""
    cut = exact_cut(df, key, train_ratio / (train_ratio + test_ratio), seed)
    if cut is None:
        return F.lit("test")
    place, name = _place(key, seed), F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.when((place < cut[0]) | ((place == cut[0]) & (name <= cut[1])), "train").otherwise("test")


def distinct_entities(df: DataFrame, key: str = ENTITY_KEY) -> DataFrame:
    return df.select(key).distinct()


def keep_entities(df: DataFrame, entities: DataFrame, key: str = ENTITY_KEY) -> DataFrame:
    """Rows whose entity is in the given set.

    The set is made distinct first, so that an entity with many rows counts once. Rows
    without a key are one entity, so a NULL in the set keeps them.
    """
    wanted = distinct_entities(entities, key).withColumnRenamed(key, "_entity")
    return df.join(wanted, F.col(key).eqNullSafe(F.col("_entity")), "left_semi")


def split_report(df: DataFrame, key: str = ENTITY_KEY, part: Column | None = None) -> DataFrame:
    """Visits, entities and share of visits per part of the hash split."""
    part = split_part(key) if part is None else part
    counted = df.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("visits"), F.count_distinct(key).alias("entities")
    )
    total = F.sum("visits").over(Window.partitionBy())
    return counted.select("part", "visits", "entities", percent(F.col("visits"), total).alias("visits_pct"))


def entity_overlap(train: DataFrame, test: DataFrame, key: str = ENTITY_KEY) -> DataFrame:
    """One row: entities per side, entities on both sides, and whether there are none of those.

    One shuffle: each side is reduced to its entities before it moves.
    """
    sides = train.select(key, F.lit(1).alias("_train"), F.lit(0).alias("_test")).unionByName(
        test.select(key, F.lit(0).alias("_train"), F.lit(1).alias("_test"))
    )
    per_entity = sides.groupBy(key).agg(F.max("_train").alias("_train"), F.max("_test").alias("_test"))
    return per_entity.agg(
        F.count_if(F.col("_train") == 1).alias("train_entities"),
        F.count_if(F.col("_test") == 1).alias("test_entities"),
        F.count_if((F.col("_train") == 1) & (F.col("_test") == 1)).alias("overlap"),
    ).withColumn("passed", F.col("overlap") == 0)


def validate_data_leakage_prevention(
    train: DataFrame, test: DataFrame, key: str = ENTITY_KEY
) -> bool:
    """Whether no entity is on both sides."""
    return entity_overlap(train, test, key).first()["passed"]


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Count and percentage per class; the share of class 1 is the base rate of a PR curve."""
    total = F.sum("n").over(Window.partitionBy())
    return class_counts(df, label).withColumn("pct", percent(F.col("n"), total))


def base_rate(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("base_rate"))


def class_weight_table(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight per class, rows / (classes * rows of the class), for any number of classes."""
    over_all = Window.partitionBy()
    balanced = F.sum("n").over(over_all) / (F.count(F.lit(1)).over(over_all) * F.col("n"))
    return class_counts(df.filter(F.col(label).isNotNull()), label).withColumn("weight", balanced)


def class_weights(counts: Mapping[int, int], label: str = LABEL) -> tuple[float, float]:
    """Balanced weights of class 0 and class 1 from the row counts of all classes; rows without a label don't count."""
    known = {c: n for c, n in counts.items() if c is not None}
    absent = [c for c in (0, 1) if not known.get(c)]
    if absent:
        raise ValueError(f"cannot weight classes: no rows with {label} in {absent}")
    return tuple(sum(known.values()) / (len(known) * known[c]) for c in (0, 1))


def calculate_class_weights(df: DataFrame, label: str = LABEL) -> tuple[float, float]:
    """Weights of class 0 and class 1."""
    return class_weights({row[label]: row["n"] for row in class_counts(df, label).collect()}, label)


def add_sample_weights(
    df: DataFrame, weight_neg: float, weight_pos: float, label: str = LABEL, column: str = "sample_weight"
) -> DataFrame:
    """Weight per row: class 0 the first weight, anything else the second."""
    return df.withColumn(column, F.when(F.col(label) == 0, F.lit(weight_neg)).otherwise(F.lit(weight_pos)))
