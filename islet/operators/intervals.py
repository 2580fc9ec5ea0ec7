"""Interval joins and genome coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from islet.functions.storage import keep

#: Chromosome sizes of GRCh38 in genome order. Fixed values.
CHROM_SIZES = [
    ("chr1", 248956422), ("chr2", 242193529), ("chr3", 198295559), ("chr4", 190214555), ("chr5", 181538259), ("chr6", 170805979),
    ("chr7", 159345973), ("chr8", 145138636), ("chr9", 138394717), ("chr10", 133797422), ("chr11", 135086622), ("chr12", 133275309),
    ("chr13", 114364328), ("chr14", 107043718), ("chr15", 101991189), ("chr16", 90338345), ("chr17", 83257441), ("chr18", 80373285),
    ("chr19", 58617616), ("chr20", 64444167), ("chr21", 46709983), ("chr22", 50818468), ("chrX", 156040895), ("chrY", 57227415),
]
#: Pseudoautosomal regions of chrX as commonly listed (they equal the GRCh37 bounds). Fixed values.
PAR_REGIONS = [(60_001, 2_699_520), (154_931_044, 155_260_560)]


def span_join(reads: DataFrame, islands: DataFrame, *, chrom: str = "chrom", start: str = "start", end: str = "end", read_start: str = "ref_start", read_end: str = "ref_end", bin_size: int | None = None) -> DataFrame:
    """Pairs of an island and a read that covers it whole, on one chromosome.

    With ``bin_size`` each island goes to the bin of its start and each read to all bins it covers, and the join is on
    (chromosome, bin): a covering read has the island's start, so each pair appears once, and no side need be small. Without it
    the join is on the chromosome, for few islands.
    """
    covers = (F.col(read_start) <= F.col(start)) & (F.col(read_end) >= F.col(end))
    if bin_size is None:
        return reads.join(islands, chrom).where(covers)
    left = reads.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(read_start) / bin_size), F.floor(F.col(read_end) / bin_size))))
    right = islands.withColumn("_bin", F.floor(F.col(start) / bin_size))
    return left.join(right, [chrom, "_bin"]).where(covers).drop("_bin")


def overlaps(start: Column, end: Column, regions: Sequence[tuple[int, int]]) -> Column:
    """Half-open overlap with any region."""
    out = F.lit(False)
    for a, b in regions:
        out = out | ((start < b) & (end > a))
    return out


def split_par(islands: DataFrame, regions: Sequence[tuple[int, int]] = PAR_REGIONS, *, start: str = "start", end: str = "end") -> tuple[DataFrame, DataFrame]:
    """(outside, inside) the pseudoautosomal regions."""
    inside = overlaps(F.col(start), F.col(end), regions)
    return islands.where(~inside), islands.where(inside)


def chrom_table(spark: SparkSession, sizes: Sequence[tuple[str, int]] = CHROM_SIZES) -> DataFrame:
    """chrom, ord, size, chrom_offset, band_start, band_end, tick: the layout of chromosomes laid end to end."""
    rows, at = [], 0
    for i, (name, size) in enumerate(sizes):
        rows.append((name, i, size, at, at, at + size, at + size // 2))
        at += size
    return spark.createDataFrame(rows, "chrom string, ord int, size long, chrom_offset long, band_start long, band_end long, tick long")


def genome_positions(df: DataFrame, chroms: DataFrame, *, chrom: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """Adds ord and x_pos, the interval's middle on the genome axis; rows of other chromosomes go."""
    at = chroms.select(F.col("chrom").alias(chrom), "ord", "chrom_offset")
    return df.join(at, chrom).withColumn("x_pos", F.col("chrom_offset") + F.expr(f"(`{start}` + `{end}`) div 2")).drop("chrom_offset")


def binned_rank(df: DataFrame, value: str, tie: str, *, out: str = "rank", bins: Column | None = None) -> DataFrame:
    """Rank from 0 over the whole table by value, then ``tie``; no task sees more than a bin of it, or one row a bin."""
    told = df.withColumn("_bin", bins if bins is not None else F.floor(F.col(value) * 1000))
    sizes = told.groupBy("_bin").agg(F.count("*").alias("_n"))
    sizes = sizes.withColumn("_below", F.sum("_n").over(Window.orderBy(F.col("_bin").asc_nulls_last())) - F.col("_n")).drop("_n")
    a, b = told.alias("a"), sizes.alias("b")
    both = a.join(b, F.col("a._bin").eqNullSafe(F.col("b._bin"))).select("a.*", "b._below")
    here = Window.partitionBy("_bin").orderBy(F.col(value).asc_nulls_last(), tie)
    return both.withColumn(out, F.col("_below") + F.row_number().over(here) - 1).drop("_bin", "_below")


def ranked(df: DataFrame, order: Sequence[Column | str], *, out: str = "rank") -> DataFrame:
    """Adds each row's place from 0 in the whole table's order, which must break all ties; a task sees one range of it.

    Rows are dealt into ranges of the order and written so, which fixes the ranges; a range's first place is the size of those before.
    """
    dealt = keep(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    # one row a range
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).drop("_n")
    here = Window.partitionBy("_range").orderBy(*order)
    return dealt.join(before, "_range").withColumn(out, F.col("_before") + F.row_number().over(here) - 1).drop("_range", "_before")
