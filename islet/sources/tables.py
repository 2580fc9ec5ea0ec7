"""Readers with explicit schemas and the writers of every result table."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.functions.storage import keep, scratch  # noqa: F401
from islet.operators.counts import require_columns
from islet.operators.intervals import ranked

COUNTS = "sample string, island_id string, island_name string, chrom string, island_start long, island_end long, island_cpgNum long, haplotype string, n_reads long, n_cpg_total long, n_cpg_meth long, n_cpg_unmeth long, frac_meth double"
STATS_ORDER = "sample island_id island_name chrom island_start island_end island_cpgNum haplotype n_reads n_cpg_total n_cpg_meth n_cpg_unmeth frac_meth cohort_n_samples cohort_mean cohort_std cohort_median cohort_q25 cohort_q75 cohort_IQR z_score p_value p_adj IQR_outlier Z_outlier outlier".split()
SCORED = f"{COUNTS}, cohort_n_samples long, cohort_mean double, cohort_std double, cohort_median double, cohort_q25 double, cohort_q75 double, cohort_min double, cohort_max double, cohort_IQR double, z_score double, p_value double, p_adj double, IQR_outlier boolean, Z_outlier boolean, outlier boolean"
READ_CALLS = "sample string, read_id string, chrom string, ref_start long, ref_end long, is_unmapped boolean, is_secondary boolean, is_supplementary boolean, is_duplicate boolean, hp int, calls array<struct<rpos: long, prob: int>>"


def island_id(chrom: Column, start: Column, end: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def read_island_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Islands of a table with a header in any case: chrom, start, end, island_cpgNum, island_name, island_id. The name is closest_mane, else name, else null."""
    raw = spark.read.csv(path, sep="\t", header=True)
    raw = raw.toDF(*[c.strip().lower() for c in raw.columns])
    require_columns(raw, ["chrom", "chromstart", "chromend", "cpgnum"])
    names = [F.when(~F.trim(c).isin("", "nan", "NA", "None"), F.trim(c)) for c in ("closest_mane", "name") if c in raw.columns]
    start, end = F.col("chromstart").cast("long"), F.col("chromend").cast("long")
    return raw.select("chrom", start.alias("start"), end.alias("end"), F.col("cpgnum").cast("long").alias("island_cpgNum"), (F.coalesce(*names) if names else F.lit(None).cast("string")).alias("island_name"), island_id(F.col("chrom"), start, end).alias("island_id"))


def read_island_bed(spark: SparkSession, path: str, chrom: str | None = "chrX") -> DataFrame:
    """Islands of a headerless file of three or more columns, ``#`` comments: chrom, start, end, name (blank ones by position)."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != "") & ~F.col("value").rlike("^(track|browser)"))
    at = lambda i: F.get(parts, F.lit(i))
    bed = lines.select(at(0).alias("chrom"), at(1).cast("long").alias("start"), at(2).cast("long").alias("end"), F.nullif(F.trim(at(3)), F.lit("")).alias("name"))
    bed = bed.withColumn("name", F.coalesce("name", island_id(F.col("chrom"), F.col("start"), F.col("end"))))
    return bed.where(F.col("chrom") == chrom) if chrom else bed


def _globbed(paths: Sequence[str]) -> list[str]:
    """Paths as globs that leave out what is absent: those of a folder are alternatives of one. Paths with wildcards stay as they are."""
    by: dict[str, list[str]] = {}
    out = [p for p in paths if any(c in p for c in "*?[{")]
    for p in paths:
        if p not in out:
            folder, _, name = p.rstrip("/").rpartition("/")
            by.setdefault(folder, []).append("".join(f"\\{c}" if c in ",\\}" else c for c in name))
    return out + [(f"{folder}/" if folder else "") + (f"{{{','.join(names)}}}" if len(names) > 1 else names[0]) for folder, names in by.items()]


def _text(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """The lines of the paths that exist, with file and id (lines of a file's part have rising ids); None where none does."""
    globs = _globbed(paths)
    for some in ([globs], [[g] for g in globs]):
        made = []
        for g in some:
            try:
                made.append(spark.read.text(g))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        if made:
            out = made[0]
            for m in made[1:]:
                out = out.union(m)
            return out.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).withColumn("id", F.monotonically_increasing_id())
    return None


def headers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, list[str]]]:
    """(header, files) of all files of the paths that exist and aren't empty, by one job: a file's first line is the first one of its first part.

    Only a line a file reaches the driver, which has the paths already.
    """
    lines = _text(spark, paths)
    if lines is None:
        return []
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "id").alias("header"))
    by = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return sorted((r.header, list(r.files)) for r in by.collect())


def read_by_header(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Tab-separated files as one table of text columns, by the names in their own headers: columns may stand in any order, and one that a
    file lacks is null there. Absent and empty files are skipped; None where nothing is left. Files of one header are read together."""
    out = None
    for _, files in headers(spark, paths):
        one = spark.read.csv(files, sep="\t", header=True)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def _typed(raw: DataFrame, kinds: str) -> DataFrame:
    """Text columns by their kinds, in any order; other columns stay text. Blank and pandas' missing values are null, booleans are read strictly."""
    kind = dict(k.split(" ") for k in kinds.split(", "))
    told = lambda c: F.nullif(F.nullif(F.trim(c), F.lit("")), F.lit("nan"))
    read = lambda c: F.when(F.lower(told(c)) == "true", True).when(F.lower(told(c)) == "false", False) if kind[c] == "boolean" else told(c).try_cast(kind[c])
    return raw.select(*[read(c).alias(c) if c in kind else F.col(c) for c in raw.columns])


def read_counts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Counts of one or more files, each by its own header's names; files that are absent or empty are skipped, unless all are; columns that no file has raise."""
    raw = read_by_header(spark, [paths] if isinstance(paths, str) else list(paths))
    if raw is None:
        raise ValueError(f"no counts in {paths}")
    return _typed(require_columns(raw, [k.split(" ")[0] for k in COUNTS.split(", ")]), COUNTS)


def read_scored(spark: SparkSession, stats: str, locus_stats: str | None = None, outliers: str | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(scored rows, locus statistics, outliers) of a cohort run's folder or files: the last two by default beside the first, and None where absent."""
    beside = lambda name: f"{stats.rstrip('/').rsplit('/', 1)[0]}/{name}"
    rows = _typed(require_columns(spark.read.csv(stats, sep="\t", header=True), STATS_ORDER), SCORED)
    more = [read_by_header(spark, [given] if given else [beside(name), beside(f"{name}.tsv")]) for given, name in ((locus_stats, "cohort_locus_stats"), (outliers, "outliers"))]
    return rows, *[_typed(m, SCORED) if m is not None else None for m in more]


MANIFEST = "key string, sample string, folder string, rows long"


def file_marks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, mark) of the files that exist: a mark tells size and time of change, from the listing alone."""
    found = spark.read.format("binaryFile").load(_globbed(paths)).select("path", "length", "modificationTime")
    return found.select("path", F.concat_ws(":", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")).alias("mark"))


def content_mark(df: DataFrame) -> str:
    """A mark of a table's rows, in any order: their number and two sums of their hashes."""
    h = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return ":".join(map(str, df.agg(F.count("*"), F.sum(h), F.sum(F.hash(*df.columns).cast("decimal(38,0)"))).first()))


def stored_counts(inputs: DataFrame, path: str, params: dict, make: Callable[[list[str]], DataFrame] | Callable[[DataFrame], DataFrame], *, force: bool = False, as_table: bool = False) -> DataFrame:
    """Counts of the samples of ``inputs`` (sample, mark) from a store at ``path``; only what it lacks is made (all, with ``force``).

    ``make`` gets the names to make counts of: a sorted list, where they are files to read, which the driver lists anyway; with ``as_table`` a table
    (sample), and no name reaches the driver.

    The key of a sample's counts is its mark and the parameters (give them a mark of every other input, such as the islands): a changed
    file, parameter or annotation is made anew, and what an earlier one gave stays beside it. A manifest lists what is there, also
    samples without any counts; an anti-join with it tells what to make. Counts are written to a folder of their own
    before the manifest names them, so a run that ends early leaves nothing half done, and of two that wrote the same the last counts.
    """
    spark, shared = inputs.sparkSession, json.dumps(params, sort_keys=True)
    wanted = keep(inputs.select(F.col("sample").cast("string").alias("sample"), F.sha2(F.concat_ws("\n", F.lit(shared), F.col("sample").cast("string"), F.col("mark").cast("string")), 256).alias("key")).distinct())
    have = lambda: spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest/*")
    try:
        lacking = wanted if force else wanted.join(have(), "key", "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        lacking = wanted
    new = keep(lacking.select("sample").distinct())
    if not new.isEmpty():
        run = uuid.uuid4().hex
        folder = f"{path.rstrip('/')}/counts/{run}"
        make(new if as_table else sorted(r.sample for r in new.collect())).select(*[k.split(" ")[0] for k in COUNTS.split(", ")]).write.parquet(folder)
        got = spark.read.schema(COUNTS).parquet(folder).groupBy("sample").agg(F.count("*").alias("rows"))
        made = wanted.join(new, "sample", "left_semi").join(got, "sample", "left").select("key", "sample", F.lit(run).alias("folder"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
        made.coalesce(1).write.parquet(f"{path.rstrip('/')}/manifest/{time.time_ns():020d}-{run}")
    elif wanted.isEmpty():
        return spark.createDataFrame([], COUNTS)
    # the last entry of a key counts
    entries = have().withColumn("at", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    last = entries.groupBy("key").agg(F.max_by(F.struct("sample", "folder", "rows"), "at").alias("x")).select("key", "x.*")
    chosen = keep(wanted.join(last.drop("sample"), "key").where("rows > 0").select("sample", "folder"))
    counts = spark.read.schema(COUNTS).parquet(f"{path.rstrip('/')}/counts/*").withColumn("folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    return counts.join(chosen, ["sample", "folder"], "left_semi").select(*[k.split(" ")[0] for k in COUNTS.split(", ")])


def exclude_names(lines: DataFrame, value: str = "value") -> DataFrame:
    """(sample) of lines with one name each; ``#`` starts a comment anywhere, blank lines are skipped."""
    name = F.regexp_replace(F.get(F.split(value, "#"), F.lit(0)), r"^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$", "")
    return lines.select(name.alias("sample")).where(F.col("sample") != "").distinct()


def read_exclude_list(spark: SparkSession, path: str) -> DataFrame:
    return exclude_names(spark.read.text(path))


def in_order(df: DataFrame, order: Sequence[str] = STATS_ORDER) -> DataFrame:
    """Known columns first, in their order, then the others."""
    return df.select(*[c for c in order if c in df.columns], *[c for c in df.columns if c not in order])


def write_tsv(df: DataFrame, path: str, *, force: bool = False) -> None:
    """Tab-separated with a header; an output that exists stays unless ``force``."""
    df.write.mode("overwrite" if force else "ignore").csv(path, sep="\t", header=True)


def exclude_lines(flags: DataFrame, source: str = "") -> DataFrame:
    """(ord, value) of an exclusion file to edit: a head of comments, suggested samples with their reasons, then the others as comments."""
    n = flags.agg(F.count("*").alias("all"), F.count(F.when(F.col("qc_outlier"), 1)).alias("out"))
    head = ["# Samples to exclude: one exact name a line; what follows a # is a comment.", "# Suggested samples stand as they are; uncomment or add others."]
    told = [*[F.lit(x) for x in head], F.lit(f"# Source: {source}"), F.concat(F.lit("# Samples: "), F.col("all").cast("string")), F.concat(F.lit("# Suggested: "), F.col("out").cast("string"))]
    top = n.select(F.posexplode(F.array(*told)).alias("i", "value")).select(F.lit(0).alias("part"), F.format_string("%04d", "i").alias("key"), "value")
    none = n.where("out = 0").select(F.lit(1).alias("part"), F.lit("").alias("key"), F.lit("# (none)").alias("value"))
    line = F.when(F.col("qc_outlier"), F.concat("sample", F.lit("  # "), "qc_reasons")).otherwise(F.concat(F.lit("# "), "sample"))
    rows = flags.select(F.when(F.col("qc_outlier"), 2).otherwise(3).alias("part"), F.col("sample").cast("string").alias("key"), line.alias("value"))
    return top.union(none).union(rows).select(F.struct("part", "key").alias("ord"), "value")


def write_in_order(df: DataFrame, path: str, order: Sequence[Column | str], *, lines: str | None = None, force: bool = False) -> None:
    """Writes a table by its order, which must break all ties: files follow each other by name, each a range of it, and each row tells its
    place (``rank``, from 0). With ``lines``, only that column, as text."""
    made = ranked(df, order).repartitionByRange("rank").sortWithinPartitions("rank")
    to = (made.select(lines) if lines else made).write.mode("overwrite" if force else "ignore")
    to.text(path) if lines else to.csv(path, sep="\t", header=True)


def write_exclude_list(flags: DataFrame, path: str, *, source: str = "", force: bool = False) -> None:
    """``exclude_lines`` in order, names too."""
    told = exclude_lines(flags, source).select("ord.part", "ord.key", "value")
    write_in_order(told, path, ["part", "key", "value"], lines="value", force=force)


def track_head(prefix: Column, chrom: str = "chrX") -> Column:
    """The first line of a track. Fixed text."""
    return F.concat(F.lit('track name="'), prefix, F.lit(f'_{chrom}_XCI" description="CpG island methylation bias {chrom} \u2014 '), prefix, F.lit('" itemRgb="On"'))


def write_bed9(rows: DataFrame, path: str, *, prefix: str | None = None, force: bool = False) -> None:
    """A track of each sample in a folder of its own: its header, then rows by start, pseudoautosomal ones first.

    A sample's rows, as many as islands, are one file; samples are dealt over the tasks. The header names ``prefix``, or the sample.
    """
    name = F.lit(prefix) if prefix else F.col("sample")
    head = rows.select("sample").distinct().select("sample", F.lit(-1).cast("long").alias("start"), F.lit(True).alias("is_par"), track_head(name).alias("line"))
    every = head.unionByName(rows.select("sample", "start", "is_par", "line"))
    made = every.repartition("sample").sortWithinPartitions("sample", "start", F.desc("is_par"), "line").select("sample", "line")
    made.write.mode("overwrite" if force else "ignore").partitionBy("sample").text(path)
