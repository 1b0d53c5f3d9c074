"""Scans of the files of the pipeline's stages, with venue and year from their paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom import schema

SUFFIXES = {"pdf": "*.pdf", "tei": "*.grobid.tei.xml", "markdown": "*.md", "contexts": "*.json", "scores": "*.csv"}


def _placed(df: DataFrame, path: Column) -> DataFrame:
    """``conf`` and ``file_year`` from the two directories above a file."""
    parts = F.split(path, "/")
    return df.withColumns({"conf": F.element_at(parts, -3), "file_year": F.expr("try_cast(element_at(split(path, '/'), -2) AS INT)")})


def _of_years(df: DataFrame, years: list[int] | None) -> DataFrame:
    return df.filter(F.col("file_year").isin(*years)) if years else df.filter(F.col("file_year").isNotNull())


def existing(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Those of the path patterns that something matches."""
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(settings).globStatus(path)
        if found is not None and len(found):
            there.append(pattern)
    return there


def files(spark: SparkSession, root: str, kind: str, conf: str, years: list[int] | None = None, content: bool = False) -> DataFrame:
    """path, conf, file_year (and content) of a venue's files; years narrow the directories that are listed."""
    there = existing(spark, [f"{root}/{conf}/{y}" for y in years] if years else [f"{root}/{conf}/*"])
    if not there:
        return spark.createDataFrame([], "path string, conf string, file_year int" + (", content binary" if content else ""))
    scan = spark.read.format("binaryFile").option("pathGlobFilter", SUFFIXES[kind]).load(there)
    kept = scan.select("path", "content") if content else scan.select("path")
    return _of_years(_placed(kept, F.col("path")), years)


def lenient_text(content: Column) -> Column:
    """UTF-8 text; bytes that are none become replacement characters, line ends become newlines."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "\r\n?", "\n")


def strict_text(content: Column) -> Column:
    """UTF-8 text, or null where bytes are none."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), F.regexp_replace(text, "\r\n?", "\n"))


def markdown(spark: SparkSession, root: str, conf: str, years: list[int] | None = None, strict: bool = False) -> DataFrame:
    read = strict_text if strict else lenient_text
    return files(spark, root, "markdown", conf, years, content=True).withColumn("content", read(F.col("content")))


def metadata(spark: SparkSession, root: str, conf: str, year: int) -> DataFrame:
    """Papers of one venue and year: a JSON array, in file order."""
    rows = spark.read.schema(schema.METADATA).option("multiLine", True).json(f"{root}/{conf}/{conf}_{year}.json")
    return rows.withColumns({"json_pos": F.monotonically_increasing_id(), "conf": F.lit(conf), "file_year": F.lit(year)})


def all_metadata(spark: SparkSession, root: str) -> tuple[DataFrame, list[str]]:
    """Papers of all venues and calendar years, and the files that are missing, which are passed over."""
    wanted = [f"{root}/{v}/{v}_{y}.json" for v, (a, b, parity) in schema.CALENDAR.items() for y in range(a, b + 1) if not parity or (y % 2 == 0) == (parity == "even")]
    there = existing(spark, wanted)
    missing = sorted(set(wanted) - set(there))
    if not there:
        return spark.createDataFrame([], schema.METADATA + ", json_pos long, conf string, file_year int"), missing
    rows = spark.read.schema(schema.METADATA).option("multiLine", True).json(there)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_(\d+)\.json$", 1)
    year = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_(\d+)\.json$", 2)
    return rows.select("*", F.monotonically_increasing_id().alias("json_pos"), name.alias("conf"), year.cast("int").alias("file_year")), missing


def contexts(spark: SparkSession, root: str, conf: str) -> DataFrame:
    """path and refs of each paper's context file."""
    rows = files(spark, root, "contexts", conf, content=True)
    return rows.withColumn("refs", F.from_json(F.col("content").cast("string"), f"array<{schema.REFERENCE}>")).drop("content")


OUTPUTS = ["type_1_output", "type_2_output", "type_3_output"]


def _scores(spark: SparkSession, there: list[str]) -> DataFrame:
    if not there:
        return spark.createDataFrame([], schema.SCORES + ", path string, row_pos long")
    rows = spark.read.schema(schema.SCORES).option("header", True).csv(there)
    return rows.select("*", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("row_pos")).fillna("", subset=OUTPUTS)


def scores(spark: SparkSession, root: str, conf: str) -> DataFrame:
    """Prompt scores as text, null cells empty, with their file and row position."""
    return _scores(spark, existing(spark, [f"{root}/{conf}/*/*.csv"]))


def all_scores(spark: SparkSession, root: str) -> DataFrame:
    """Prompt scores of all venues that have any."""
    return _scores(spark, existing(spark, [f"{root}/{conf}/*/*.csv" for conf in schema.VENUES]))


def corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
